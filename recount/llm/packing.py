"""Conflict-constrained best-fit packing of documents into fixed-size sequences (operator 4).

A document of more than ``capacity`` tokens fills whole bins with its first pieces; what remains,
like any shorter document, is packed by best fit in decreasing order. No text is cut otherwise,
none is dropped. Two documents of one source, or of one duplicate cluster, never share a bin:
every open bin carries a bitmap of its sources and one of its clusters. Open bins are ordered by
residual capacity; the search starts at the smallest residual that fits and goes on to its
successors until the tightest compatible bin is found; else a bin is opened. Per residual, the
bitmaps that all its bins have in common let the search pass it without looking at any bin.

Documents are dealt to shards by a hash, about ``SHARD_ROWS`` each, however many there are; a
shard is packed by one task, with a few numbers per document. Bins never cross shards.

Length: white-space words plus one end mark, unless ``length`` names an integer column. Cluster:
hash of the lower-cased words, unless ``cluster`` names a column.

Defined cases: a null or empty text has one token, the end mark, and no cluster; null sources and
clusters conflict with nothing. Lengths null or below one count as one. Repeated rows are copies of one another, hence in
different bins. Ties go by id, then by hash. Empty tables give empty results. Other columns
aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words

CAPACITY = 2048
SHARD_ROWS = 1 << 14
PACKED = "doc_id long, piece int, n_tokens int, bin_id long, bin_offset int"


class Bins:
    """Open bins of one shard, by residual capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.count = capacity, 0
        self.open = 0  # bit r: some bin has residual r
        self.at: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]  # (bin, sources, clusters)
        self.common = [(-1, -1)] * (capacity + 1)  # bits that all bins of a residual have

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) of a piece; ``source`` and ``cluster`` are single bits or zero."""
        left = self.open >> length << length
        while left:
            r = (left & -left).bit_length() - 1
            every = self.common[r]
            if not (every[0] & source or every[1] & cluster):
                bins = self.at[r]
                for i, (b, s, c) in enumerate(bins):
                    if not (s & source or c & cluster):
                        bins[i] = bins[-1]
                        bins.pop()
                        if not bins:
                            self.open &= ~(1 << r)
                            self.common[r] = (-1, -1)
                        self._put(b, r - length, s | source, c | cluster)
                        return b, self.capacity - r
            left &= left - 1
        b = self.new()
        self._put(b, self.capacity - length, source, cluster)
        return b, 0

    def new(self) -> int:
        self.count += 1
        return self.count - 1

    def _put(self, b: int, residual: int, sources: int, clusters: int) -> None:
        if residual:
            self.at[residual].append((b, sources, clusters))
            self.open |= 1 << residual
            s, c = self.common[residual]
            self.common[residual] = (s & sources, c & clusters)


def pack_shard(rows: list[tuple], capacity: int) -> list[tuple[int | None, int, int, int, int]]:
    """``rows`` (id, length, source, cluster), longest remainder first: (id, piece, tokens, bin, offset)."""
    from collections import Counter

    def bits(values):
        # A bit for what occurs twice or more; the rest can't conflict.
        often = [v for v, n in Counter(v for v in values if v is not None).items() if n > 1]
        return {v: 1 << i for i, v in enumerate(often)}

    sources, clusters = bits(r[2] for r in rows), bits(r[3] for r in rows)
    bins, out = Bins(capacity), []
    for id_, length, source, cluster in rows:
        whole, rest = divmod(length, capacity)
        for piece in range(whole):
            out.append((id_, piece, capacity, bins.new(), 0))
        if rest:
            b, offset = bins.place(rest, sources.get(source, 0), clusters.get(cluster, 0))
            out.append((id_, whole, rest, b, offset))
    return out


def best_fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str | None = "source",
    cluster: str | None = None,
    length: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Rows (doc_id, piece, n_tokens, bin_id, bin_offset): one per document, and one more for each
    whole bin that it fills. ``bin_id``: shard and bin within it."""
    shards_ = max(1, -(-docs.count() // SHARD_ROWS))
    w = words(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))) if length is None or cluster is None else F.array()
    src = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("__id"),
        (F.xxhash64(F.col(f"`{source}`")) if source else F.lit(0)).alias("__source"),
        (F.col(f"`{source}`").isNull() if source else F.lit(True)).alias("__no_source"),
        (F.lit(0) if cluster is None else F.xxhash64(F.col(f"`{cluster}`"))).cast("long").alias("__given"),
        (F.lit(False) if cluster is None else F.col(f"`{cluster}`").isNull()).alias("__no_given"),
        (F.lit(1) if length is None else F.greatest(F.coalesce(F.col(f"`{length}`"), F.lit(1)), F.lit(1))).cast("long").alias("__given_length"),
        w.alias("__w"),
    )
    n = F.size("__w") + 1 if length is None else F.col("__given_length")
    same = F.when(F.size("__w") > 0, F.xxhash64("__w")) if cluster is None else F.when(~F.col("__no_given"), F.col("__given"))
    pieces = src.select("__id", F.when(~F.col("__no_source"), F.col("__source")).alias("__source"), same.alias("__cluster"), n.cast("long").alias("__n"))
    spread = F.pmod(F.xxhash64("__id", "__n", "__cluster"), F.lit(shards_))
    dealt = pieces.withColumn("__shard", spread).repartition("__shard")
    dealt = dealt.sortWithinPartitions("__shard", F.desc(F.col("__n") % capacity), "__id", "__cluster", "__source")

    def work(batches):
        import pyarrow as pa

        names = ["doc_id", "piece", "n_tokens", "bin_id", "bin_offset"]
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())

        def done(shard, rows):
            out = pack_shard(rows, capacity)
            for i in range(0, len(out), 1 << 16):
                cols = list(zip(*((a, b, c, (shard << 32) + d, e) for a, b, c, d, e in out[i : i + (1 << 16)])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        at, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(batch.column(c).to_pylist() for c in ("__shard", "__id", "__n", "__source", "__cluster"))):
                if shard != at:
                    if rows:
                        yield from done(at, rows)
                    at, rows = shard, []
                rows.append(row)
        if rows:
            yield from done(at, rows)

    return dealt.mapInArrow(work, PACKED)


def op4_packing(spark, sf_dir):
    from .common import table

    return best_fit(table(spark, sf_dir, "documents"))
