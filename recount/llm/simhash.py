"""SimHash near-duplicates by a byte-position inverted index with count filtering (operator 2).

Fingerprints: 64 bits of the words' shingles, computed in Arrow batches; XXH64 of each shingle, a
bit is set if set in over half of them. Equal fingerprints are one entry of the index.

Index: two fingerprints that differ in at most ``max_bits`` bits agree in at least 8 - max_bits of
their eight positional bytes: the guaranteed minimum of matches. A posting list of one positional
byte would hold 1/256 of all fingerprints, and tallying its pairs is quadratic. So a list stands for
one byte less than the minimum, together: a pair that agrees in five of eight bytes agrees in four of
the first seven, so the 35 choices of four among seven are enough (for three bits), and a list holds
one of 2**32 values. Entries of a list are tallied in pairs, over all eight bytes: pairs below the
guaranteed minimum go by the count, a pair in several lists counts in the first of them, and the bit
distance of the rest is verified. The index is shuffled once, both sides of the join read it; skewed
partitions may be split, and no list is collected. A fingerprint has at most 43,744 others within
three bits, so the links of a dense group grow with its size, not with its square.

Components of the verified links: ``components``.

Defined cases: a null text, or one without words, has fingerprint zero and is linked like any
other. Null ids are never a component's id, unless the group has no other. Repeated rows and
copies share a fingerprint. Empty tables give empty results. Other columns aren't read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, text_or_empty, unpacked, written
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
_CHUNK = 255 * 256  # shingles hashed at a time: bounds memory on very long texts


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    import numpy as np
    import xxhash

    found = text.lower().split()  # bytes: A-Z and ASCII white space only
    n = len(found)
    if not n:
        return 0
    flat = b" ".join(found)
    if n <= shingle:
        return xxhash.xxh64_intdigest(flat, SEED)
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: n - shingle + 1]
    ends = np.concatenate((gaps, [len(flat)]))[shingle - 1 :]
    hash_, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    lanes = np.uint64(0x0101010101010101)
    for at in range(0, len(starts), _CHUNK):
        a, b = starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist()
        h = np.zeros(-(-len(a) // 255) * 255, np.uint64)
        h[: len(a)] = [hash_(flat[i:j], SEED) for i, j in zip(a, b)]
        h = h.reshape(-1, 255)
        for bit in range(8):  # bit ``bit`` of all eight bytes at once; 255 rows can't overflow a byte
            sums = ((h >> np.uint64(bit)) & lanes).sum(axis=1, dtype=np.uint64)
            counts[bit::8] += sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(starts))))


def fingerprints(docs: DataFrame, keep: list[Column], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp`` long (the unsigned fingerprint's bits)."""
    src = docs.select(*keep, text_or_empty(text).cast("binary").alias("__text"))
    kept = src.drop("__text").schema
    names = kept.fieldNames()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("__text")
            fps = np.fromiter((fingerprint(x.as_buffer().to_pybytes(), shingle) for x in texts), np.uint64, len(texts))
            cols = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps.view(np.int64))], [*names, "fp"])

    return src.mapInArrow(run, kept.add("fp", "long"))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``distinct`` (fp), no value twice: pairs (a, b), a < b, of at most ``max_bits`` different bits."""
    least = 8 - max_bits
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits: 0 to 7; beyond that, fingerprints need not share a byte")
    # Of ``least`` equal bytes among eight, ``size`` are among the first ``max_bits + size``.
    size = max(1, least - 1)
    lists = list(combinations(range(max_bits + size), size))
    masks = [sum(0xFF << (8 * p) for p in chosen) for chosen in lists]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("list", "bytes"),
    )
    # The same frame twice, so that Spark shuffles the index once. Spark takes the lists for no larger than the fingerprints that
    # they are exploded from, and would broadcast them: the hint says that neither side is small.
    met = posted.alias("a").join(posted.alias("b").hint("merge"), (F.col("a.list") == F.col("b.list")) & (F.col("a.bytes") == F.col("b.bytes")) & (F.col("a.fp") < F.col("b.fp")))
    pairs = met.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"), F.col("a.list").alias("list"))
    # The positional bytes that match, as a sum of powers of two, and their tally.
    match = sum(F.when(F.expr(f"shiftright(a ^ b, {8 * p}) & 255") == 0, F.lit(1 << p)).otherwise(F.lit(0)) for p in range(8))
    first_list = [-1] * 256  # of each set of matching bytes that is large enough, the list of its first ``size``
    for m in range(256):
        at = [p for p in range(8) if m >> p & 1]
        if len(at) >= least:
            first_list[m] = lists.index(tuple(at[:size]))
    counted = pairs.select("a", "b", "list", match.alias("match")).filter(F.bit_count("match") >= least)
    once = counted.filter(F.get(F.array(*[F.lit(x) for x in first_list]), F.col("match")) == F.col("list"))
    return once.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: ``doc_id``, ``__t1``, ``__t2`` (hashes of the text), ``fp``, and of its component
    ``component_id`` (smallest id) and ``keeper`` (a struct of the row that stands for it)."""
    t = text_or_empty(text)
    keep = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(t).alias("__t1"), F.hash(t).alias("__t2")]
    fps = written(fingerprints(docs, keep, text, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("__t1").alias("t1"), F.col("__t2").alias("t2"))
    nodes = written(fps.groupBy("fp").agg(F.min(row).alias("least")), "fingerprint-nodes")
    comp = connected_components(links(nodes.select("fp"), max_bits))
    of = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    keepers = of.groupBy("component").agg(F.min("least").alias("keeper"))
    by_fp = of.join(keepers, "component").select(F.col("fp").alias("__fp"), "keeper")
    return fps.join(by_fp, fps.fp == by_fp["__fp"]).select(
        "doc_id", "__t1", "__t2", "fp", F.when(~F.col("keeper.no_id"), F.col("keeper.id")).alias("component_id"), "keeper"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their component: the smallest id; of rows equal in id, one."""
    t = text_or_empty(text)
    keepers = near_duplicates(docs, id_col, text, shingle, max_bits).select("keeper.*").distinct()
    key = ["__no", "__id", "__t1", "__t2"]
    rows = packed(docs, F.col(f"`{id_col}`").isNull().alias("__no"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("__id"), F.xxhash64(t).alias("__t1"), F.hash(t).alias("__t2"))
    stay = rows.join(
        keepers,
        (F.col("__no") == F.col("no_id")) & (F.col("__id") == F.col("id")) & (F.col("__t1") == F.col("t1")) & (F.col("__t2") == F.col("t2")),
        "left_semi",
    )
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    return stay.withColumn("__nth", nth).filter("__nth = 1").select(*unpacked(docs.columns))


def op2_simhash(spark, sf_dir):
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
