"""Exact top-k inner products by vector-approximation files (operator 9).

Vectors become whole numbers, floor(scale * x). ``approximate`` writes them to files of blocks in the shared
folder: ids, per component a cell number (grid fitted on a bounded sample; each block has its cells' true
extremes, so the bounds hold for whatever the sample missed), and behind them the exact numbers. Queries are written
the same way. Only places of blocks (file, offset) go through Spark's tables and shuffles: a row of work is a block of
queries and the places of a shard's blocks. Its task reads the cells of one block after the other, which give every
vector's upper bound, and reads exact vectors by range in the order of their bounds until the next bound
is below the k-th exact score; a vector that several queries of the block want is read once. Ties are read too, so they
go to the smaller id for certain. Per query and shard k rows remain, and of those the k best.

A task that is run again writes another file; the table of places, committed by Spark, names those that count.
Memory of a task: a block of queries, one block of cells and bounds, and those of its exact vectors that were read.

Every vector is a candidate of every query: a stated query set against all rows, in blocks; no pair of
rows is ever a row.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an
id, take no part. Vectors of different length aren't compared. Of rows that share an id, all are
candidates (except of that id's query), and the smallest vector is the query. Fewer than k candidates:
all of them. Scores beyond 64 bits are an error, not a wrong result. Empty tables give empty results.
Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, shared_dir, written

K = 10
SCALE = 1024
CELLS = 16
SAMPLE = 4096  # vectors on which the grid is fitted; it decides the tightness of the bounds only
BLOCK = 4096  # vectors of a block
QUERIES = 1024  # queries of a block
SHARD_BLOCKS = 16  # blocks of a shard
STEP = 64  # exact vectors read at a time
PLACE = "dim int, n int, uri string, at long"


def whole_numbers(df: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    e = F.col(f"`{vector}`")
    fine = e.isNotNull() & F.col(f"`{id_col}`").isNotNull() & (F.size(e) > 0)
    number = df.filter(fine).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.transform(e, lambda x: x.cast("double")).alias("x"))
    finite = number.filter(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # floor() of a double gives a long; rounding to a whole double first keeps large ones exact.
    return finite.select("vec_id", F.transform("x", lambda x: F.rint(x * scale) - F.when(F.rint(x * scale) > x * scale, 1.0).otherwise(0.0)).alias("v"))


def _grid(vectors: DataFrame, cells: int) -> dict[int, list]:
    """Per dimension count, the inner cell borders of each component, from a bounded sample."""
    import numpy as np

    by_dim: dict[int, list] = {}
    for (v,) in vectors.select("v").limit(SAMPLE).collect():
        by_dim.setdefault(len(v), []).append(v)
    return {d: np.quantile(np.array(x), np.arange(1, cells) / cells, axis=0).T for d, x in by_dim.items()}


def _blocks_of(batches, size: int):
    """(dimension, ids, matrix) of at most ``size`` rows each, from (vec_id, v) batches."""
    import numpy as np

    kept: dict[int, tuple[list, list]] = {}
    for batch in batches:
        ids, column = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("v")
        ends = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False)
        dims = np.diff(ends)
        for d in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == d)
            m = flat[(ends[rows][:, None] + np.arange(d))]
            a, b = kept.setdefault(d, ([], []))
            a.append(ids[rows])
            b.append(m)
            while sum(map(len, a)) >= size:
                i, x = np.concatenate(a), np.concatenate(b)
                yield d, i[:size], x[:size]
                a[:], b[:] = [i[size:]], [x[size:]]
    for d, (a, b) in kept.items():
        if sum(map(len, a)):
            yield d, np.concatenate(a), np.concatenate(b)


def _blocks_written(folder: str, size: int, encoded):
    """For mapInArrow: (vec_id, v) to blocks of ``size`` rows in a file of the task, ``encoded(d, ids, x)``
    being a block's byte strings; the blocks' places."""

    def work(batches):
        import uuid

        import pyarrow as pa

        out, places = None, []
        for d, ids, x in _blocks_of(batches, size):
            if out is None:
                uri = f"{folder}/{uuid.uuid4().hex}"
                fs, path = filesystem(uri)
                out = fs.open_output_stream(path)
            places.append((d, len(ids), uri, out.tell()))
            for part in encoded(d, ids, x):
                out.write(part)
        if out is not None:
            out.close()
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*places), types)], ["dim", "n", "uri", "at"])

    return work


def _new_folder(spark, name: str) -> str:
    folder = shared_dir(spark, name)
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    return folder


def approximate(vectors: DataFrame, cells: int = CELLS) -> DataFrame:
    """Writes the approximation file; its blocks' places (dim, n, uri, at)."""
    grid = _grid(vectors, cells)

    def encoded(d, ids, x):
        import numpy as np

        borders = grid.get(d, np.zeros((d, 0)))
        codes = np.stack([np.searchsorted(borders[i], x[:, i], side="right") for i in range(d)], axis=1).astype(np.uint8)
        low, high = np.zeros((d, cells)), np.zeros((d, cells))
        for c in range(cells):
            here = codes == c
            low[:, c] = np.where(here, x, np.inf).min(axis=0)
            high[:, c] = np.where(here, x, -np.inf).max(axis=0)
        return ids.astype("<i8").tobytes(), codes.tobytes(), np.stack((low, high)).astype("<f8").tobytes(), x.astype("<f8").tobytes()

    folder = _new_folder(vectors.sparkSession, "approximation")
    return written(vectors.mapInArrow(_blocks_written(folder, BLOCK, encoded), PLACE), "approximation-places")


class ExactRows:
    """The exact vectors of a block, read by range as they are asked for: ``rows[numbers]``."""

    def __init__(self, f, at: int, n: int, d: int):
        import numpy as np

        self.f, self.at, self.d = f, at, d
        self.rows = np.empty((n, d))
        self.have = np.zeros(n, bool)

    def __getitem__(self, numbers):
        import numpy as np

        lacking = np.sort(numbers[~self.have[numbers]])
        if lacking.size:
            width = 8 * self.d
            for run in np.split(lacking, np.flatnonzero(np.diff(lacking) > 1) + 1):
                a, b = int(run[0]), int(run[-1]) + 1
                self.f.seek(self.at + a * width)
                self.rows[a:b] = np.frombuffer(self.f.read((b - a) * width), "<f8").reshape(-1, self.d)
            self.have[lacking] = True
        return self.rows[numbers]


class Block:
    """A block of the approximation file: ids, cells and extremes at once, exact vectors as asked for."""

    def __init__(self, f, at: int, n: int, d: int, cells: int):
        import numpy as np

        f.seek(at)
        sizes = (8 * n, n * d, 16 * d * cells)
        data = memoryview(f.read(sum(sizes)))
        self.ids = np.frombuffer(data[: sizes[0]], "<i8")
        self.codes = np.frombuffer(data[sizes[0] : sizes[0] + sizes[1]], np.uint8).reshape(n, d)
        self.extremes = np.frombuffer(data[sizes[0] + sizes[1] :], "<f8").reshape(2, d, cells)
        self.exact = ExactRows(f, at + sum(sizes), n, d)


def exact_scores(q, rows):
    """Exact inner products as int64."""
    import numpy as np

    most = float(np.abs(q).max(initial=0)) * float(np.abs(rows).max(initial=0)) * len(q)
    if most < 2**53:
        return (rows @ q).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("an inner product does not fit into 64 bits")
    return rows.astype(np.int64) @ q.astype(np.int64)


class Search:
    """The k best of a block of queries, over any number of vector blocks."""

    def __init__(self, ids, queries, k: int):
        import numpy as np

        self.ids, self.q, self.k = ids, queries, k
        self.up, self.down = np.maximum(queries, 0), np.minimum(queries, 0)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), ascending
        self.read = 0

    def block(self, ids, codes, extremes, exact) -> None:
        import numpy as np

        d = codes.shape[1]
        low, high = (extremes[j][np.arange(d), codes] for j in (0, 1))
        # A float's rounding must not make a bound too low.
        bounds = self.up @ high.T + self.down @ low.T
        bounds += np.abs(bounds) * 2**-40 + 1
        for i, me in enumerate(self.ids.tolist()):
            best, bound = self.best[i], bounds[i]
            near = np.flatnonzero(bound >= -best[-1][0]) if len(best) == self.k else np.arange(len(ids))
            near = near[ids[near] != me]
            near = near[np.argsort(-bound[near], kind="stable")]
            for at in range(0, len(near), STEP):
                if len(best) == self.k and bound[near[at]] < -best[-1][0]:
                    break
                rows = near[at : at + STEP]
                self.read += len(rows)
                scores = exact_scores(self.q[i], exact[rows])
                best = sorted([*best, *zip((-scores).tolist(), ids[rows].tolist())])[: self.k]
            self.best[i] = best

    def rows(self):
        return [(q, v, -s) for q, best in zip(self.ids.tolist(), self.best) for s, v in best]


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score). ``is_query``: over the columns of ``df``."""
    spark = df.sparkSession
    blocks = approximate(whole_numbers(df, id_col, vector, scale))
    asked = whole_numbers(df.filter(is_query), id_col, vector, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    # Queries are packed by few tasks, so that their blocks are full.
    tasks = max(1, -(-asked.count() // (4 * QUERIES)))
    plain = _blocks_written(_new_folder(spark, "queries"), QUERIES, lambda d, ids, x: (ids.astype("<i8").tobytes(), x.astype("<f8").tobytes()))
    queries = written(asked.repartition(tasks, "vec_id").mapInArrow(plain, PLACE), "query-places")
    # A shard: the places of some SHARD_BLOCKS blocks, dealt by their hash. Query blocks are listed once a shard.
    shards = max(1, -(-blocks.count() // SHARD_BLOCKS))
    shard = F.pmod(F.xxhash64("uri", "at"), F.lit(shards)).cast("int")
    dealt = blocks.groupBy("dim", shard.alias("shard")).agg(F.collect_list(F.struct("n", "uri", "at")).alias("blocks"))
    asks = queries.select("dim", F.struct("n", "uri", "at").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    items = asks.join(dealt, ["dim", "shard"]).repartition("queries", "shard").select("dim", "queries", "blocks")

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for item in batch.to_pylist():
                d, q = item["dim"], item["queries"]
                fs, path = filesystem(q["uri"])
                with fs.open_input_file(path) as f:
                    f.seek(q["at"])
                    ids = np.frombuffer(f.read(8 * q["n"]), "<i8")
                    search = Search(ids, np.frombuffer(f.read(8 * q["n"] * d), "<f8").reshape(-1, d), k)
                for b in item["blocks"]:
                    fs, path = filesystem(b["uri"])
                    with fs.open_input_file(path) as f:
                        block = Block(f, b["at"], b["n"], d, CELLS)
                        search.block(block.ids, block.codes, block.extremes, block.exact)
                if rows := search.rows():
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["query_id", "vec_id", "score"])

    found = items.mapInArrow(work, "query_id long, vec_id long, score long")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", nth.cast("int").alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


def op9_topk(spark, sf_dir):
    from .common import table

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
