"""Removal of long repeated substrings by per-shard suffix arrays (operator 6).

Bytes covered by a ``length``-byte string that also starts elsewhere go. Exact, in these steps:

1. ``runs``: each window of ``length`` bytes has a smallest hash among its ``length // 4``-byte
   strings. Equal windows have equal smallest hashes, so a window whose value nothing else has
   can't repeat. Consecutive windows of one value form a run; every window start is in one run.
   Runs of a value seen once in the corpus end here: nine tenths of a usual text.
2. ``candidates``: the other runs. Equal runs (by a 128-bit digest of their bytes) are one slice
   with a weight, so copies neither travel nor are sorted twice.
3. Slices are dealt to shards by value; equal strings meet in a shard. The slices of a frequent
   value are salted over as many shards as their bytes ask for. A shard of at most 2**20 bytes is
   sorted by Larsson-Sadakane refinement (``refine``): prefix doubling in which only unsorted
   groups take part. Kasai's common prefixes (``common_prefixes``) of neighbouring starts tell
   which windows repeat; a slice of weight two or more repeats as a whole.
4. Shards of one salted value are merged by binary search in the sorted digests of their windows
   (``merge``), dealt by digest, so that no task holds the whole value.
5. Repeated windows become byte intervals of the documents, and those documents alone are cut.

Defined cases: a null text is empty; texts below ``length`` lose nothing. Texts of any length are
hashed in chunks. Repeated rows are separate documents with equal bytes: they lose everything of
``length`` bytes or more. Null ids are ids like any other. Empty tables give empty results. Columns
other than id and text are carried along unread by ``without_repeats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import KEY, null_safe, packed, row_key, text_or_empty, unpacked, written

LENGTH = 400
SHARD_BITS = 20
SHARD = 1 << SHARD_BITS  # bytes of a suffix array; positions and ranks pack into one 64-bit key
CHUNK = 1 << 20  # bytes hashed at a time
MAX_RUN = 1 << 12  # starts of a run; longer ones are cut
SEEDS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd bases of the window hashes


# --- hashes of windows ------------------------------------------------------------------------


def _powers(n: int, base: int):
    import numpy as np

    p = np.ones(n, np.uint64)
    done = 1
    while done < n:
        k = min(done, n - done)
        p[done : done + k] = p[:k] * np.uint64(pow(base, done, 1 << 64))
        done += k
    return p


class WindowHash:
    """Polynomial hashes modulo 2**64 of all windows of ``width`` bytes of a buffer, mixed."""

    def __init__(self, most: int, base: int):
        self.up, self.down = _powers(most + 1, base), _powers(most + 1, pow(base, -1, 1 << 64))

    def __call__(self, buf, width: int):
        import numpy as np

        n = len(buf)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        x = (total[width:] - total[:-width]) * self.down[: n - width + 1]
        for mul in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x ^= x >> np.uint64(33)
            x *= np.uint64(mul)
        x ^= x >> np.uint64(33)
        return x


def sliding(x, width: int, least: bool):
    """Minimum (or maximum) of every window of ``width`` values, by block prefixes and suffixes."""
    import numpy as np

    f, m = (np.minimum, len(x)) if least else (np.maximum, len(x))
    pad = np.full(-(-m // width) * width, 2**64 - 1 if least else 0, np.uint64)
    pad[:m] = x
    blocks = pad.reshape(-1, width)
    before = f.accumulate(blocks, axis=1).ravel()
    after = f.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(after[: m - width + 1], before[width - 1 : m])


def runs_of(buf, starts, length: int, hasher: WindowHash):
    """``buf``: pieces of texts end to end, beginning at ``starts``. Runs, as (start, end, value,
    may hold equal windows of its own) of windows that lie within a piece."""
    import numpy as np

    width = max(1, length // 4)
    reach = length - width + 1
    h = hasher(buf, width)
    m = sliding(h, reach, True)
    edge = np.zeros(len(m) + 1, bool)
    edge[0] = True
    edge[1:-1] = m[1:] != m[:-1]
    ends = np.concatenate((starts[1:], [len(buf)]))
    last = np.maximum(ends - length + 1, starts)  # the first start of the piece that doesn't fit
    edge[np.minimum(starts, len(m))] = True
    edge[np.minimum(last, len(m))] = True
    st = np.flatnonzero(edge[:-1])
    en = np.concatenate((st[1:], [len(m)]))
    fits = st < last[np.searchsorted(starts, st, side="right") - 1]
    st, en = st[fits], en[fits]
    if len(st) and (en - st).max() > MAX_RUN:
        cut = [np.arange(a, b, MAX_RUN) for a, b in zip(st, en)]
        en = np.concatenate([np.append(c[1:], b) for c, b in zip(cut, en)])
        st = np.concatenate(cut)
    # Positions whose hash is some window's smallest; a value there twice, with no window that
    # misses both in between (at most reach apart), means that a single run can hold equal windows.
    most = sliding(np.concatenate((np.zeros(reach - 1, np.uint64), m, np.zeros(reach - 1, np.uint64))), reach, False)
    at = np.flatnonzero(h == most)
    v = h[at]
    order = np.argsort(v, kind="stable")
    sv, sp = v[order], at[order]
    near = (sv[1:] == sv[:-1]) & (sp[1:] - sp[:-1] <= reach)
    value = m[st]
    return st, en, value, np.isin(value, np.unique(sv[1:][near]))


RUN_COLUMNS = "lo long, n int, h long, d1 long, d2 long, own boolean"


def runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows (row key, lo, n, h, d1, d2, own): n window starts from byte lo on, their value h, the
    digest of their bytes, and whether equal windows may lie within the run itself."""
    t = text_or_empty(text)
    src = docs.select(*row_key(id_col, t), t.cast("binary").alias("__text")).filter(F.octet_length("__text") >= length)
    schema = src.drop("__text").schema
    for f in StructType.fromDDL(RUN_COLUMNS):
        schema = schema.add(f)

    def work(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        hasher = WindowHash(CHUNK + length, SEEDS[0])

        def found(batch, parts):
            whole = b"".join(p[2] for p in parts)
            sizes = np.array([len(p[2]) for p in parts])
            starts = np.cumsum(sizes) - sizes
            st, en, value, own = runs_of(np.frombuffer(whole, np.uint8), starts, length, hasher)
            part = np.searchsorted(starts, st, side="right") - 1
            digest = xxhash.xxh3_128_digest
            d = np.frombuffer(b"".join(digest(whole[a : b + length - 1]) for a, b in zip(st.tolist(), en.tolist())), np.int64).reshape(-1, 2)
            row = np.array([p[0] for p in parts], np.int64)[part]
            offset = np.array([p[1] for p in parts], np.int64)[part]
            keys = [batch.column(c).take(pa.array(row)) for c in KEY]
            cols = [offset + st - starts[part], (en - st).astype(np.int32), value.view(np.int64), d[:, 0], d[:, 1], own]
            return pa.RecordBatch.from_arrays([*keys, *map(pa.array, cols)], schema.names)

        for batch in batches:
            parts, size = [], 0  # (row, offset in its text, bytes)
            for i, x in enumerate(batch.column("__text")):
                data = x.as_buffer()
                for a in range(0, data.size - length + 1, CHUNK):
                    piece = data.slice(a, min(CHUNK + length - 1, data.size - a)).to_pybytes()
                    if parts and size + len(piece) > CHUNK + length - 1:
                        yield found(batch, parts)
                        parts, size = [], 0
                    parts.append((i, a, piece))
                    size += len(piece)
            if parts:
                yield found(batch, parts)

    return src.mapInArrow(work, schema)


# --- suffix arrays ----------------------------------------------------------------------------


def refine(buf, depth: int):
    """Positions of ``buf`` (at most 2**20 bytes) in the order of their next ``depth`` bytes, by
    Larsson-Sadakane refinement: a position's rank is its group's first slot; a round doubles the
    sorted prefix, sorting only groups of several members by the ranks further on. Positions
    with fewer bytes before the end stand anywhere; they don't disturb the order of the others."""
    import numpy as np

    n, bits, low = len(buf), np.uint64(SHARD_BITS), np.uint64(SHARD - 1)
    h = min(5, depth)
    pad = np.concatenate((buf, np.zeros(h, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(h):
        key = (key << np.uint64(8)) | pad[i : i + n]
    key = (key << bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    sa = (key & low).astype(np.int64)
    key >>= bits
    first = np.ones(n + 1, bool)  # of each slot: whether a group begins; a sentinel follows
    first[1:-1] = key[1:] != key[:-1]
    slots = np.arange(n)
    rank = np.zeros(n + depth, np.uint64)
    rank[sa] = np.maximum.accumulate(np.where(first[:-1], slots, 0)).astype(np.uint64)
    while h < depth:
        step = min(h, depth - h)
        open_ = np.flatnonzero(~(first[:-1] & first[1:]))
        if not len(open_):
            break
        p = sa[open_]
        key = (((rank[p] << bits) | rank[p + step]) << bits) | p.astype(np.uint64)
        key.sort()
        p = (key & low).astype(np.int64)
        key >>= bits
        sa[open_] = p
        begins = np.ones(len(p), bool)
        begins[1:] = key[1:] != key[:-1]
        first[open_] = begins
        rank[p] = np.maximum.accumulate(np.where(begins, open_, 0)).astype(np.uint64)
        h += step
    return sa


def common_prefixes(buf, order, length: int):
    """For positions in suffix order, the common prefix of each with its predecessor in that
    order, exact up to ``length``. Kasai's rule: if the predecessor of p + 1 follows that of p,
    their prefix is one byte shorter, as long as there was one; only where such a chain begins, or
    runs out, bytes are compared, eight at a time."""
    import numpy as np

    n = len(buf)
    before = np.full(n + 1, -2, np.int64)
    before[order[1:]] = order[:-1]
    p = np.sort(order[1:])
    q = before[p]
    head = np.ones(len(p), bool)
    head[1:] = (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)
    at = np.flatnonzero(head)
    span = np.diff(np.append(at, len(p)))
    pad = np.concatenate((buf, np.zeros(8, np.uint8)))
    word = np.lib.stride_tricks.sliding_window_view(pad, 8)[: n + 1].copy().view(np.uint64).ravel()
    plcp = np.zeros(len(p), np.int64)
    while len(at):
        x, y = p[at], q[at]
        lcp = np.zeros(len(at), np.int64)
        need = length + span  # beyond that, no decision of the chain is open
        live, done = np.arange(len(at)), 0
        while len(live):
            differ = word[np.minimum(x[live] + done, n)] ^ word[np.minimum(y[live] + done, n)]
            stop = differ != 0
            low = differ[stop] & (~differ[stop] + np.uint64(1))
            lcp[live[stop]] = done + np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8
            live = live[~stop]
            done += 8
            lcp[live] = done
            live = live[need[live] > done]
        known = np.minimum(span, lcp + 1)
        plcp[np.repeat(at, known) + _count(known)] = np.repeat(lcp, known) - _count(known)
        more = span > known
        at, span = (at + known)[more], (span - known)[more]
    return p, q, plcp


def _count(sizes):
    """0, 1, ... within each of the consecutive stretches of these sizes."""
    import numpy as np

    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(sizes) else 0) - np.repeat(total - sizes, sizes)


def repeated(buf, is_start, length: int):
    """Of the starts in a shard's buffer, those whose next ``length`` bytes another start has."""
    import numpy as np

    sa = refine(buf, length)
    order = sa[is_start[sa]]
    hit = np.zeros(len(buf), bool)
    if len(order) > 1:
        p, q, lcp = common_prefixes(buf, order, length)
        long_ = lcp >= length
        hit[p[long_]] = True
        hit[q[long_]] = True
    return hit


def _ranges(flags):
    """(begin, end) pairs of the true stretches of a boolean array, as int32 bytes."""
    import numpy as np

    d = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.stack((np.flatnonzero(d == 1), np.flatnonzero(d == -1)), axis=1).astype("<i4").tobytes()


FOUND = "h long, d1 long, d2 long, starts binary, bucket int, digests binary"


def shards(slices: DataFrame, length: int = LENGTH) -> DataFrame:
    """``slices`` (h, salt, salts, d1, d2, weight, n, bytes), dealt and sorted by (h, salt): rows of
    ``starts`` that repeat within the shard (ranges from the slice's first start), and, for values
    of several shards, per bucket the sorted digests of the shard's windows."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        hashers = [WindowHash(SHARD, s) for s in SEEDS]

        def one(rows, several):
            """rows: (h, salts, d1, d2, weight, n, bytes)"""
            buf = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
            size = np.array([len(r[6]) for r in rows])
            n = np.array([r[5] for r in rows])
            base = np.cumsum(size) - size
            is_start = np.zeros(len(buf), bool)
            for b, k in zip(base.tolist(), n.tolist()):
                is_start[b : b + k] = True
            hit = repeated(buf, is_start, length)
            for i in np.flatnonzero(np.array([r[4] for r in rows]) > 1).tolist():
                hit[base[i] : base[i] + n[i]] = True
            out = []
            for r, b in zip(rows, base.tolist()):
                f = hit[b : b + r[5]]
                if f.any():
                    out.append((r[0], r[2], r[3], _ranges(f), None, None))
            if several:
                at = np.flatnonzero(is_start)
                owner = np.searchsorted(base, at, side="right") - 1
                kind = np.dtype([("a", "<u8"), ("b", "<u8"), ("d1", "<i8"), ("d2", "<i8"), ("off", "<i4"), ("hit", "?")])
                rec = np.zeros(len(at), kind)
                rec["a"], rec["b"] = hashers[0](buf, length)[at], hashers[1](buf, length)[at]
                rec["d1"] = np.array([r[2] for r in rows], np.int64)[owner]
                rec["d2"] = np.array([r[3] for r in rows], np.int64)[owner]
                rec["off"], rec["hit"] = at - base[owner], hit[at]
                _, keep = np.unique(rec[["a", "b"]], return_index=True)  # of a class, one: all are hit, or it is alone
                rec = rec[keep]
                bucket = (rec["a"] >> np.uint64(32)) % np.uint64(max(1, rows[0][1]))
                for k in np.unique(bucket).tolist():
                    out.append((rows[0][0], 0, 0, None, k, rec[bucket == k].tobytes()))
            return out

        def batch_of(out):
            cols = list(zip(*out))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["h", "d1", "d2", "starts", "bucket", "digests"])

        def groups():
            """(rows, whether the value has more shards): whole (h, salt) groups together, cut only
            where one is larger than a shard."""
            ready, size, key, group, group_size, split = [], 0, None, [], 0, False

            for batch in batches:
                cols = [batch.column(c) for c in ("h", "salt", "salts", "d1", "d2", "weight", "n", "bytes")]
                ints = [c.to_pylist() for c in cols[:7]]
                for i in range(batch.num_rows):
                    h, salt, salts, d1, d2, weight, n = (c[i] for c in ints)
                    data = cols[7][i].as_buffer().to_pybytes()
                    if (h, salt) != key:
                        if group:
                            if split or group[0][1] > 1:
                                yield group, True
                            elif size + group_size > SHARD:
                                if ready:
                                    yield ready, False
                                ready, size = group, group_size
                            else:
                                ready, size = ready + group, size + group_size
                        key, group, group_size, split = (h, salt), [], 0, False
                    if group_size + len(data) > SHARD:
                        yield group, True
                        group, group_size, split = [], 0, True
                    group.append((h, salts, d1, d2, weight, n, data))
                    group_size += len(data)
            if group:
                if split or group[0][1] > 1:
                    yield group, True
                else:
                    if ready and size + group_size > SHARD:
                        yield ready, False
                        ready = []
                    ready = ready + group
            if ready:
                yield ready, False

        for rows, several in groups():
            if out := one(rows, several):
                yield batch_of(out)

    return slices.mapInArrow(work, FOUND)


def merge(digests: DataFrame) -> DataFrame:
    """Across the shards of a value: windows whose digest another shard has, found by binary
    search of each shard's sorted digests in those before it. Input dealt and sorted by (h, bucket)."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        kind = np.dtype([("a", "<u8"), ("b", "<u8"), ("d1", "<i8"), ("d2", "<i8"), ("off", "<i4"), ("hit", "?")])

        def done(h, known):
            new = known[known["hit"] == 2] if known is not None else []
            rows = {}
            for r in new:
                rows.setdefault((int(r["d1"]), int(r["d2"])), []).append(int(r["off"]))
            if not rows:
                return None
            starts = [np.array([(o, o + 1) for o in sorted(v)], "<i4").tobytes() for v in rows.values()]
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([h] * n, pa.int64()), pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1] for k in rows], pa.int64()), pa.array(starts, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                ["h", "d1", "d2", "starts", "bucket", "digests"],
            )

        state = np.dtype([(c, kind[c]) for c in ("a", "b", "d1", "d2", "off")] + [("hit", "i1")])
        key, known = None, None
        for batch in batches:
            for h, bucket, data in zip(batch.column("h").to_pylist(), batch.column("bucket").to_pylist(), batch.column("digests")):
                rec = np.frombuffer(data.as_buffer(), kind).astype(state)  # hit 0: alone so far, 1: told before, 2: found here
                if (h, bucket) != key:
                    if (out := done(key[0], known) if key else None) is not None:
                        yield out
                    key, known = (h, bucket), rec
                    continue
                at = np.minimum(np.searchsorted(known["a"], rec["a"]), len(known) - 1)
                same = (known["a"][at] == rec["a"]) & (known["b"][at] == rec["b"])
                mine = known["hit"][at[same]]
                known["hit"][at[same]] = np.where(mine == 0, 2, mine)
                alone = same & (rec["hit"] == 0)
                rec["hit"][alone] = 2
                # A window found in several shards stays in the table once for searching, and
                # once per place to be told.
                known = np.concatenate((known, rec[~same | alone]))
                known = known[np.lexsort((known["hit"] != 1, known["b"], known["a"]))]
        if (out := done(key[0], known) if key else None) is not None:
            yield out

    return digests.select("h", "bucket", "digests").mapInArrow(work, FOUND)


# --- the operator -----------------------------------------------------------------------------


def _cut(text, intervals):
    """(removed bytes, spans, the rest) of a text and its sorted disjoint intervals."""
    parts, at, gone = [], 0, 0
    for a, b in intervals:
        parts.append(text[at:a])
        gone += b - a
        at = b
    parts.append(text[at:])
    return gone, len(intervals), b"".join(parts)


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """Rows that lose bytes: ``__r`` + row key, n_removed, n_spans, kept (binary; ``as_text``:
    string, without characters of which only a part was covered). Equal rows have equal results."""
    t = text_or_empty(text)
    found = written(runs(docs, id_col, text, length), "runs")
    often = found.groupBy("h").agg(F.count(F.lit(1)).alias("times"), F.max("own").alias("any_own")).filter("times > 1 OR any_own").select(F.col("h").alias("__h"))
    cand = written(found.join(often, F.col("h") == F.col("__h")).drop("__h", "own"), "candidates")
    place = F.struct(*KEY, "lo")
    slices = cand.groupBy("h", "d1", "d2").agg(F.count(F.lit(1)).alias("weight"), F.min(place).alias("place"), F.max("n").alias("n"))
    slices = written(slices, "slices")
    size = slices.groupBy("h").agg(F.sum(F.col("n") + (length - 1)).alias("size"))
    salts = size.select(F.col("h").alias("__h"), F.ceil(F.col("size") * 2 / SHARD).cast("int").alias("__s"))
    dealt = slices.join(salts, F.col("h") == F.col("__h")).select(
        *[F.col(f"place.{c}").alias(f"__c{c}") for c in KEY],
        F.struct("h", F.when(F.col("__s") > 2, F.pmod(F.col("d1"), F.col("__s"))).otherwise(F.lit(0)).cast("int").alias("salt"), F.when(F.col("__s") > 2, F.col("__s")).otherwise(F.lit(1)).alias("salts"), "d1", "d2", "weight", "n", F.col("place.lo").alias("lo")).alias("slice"),
    )
    # The candidate documents, once each, with the slices that are read from them.
    of_doc = cand.select(*[F.col(c).alias(f"__c{c}") for c in KEY], F.lit(None).cast(dealt.schema["slice"].dataType).alias("slice")).distinct().unionByName(dealt)
    of_doc = of_doc.groupBy(*[f"__c{c}" for c in KEY]).agg(F.collect_list("slice").alias("slices"))
    rows = docs.select(*row_key(id_col, t), t.alias("__text"))
    texts = written(rows.join(of_doc, null_safe(rows, of_doc, KEY, "__c")).select(*KEY, "__text", "slices"), "candidate-texts")

    read = texts.filter(F.size("slices") > 0).select(F.col("__text").cast("binary").alias("t"), F.explode("slices").alias("s"))
    bytes_ = F.substring("t", F.col("s.lo").cast("int") + 1, F.col("s.n") + (length - 1))
    read = read.select("s.h", "s.salt", "s.salts", "s.d1", "s.d2", "s.weight", "s.n", bytes_.alias("bytes"))
    within = written(shards(read.repartition("h", "salt").sortWithinPartitions("h", "salt"), length), "repeats")
    across = merge(within.filter("digests IS NOT NULL").repartition("h", "bucket").sortWithinPartitions("h", "bucket"))
    repeats = within.filter("starts IS NOT NULL").unionByName(across).select("h", "d1", "d2", "starts")

    r = repeats.select(*[F.col(c).alias(f"__{c}") for c in ("h", "d1", "d2")], "starts")
    hits = cand.join(r, (F.col("h") == F.col("__h")) & (F.col("d1") == F.col("__d1")) & (F.col("d2") == F.col("__d2")))
    per_doc = hits.groupBy(*[F.col(c).alias(f"__c{c}") for c in KEY]).agg(F.collect_list(F.struct("lo", "starts")).alias("hits"))
    once = texts.select(*KEY, F.col("__text").cast("binary").alias("__text"))
    todo = once.join(per_doc, null_safe(once, per_doc, KEY, "__c")).select(*KEY, "__text", "hits")
    schema = todo.select(*[F.col(c).alias(f"__r{c}") for c in KEY], F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("__text").cast("string" if as_text else "binary").alias("kept")).schema

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for data, hits_ in zip(batch.column("__text"), batch.column("hits").to_pylist()):
                parts = [np.frombuffer(x["starts"], "<i4").astype(np.int64) + x["lo"] for x in hits_]
                a = np.concatenate(parts).reshape(-1, 2)
                a = a[np.argsort(a[:, 0], kind="stable")]
                a[:, 1] += length - 1
                ends = np.maximum.accumulate(a[:, 1])
                new = np.ones(len(a), bool)
                new[1:] = a[1:, 0] > ends[:-1]
                st = a[new, 0]
                en = ends[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]
                out.append(_cut(data.as_buffer().to_pybytes(), list(zip(st.tolist(), en.tolist()))))
            cols = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2].decode("utf-8", "ignore") if as_text else x[2] for x in out])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in KEY], *cols], schema.names)

    return todo.mapInArrow(work, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with ``__kept_text``, the remaining bytes as text (never null). A character of which
    only a part was covered goes with it."""
    t = text_or_empty(text)
    cut = written(cut_texts(docs, id_col, text, length, as_text=True), "cut-texts").dropDuplicates([f"__r{c}" for c in KEY])
    left = packed(docs, *row_key(id_col, t), t.alias("__text"))
    j = left.join(cut, null_safe(left, cut, KEY, "__r"), "left")
    return j.select(*unpacked(docs.columns), F.coalesce("kept", "__text").alias("__kept_text"))


def op6_suffix_array(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = cut_texts(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    cut = written(cut, "cut-digests").dropDuplicates([f"__r{c}" for c in KEY])
    t = text_or_empty("text")
    left = docs.select("doc_id", *row_key("doc_id", t), F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t.cast("binary"), 256).alias("__sha"))
    j = left.join(cut, null_safe(left, cut, KEY, "__r"), "left")
    zero = F.lit(0).cast("long")
    return j.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "__sha").alias("kept_sha256"),
    )
