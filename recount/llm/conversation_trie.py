"""The prefix trie of conversations by adaptive radix trees over turn ids (operator 12).

A turn's id is 20 bytes: the MD5 of role and text, and the number of its words, big-endian. A
conversation's key is its turns' ids end to end, so that a prefix of turns is a prefix of bytes.

1. ``rebuilt``: one key per conversation. Turns are numbered by a window over ids alone, no texts.
2. ``distinct_keys``: copies become one key. (key's MD5, conv_id) is range-partitioned and sorted, so
   a group of copies, however large, lies in as many tasks as it needs; each task renders its stretch of decimal ids
   as chunks of ``CHUNK`` ids. SHA-256 is sequential: one task per key streams the chunks through it.
3. ``nodes``: the keys are range-partitioned and sorted, which splits a common first turn like any
   other prefix. A task builds a radix tree (``radix``) of each piece of at most ``PIECE`` bytes of keys, and emits a
   node at every byte depth that is a whole number of turns, with sums over its subtree.
4. A node whose subtree lies in several pieces is on the path of a piece's first or last key. These rows alone, two paths
   a piece, are summed up by the node's digest. What two neighbouring pieces both counted (the
   nodes on the common prefix of one's last and the other's first key; a leaf that the next piece
   goes on from) is taken off by further rows of the same sum (``corrections``).

Memory: one piece per task. A conversation's key is one value: 20 bytes a turn, about 10**8 turns at most.

Defined cases: null roles and texts are empty; null turns come first; turns of equal number are in the
order of their MD5s, and repeated rows are turns each. Rows without conv_id belong to no conversation. A
conversation without turns ends at the root. An empty table has no nodes. Texts of any length are hashed
whole. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words, written
from .radix import RadixTree, shared

WIDTH = 20  # bytes of a turn id
CHUNK = 1 << 16  # ids rendered in a row
PIECE = 32 << 20  # bytes of keys in a tree
NO_ENDS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # fixed value: SHA-256 of nothing


def turn_id(role: Column, text: Column) -> Column:
    """40 hex digits: MD5 of the turn, number of words."""
    turn = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.upper(F.md5(turn.cast("binary"))), F.lpad(F.hex(F.size(words(text)).cast("long")), 8, "0"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key): the first ``crc32(conv_id) % 4`` turns of conversation ``conv_id - conv_id % 20``,
    then the conversation's own turns after its first as many (``%`` as in SQL: of a negative id, not above zero)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    ids = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(role, text).alias("id"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id"))
    turns = written(ids.select("conv_id", place.alias("place"), "id"), "turns")
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    own = turns.withColumn("head", heads)
    base = turns.filter((F.col("conv_id") % 20 == 0) & (F.col("place") <= 3)).select(F.col("conv_id").alias("base"), "place", "id")
    convs = own.filter("place = 1").select("conv_id", "head", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    lent = convs.join(base, "base").filter("place <= head").select("conv_id", "place", "id")
    # Every conversation has a row here, also one that keeps no turn.
    kept = own.select("conv_id", "place", F.when(F.col("place") > F.col("head"), F.col("id")).alias("id"))
    parts = kept.filter("id IS NOT NULL OR place = 1").unionByName(lent)
    in_order = F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("place", "id"))))
    key = F.unhex(F.array_join(F.transform(in_order, lambda x: x["id"]), ""))
    return parts.groupBy("conv_id").agg(key.alias("key"))


def distinct_keys(convs: DataFrame) -> DataFrame:
    """(key, conv_id, n, ends): each key's smallest conversation, its conversations, and the SHA-256 of their ids."""
    n = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = written(convs.select(F.md5("key").alias("kd"), "conv_id", "key"), "keys")

    def render(batches):
        import pyarrow as pa

        names = ["kd", "key", "conv_id", "n", "text"]
        kd = key = None
        ids: list[int] = []

        def chunk():
            row = ([kd], [key], [ids[0]], [len(ids)], [",".join(map(str, ids))])
            types = (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names)

        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kd", "key", "conv_id"))):
                if ids and (a != kd or len(ids) == CHUNK):
                    yield chunk()
                    ids = []
                kd, key = a, b
                ids.append(c)
        if ids:
            yield chunk()

    def stream(batches):
        import hashlib

        import pyarrow as pa

        out, now = [], None  # now: kd, key, smallest id, n, hash

        def batch_of(rows):
            cols = zip(*rows)
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["key", "conv_id", "n", "ends"])

        for batch in batches:
            for kd, key, first, n, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or kd != now[0]:
                    if now is not None:
                        out.append((now[1], now[2], now[3], now[4].hexdigest()))
                    now = [kd, key, first, n, hashlib.sha256(text.encode())]
                    if len(out) == 4096:
                        yield batch_of(out)
                        out = []
                else:
                    now[3] += n
                    now[4].update(b"," + text.encode())
        if now is not None:
            out.append((now[1], now[2], now[3], now[4].hexdigest()))
            yield batch_of(out)

    dealt = hashed.repartitionByRange(n, "kd", "conv_id").sortWithinPartitions("kd", "conv_id")
    chunks = dealt.mapInArrow(render, "kd string, key binary, conv_id long, n long, text string")
    grouped = chunks.repartition(n, "kd").sortWithinPartitions("kd", "conv_id")
    return grouped.mapInArrow(stream, "key binary, conv_id long, n long, ends string")


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, digest binary, parent binary, part long, piece long, first binary, last binary"
)


def _arrow(ddl: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(","))])


def digests(key: bytes) -> list[bytes]:
    """The digest of every turn-aligned prefix, the empty one first."""
    import xxhash

    h = xxhash.xxh3_128()
    out = [h.digest()]
    for at in range(0, len(key), WIDTH):
        h.update(key[at : at + WIDTH])
        out.append(h.digest())
    return out


def word_counts(key: bytes) -> list[int]:
    return [int.from_bytes(key[at + WIDTH - 4 : at + WIDTH], "big") for at in range(0, len(key), WIDTH)]


def tree_nodes(rows: list[tuple]) -> list[list]:
    """Nodes of a piece: rows (key, conv_id, n, ends), sorted by distinct keys. Each is [smallest conv_id,
    depth, parent's, n_convs, n_children, n_leaves, saved, ends, on the first path, on the last path]."""
    tree = RadixTree()
    for i, (key, *_) in enumerate(rows):
        tree.insert(key, i)
    out: list[list] = []
    # Post-order without recursion. A frame: node, bytes above its prefix, its branches to come, and of its subtree so far:
    # [smallest id, conversations, leaves, saved, first row, last row, topmost nodes].
    stack = []

    def enter(node, above, lo):
        mine = [None, 0, 0, 0, len(rows), -1, []]
        if node.value is not None:
            _, conv, n, _ = rows[node.value]
            mine = [conv, n, 0, 0, node.value, node.value, []]
        stack.append((node, above, lo, node.items(), mine))

    enter(tree.root, 0, -1)
    while stack:
        node, above, lo, branches, mine = stack[-1]
        end = above + len(node.prefix)
        nxt = next(branches, None)
        if nxt is not None:
            enter(nxt[1], end + 1, end)
            continue
        stack.pop()
        conv, n, leaves, saved, first, last, tops = mine
        ends = rows[node.value][3] if node.value is not None else NO_ENDS
        for depth in range(end // WIDTH, lo // WIDTH, -1):  # turn-aligned byte depths above lo
            at = depth * WIDTH
            if depth:
                key = rows[first][0]
                saved += (n - 1) * int.from_bytes(key[at - 4 : at], "big")
            leaves = leaves or 1
            for t in tops:
                out[t][2] = conv
            out.append([conv, depth, None, n, len(tops), leaves, saved, ends if at == end else NO_ENDS, first == 0, last == len(rows) - 1])
            tops = [len(out) - 1]
        if stack:
            up = stack[-1][4]
            up[0] = conv if up[0] is None else min(up[0], conv)
            up[1] += n
            up[2] += leaves
            up[3] += saved
            up[4], up[5] = min(up[4], first), max(up[5], last)
            up[6] += tops
    return out


def _pieces(batches):
    """Node rows of a partition's pieces, and one row (``first`` and ``last`` key) per piece."""
    import pyarrow as pa
    from pyspark import TaskContext

    schema = _arrow(NODE)
    part, piece = TaskContext.get().partitionId(), 0

    def made(rows):
        first, last = rows[0][0], rows[-1][0]
        marks = digests(first), digests(last)
        found = []
        nodes = tree_nodes(rows)
        for conv, depth, up, n, children, leaves, saved, ends, on_first, on_last in nodes:
            path = marks[0] if on_first else marks[1] if on_last else None
            found.append([conv, depth, up, n, children, leaves, saved, ends, path[depth] if path else None, None, part, piece, None, None])
        for row, mark in zip(found, _parents(nodes, marks)):
            row[9] = mark
        found.append([None] * 10 + [part, piece, first, last])
        for at in range(0, len(found), 1 << 14):
            cols = zip(*found[at : at + (1 << 14)])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    rows, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and size + len(row[0]) + WIDTH > PIECE:
                yield from made(rows)
                rows, size, piece = [], 0, piece + 1
            rows.append(row)
            size += len(row[0]) + WIDTH
    if rows:
        yield from made(rows)


def _parents(nodes: list[list], marks: tuple[list[bytes], list[bytes]]) -> list[bytes | None]:
    """Of every node, its parent's digest if the parent is on a path (then others may add to it)."""
    out = [None] * len(nodes)
    open_: dict[int, list[int]] = {}  # of a depth, nodes that wait for their parent: post-order
    for i, node in enumerate(nodes):
        depth = node[1]
        if node[8] or node[9]:
            mark = marks[0 if node[8] else 1][depth]
            for child in open_.get(depth + 1, ()):
                out[child] = mark
        open_.pop(depth + 1, None)
        open_.setdefault(depth, []).append(i)
    return out


def _corrections(batches):
    """Rows (first, previous) of neighbouring pieces' keys: what both counted, as rows to be added."""
    import pyarrow as pa

    schema = _arrow(CORRECTION)
    for batch in batches:
        out = []
        for first, before in zip(batch.column("first").to_pylist(), batch.column("before").to_pylist()):
            both = shared(before, first) // WIDTH
            goes_on = both * WIDTH == len(before)  # the earlier piece took that key for a leaf
            words_, twice = word_counts(first), 0
            marks = digests(first[: both * WIDTH])
            for depth in range(both, -1, -1):
                twice += words_[depth - 1] if depth else 0
                out.append((depth, marks[depth], -1 if depth < both else 0, -1 if goes_on else 0, twice))
        cols = list(zip(*out)) if out else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


CORRECTION = "depth long, digest binary, n_children long, n_leaves long, saved_tokens long"


def nodes(keys: DataFrame) -> DataFrame:
    """One row per node of the trie of ``keys`` (key, conv_id, n, ends)."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = written(keys, "distinct-keys")
    dealt = once.repartitionByRange(n, "key").sortWithinPartitions("key")
    rows = written(dealt.mapInArrow(_pieces, NODE), "trie")
    node = rows.filter("depth IS NOT NULL").drop("part", "piece", "first", "last")
    # One row per piece: this window's single task has as many rows as there are pieces.
    before = F.lag("last").over(Window.orderBy("part", "piece"))
    borders = rows.filter("depth IS NULL").select("first", before.alias("before")).filter("before IS NOT NULL")
    twice = borders.mapInArrow(_corrections, CORRECTION)
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    partial = node.filter("digest IS NOT NULL").select("depth", "digest", "conv_id", "parent", F.nullif("ends_sha256", F.lit(NO_ENDS)).alias("ends"), *counts)
    partial = partial.unionByName(twice.withColumn("n_convs", F.lit(0).cast("long")), allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in counts]
    merged = partial.groupBy("depth", "digest").agg(F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent"), F.coalesce(F.max("ends"), F.lit(NO_ENDS)).alias("ends_sha256"), *sums)
    parents = merged.select(F.col("digest").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    cols = ["conv_id", "depth", "parent_conv_id", *counts, "ends_sha256"]
    inner = node.filter("digest IS NULL AND parent IS NULL").select(cols)
    below = node.filter("digest IS NULL AND parent IS NOT NULL").drop("parent_conv_id", "digest").unionByName(merged.drop("digest"))
    return inner.unionByName(below.join(parents, ["parent", "depth"], "left").select(cols))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    return nodes(distinct_keys(rebuilt(conversations)))


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS place FROM t),
c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
         4294967295::BIGINT) % 4 AS head
  FROM (SELECT DISTINCT conv_id FROM t) AS x
),
r AS (
  SELECT c.conv_id, n.place, n.id, n.w FROM c JOIN n ON n.conv_id = c.conv_id - c.conv_id % 20 AND n.place <= c.head
  UNION ALL
  SELECT c.conv_id, n.place, n.id, n.w FROM c JOIN n ON n.conv_id = c.conv_id AND n.place > c.head
),
k AS (
  SELECT c.conv_id, coalesce(string_agg(r.id, '' ORDER BY r.place), '') AS key, coalesce(list(r.w ORDER BY r.place) FILTER (r.w IS NOT NULL), []) AS ws
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
),
m AS (SELECT conv_id, d, left(key, 32 * d) AS prefix, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, d = len(ws) AS is_end
      FROM (SELECT *, unnest(range(len(ws) + 1)) AS d FROM k) AS x),
v AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM m GROUP BY prefix, d
),
kids AS (SELECT left(prefix, 32 * (d - 1)) AS prefix, d - 1 AS d, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
f AS (SELECT v.*, coalesce(kids.n, 0) AS n_children FROM v LEFT JOIN kids USING (prefix, d)),
s AS (
  SELECT left(prefix, 32 * up) AS prefix, up AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM f) AS x GROUP BY ALL
)
SELECT f.conv_id::BIGINT AS conv_id, f.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (prefix, d) LEFT JOIN v AS p ON f.d > 0 AND p.d = f.d - 1 AND p.prefix = left(f.prefix, 32 * (f.d - 1))
"""


def op12_conversation_trie(spark, sf_dir):
    from .common import table

    return conversation_trie(table(spark, sf_dir, "conversations"))
