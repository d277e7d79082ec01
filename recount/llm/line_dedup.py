"""Corpus-wide line deduplication (operator 7, DataFrame functions only).

1. ``line_rows``: one row per line long enough to count: the hash of its key, document, position.
   Written once to the shared folder; texts do not travel with the lines.
2. The rows are range-partitioned by (hash, document, position), so that the rows of a frequent
   line are spread over as many partitions as their number asks for, and sorted by document
   and position within a hash. A streaming window marks the first occurrence within a document.
3. Per hash: number of documents and the document that keeps the line (the largest id), combined
   in each range before one small shuffle; a frequent line arrives as one row per range.
4. Lines of over-frequent hashes elsewhere are dropped. Result: per document a compressed
   bitmap, its non-zero 64-bit words ``(word, bits)``; documents that lose nothing have no row.

The key's hash has 96 bits (xxhash64 and murmur3 of different inputs).

Defined cases: a null or empty text is one empty line. A null id counts as a document smaller
than any other; lines found only under null ids all stay. Each row is a document of its own, so
repeated rows count severally; rows that share the largest id all keep the line. Empty tables
give empty results. Other columns are carried along unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, null_safe, packed, row_key, strip_ascii, text_or_empty, unpacked, written

MIN_CHARS = 20
MIN_DOCS = 3


def _folded(key: Column) -> Column:
    """A value equal for two keys iff they are equal after lower-casing A-Z alone.

    Read as Latin-1, UTF-8 bytes of a lead byte are lower-cased too, but how many continuation
    bytes follow still tells which lead byte it was, so distinct texts stay distinct."""
    return F.lower(F.decode(F.encode(key, "UTF-8"), "ISO-8859-1"))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    t = text_or_empty(text)
    lines = docs.select(*row_key(id_col, t), F.posexplode(F.split(t, "\n")).alias("__pos", "__line"))
    keyed = lines.select(*KEY, "__pos", strip_ascii(F.col("__line")).alias("__line")).filter(F.length("__line") >= min_chars)
    folded = keyed.select(*KEY, "__pos", _folded(F.col("__line")).alias("__line"))
    return folded.select(*KEY, "__pos", F.xxhash64("__line").alias("__h1"), F.hash(F.reverse("__line")).alias("__h2"))


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``lines`` that go."""
    n = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = ["__h1", "__h2", "__id", "__t1", "__t2"]
    ranged = lines.repartitionByRange(n, *by).sortWithinPartitions(*by, "__pos")
    # The range partitioning is by these very columns: the window adds no shuffle.
    # A repeated row repeats its positions: as many documents as the first position has rows.
    copies = F.count(F.lit(1)).over(Window.partitionBy(*by).orderBy("__pos").rangeBetween(0, 0))
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("__pos"))
    first = ranged.select("*", nth.alias("__nth"), copies.alias("__copies")).filter("__nth = 1")
    frequent = (
        first.groupBy("__h1", "__h2")
        .agg(F.sum("__copies").alias("__docs"), F.max("__id").alias("__keeper"))
        .filter((F.col("__docs") >= min_docs) & F.col("__keeper").isNotNull())
        .select(F.col("__h1").alias("__f1"), F.col("__h2").alias("__f2"), "__keeper")
    )
    hit = lines.join(frequent, (F.col("__h1") == F.col("__f1")) & (F.col("__h2") == F.col("__f2")))
    return hit.filter(F.col("__id").isNull() | (F.col("__id") < F.col("__keeper"))).select(*KEY, "__pos")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """Per document (``__id, __t1, __t2``): ``drop_words`` array<struct<word, bits>>, the non-zero
    words of the bitmap of its dropped lines, in order; ``n_dropped``."""
    words = dropped.groupBy(*KEY, F.floor(F.col("__pos") / 64).cast("int").alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, __pos % 64)")).alias("__bits")
    )
    return words.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__word").alias("word"), F.col("__bits").alias("bits")))).alias("drop_words"),
        F.sum(F.bit_count("__bits")).cast("long").alias("n_dropped"),
    )


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The operator: compressed bitmaps of the lines to drop, per document that loses any."""
    lines = written(line_rows(docs, id_col, text, min_chars), "lines")
    return drop_bitmaps(dropped_lines(lines, min_docs))


def _kept(t: Column) -> Column:
    """The lines whose bit is not set, joined; ``drop_words`` null: the text itself."""
    lines = F.split(t, "\n")
    last = F.element_at("drop_words", -1)["word"]
    as_map = F.map_from_entries("drop_words")

    def pick(dense: Column) -> Column:
        return F.filter(
            lines,
            lambda _, i: F.coalesce(F.get(dense, F.floor(i / 64).cast("int")), F.lit(0).cast("long")).bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(i, F.lit(64)))
            )
            == 0,
        )

    dense = F.transform(F.array(as_map), lambda m: F.transform(F.sequence(F.lit(0), last), lambda k: F.coalesce(F.element_at(m, k), F.lit(0).cast("long"))))[0]
    return F.when(F.col("drop_words").isNull(), t).otherwise(F.array_join(F.transform(F.array(dense), pick)[0], "\n"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``__kept_text`` (never null) and ``__n_dropped``."""
    t = text_or_empty(text)
    left = packed(docs, *row_key(id_col, t), t.alias("__text"))
    right = bitmaps.select(*[F.col(c).alias(f"__r{c}") for c in KEY], "drop_words", F.col("n_dropped").alias("__n_dropped"))
    j = left.join(right, null_safe(left, right, KEY, "__r"), "left")
    return j.select(
        *unpacked(docs.columns),
        _kept(F.col("__text")).alias("__kept_text"),
        F.coalesce("__n_dropped", F.lit(0).cast("long")).alias("__n_dropped"),
    )


LINE_DEDUP_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM t)),
k AS (SELECT doc_id, pos, line,
             translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id < f.keeper AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op7_line_dedup(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_bitmaps(docs, line_bitmaps(docs))
    return out.select(
        "doc_id",
        F.size(F.split(text_or_empty("text"), "\n")).cast("long").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.encode("__kept_text", "UTF-8"), 256).alias("kept_sha256"),
    )
