"""Quality rules as a short-circuit cascade (operator 8, DataFrame functions only).

``text_stats`` computes the base figures of a text with array functions inside one projection:
no shuffle, no Python. ``order_rules`` measures each rule's cost and rejection rate on a sample
and orders the rules by rejection per cost; ``quality_cascade`` evaluates them in that order as
one CASE expression, which stops at the first rule that rejects. The order changes the cost
only: a document is kept if no rule rejects it, whichever is asked first. ``kept_rows`` wants no
figures: there the repeated words, the dearest of them, are computed last, for rows that no other rule rejects.

A rule's cost is the time of its evaluations within the tasks, some per row of the sample. The sample's tasks stop at
its size; they are run on one partition, then on more until there are rows enough, and only verdicts and times reach the driver.

Defined cases: a null text has no words, no symbols and one empty line; it fails the base rule.
Empty tables give empty results. Repeated rows and ties: each row is judged by itself. Other
columns of the input, whatever their names, neither matter nor clash: only the id and text
columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import strip_ascii, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Rows of the sample on which costs and rejection rates are estimated; it decides the order only.
SAMPLE_ROWS = 2000
REPEATS = 4  # evaluations of a rule per row of the sample


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL over ``text`` (never null), ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_lines``."""

    name: str
    rejects: str



# The default rules beyond the base rule; thresholds in whole numbers, so that both engines agree.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("word_length", "2 * word_chars < 5 * n_words OR word_chars > 12 * n_words"),
    Rule("capitals", "10 * length(regexp_replace(text, '[^A-Z]+', '')) > 7 * length(regexp_replace(text, '[^A-Za-z]+', '')) AND length(regexp_replace(text, '[^A-Z]+', '')) > 0"),
    Rule("exclamations", "5 * (length(text) - length(replace(text, '!!', ' '))) > n_words"),
)


def _covered(hashes: Column, window: int) -> Column:
    """Words in windows whose hash occurs at least twice. ``hashes``: one per window start."""

    def count(sorted_: Column) -> Column:
        same = F.filter(
            sorted_,
            lambda x, j: (x["h"] == F.get(sorted_, j - 1)["h"]) | (x["h"] == F.get(sorted_, j + 1)["h"]),
        )
        starts = F.array_sort(F.transform(same, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            starts,
            zero,
            lambda acc, p: F.struct(
                (p + window).alias("end"),
                (acc["n"] + p + window - F.greatest(acc["end"], p)).cast("long").alias("n"),
            ),
            lambda acc: acc["n"],
        )

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # The sorted array is bound to a lambda variable: it is evaluated once, not once per element.
    return F.transform(F.array(pairs), count)[0]


def _repeat_words(w: Column) -> Column:
    """Words in windows found twice or more, of an array of words, as one expression: where a CASE doesn't
    come to it, nothing of it is computed. Each array is bound to a lambda variable and evaluated once."""

    def of_windows(hashes: Column) -> Column:
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, _covered(hashes, WINDOW)).otherwise(F.lit(0).cast("long"))

    def of_words(hashed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1))
        return F.transform(F.array(F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))), of_windows)[0]

    found = F.transform(F.array(F.transform(w, lambda x: F.xxhash64(x))), of_words)[0]
    return F.when(F.size(w) >= WINDOW, found).otherwise(F.lit(0).cast("long"))


def text_stats(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), repeats: bool = True) -> DataFrame:
    """``keep`` columns (as __k0, __k1, ...), ``text`` (null: empty) and the base figures. Without ``repeats``: the
    words (__w) in place of ``n_repeat_words``."""
    kept = [f"__k{i}" for i in range(len(keep))]
    t = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    w = t.select("*", words(F.col("text")).alias("__w"), F.split("text", "\n").alias("__lines"))
    hashed = F.transform("__w", lambda x: F.xxhash64(x)).alias("__wh") if repeats else F.col("__w")
    h = w.select(
        *kept,
        "text",
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.expr("cast(regexp_count(text, '[#*$%&|<>]') as bigint)").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.filter("__lines", lambda x: strip_ascii(x) != "").alias("__full"),
        hashed,
    )
    n_dup_lines = (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long").alias("n_dup_lines")
    if not repeats:
        return h.select(*kept, "text", "n_words", "word_chars", "n_symbols", "n_lines", n_dup_lines, "__w")
    s = h.select(
        *kept,
        "text",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        n_dup_lines,
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("__wh", i, WINDOW)),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("__hs"),
    )
    return s.select(
        *kept,
        "text",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.when(F.size(F.array_distinct("__hs")) == F.size("__hs"), F.lit(0).cast("long"))
        .otherwise(_covered(F.col("__hs"), WINDOW))
        .alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def order_rules(stats: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second of evaluation, best first, as measured on a sample of
    at most ``sample_rows`` rows. Ties keep the given order; on an empty sample nothing changes."""
    now = "cast(reflect('java.lang.System', 'nanoTime') AS bigint)"
    hits = f"aggregate(sequence(1, {REPEATS}), 0, (__n, __i) -> __n + if({{}}, 1, 0))"
    # A struct's fields are evaluated in order.
    timed = [F.expr(f"named_struct('began', {now}, 'hits', {hits.format(r.rejects)}, 'ended', {now})").alias(f"__r{i}") for i, r in enumerate(rules)]
    sample = stats.select(*timed).take(sample_rows) if rules else []
    rate = {}
    for i, r in enumerate(rules):
        spent = sum(row[i].ended - row[i].began for row in sample)
        rate[r.name] = sum(row[i].hits for row in sample) / max(spent, 1)
    return sorted(rules, key=lambda r: -rate[r.name])


def cascade(rules: Sequence[Rule]) -> Column:
    """False at the first rule, in order, that rejects; true if none does."""
    verdict = F
    for r in rules:
        verdict = verdict.when(F.expr(r.rejects), F.lit(False))
    return verdict.otherwise(F.lit(True)) if rules else F.lit(True)


def quality_cascade(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per document: ``keep`` columns (default: the id), the base figures,
    ``base_failed`` and ``kept``. The base rule is the cascade's first, its figures being wanted
    for every row."""
    keep = list(keep) if keep is not None else [id_col]
    ordered = order_rules(text_stats(docs, text, [], repeats=False), rules, sample_rows)
    stats = text_stats(docs, text, keep)
    out = stats.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(cascade(ordered)).alias("kept"),
    )
    return out


def kept_rows(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with the same columns."""
    ordered = order_rules(text_stats(docs, text, [], repeats=False), rules, sample_rows)
    repeated = 100 * _repeat_words(F.col("__w")) > MAX_REPEAT_PERCENT * F.col("n_words")
    verdict = F.when(F.col("n_words") < MIN_WORDS, F.lit(False)).when(~cascade(ordered), F.lit(False)).otherwise(~repeated).alias("__kept")
    # A row number keeps the optimizer from pushing the filter below the projections, which would
    # write every figure's expression out at each of its uses.
    judged = text_stats(docs, text, docs.columns, repeats=False).select("*", verdict, F.monotonically_increasing_id().alias("__row"))
    good = judged.filter("__kept AND __row >= 0")
    return good.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(docs.columns)])


QUALITY_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         string_split(text, chr(10)) AS lines
  FROM t
),
f AS (
  SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines,
         len(w) AS n_words,
         CASE WHEN len(w) >= 8 THEN list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' ')) ELSE []::VARCHAR[] END AS wins
  FROM w
),
rep AS (
  SELECT doc_id, text, count(*) AS n_repeat_words
  FROM (
    SELECT DISTINCT doc_id, text, p + o AS word
    FROM (SELECT doc_id, text, p, count(*) OVER (PARTITION BY doc_id, text, win) AS n
          FROM (SELECT DISTINCT doc_id, text, unnest(wins) AS win, unnest(range(len(wins))) AS p FROM f)) q
    CROSS JOIN range(8) AS r(o)
    WHERE n >= 2
  ) covered
  GROUP BY ALL
),
s AS (
  SELECT f.doc_id, f.text, f.n_words,
         length(array_to_string(w, '')) AS word_chars,
         length(f.text) - length(regexp_replace(f.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines,
         len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines,
         coalesce(rep.n_repeat_words, 0) AS n_repeat_words
  FROM f LEFT JOIN rep ON rep.doc_id IS NOT DISTINCT FROM f.doc_id AND rep.text = f.text
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
       AND NOT 10 * n_symbols > n_words
       AND NOT 2 * n_dup_lines > n_lines
       AND NOT (2 * word_chars < 5 * n_words OR word_chars > 12 * n_words)
       AND NOT (10 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 7 * length(regexp_replace(text, '[^A-Za-z]+', '', 'g'))
                AND length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 0)
       AND NOT 5 * (length(text) - length(replace(text, '!!', ' '))) > n_words AS kept
FROM b
"""


def op8_quality(spark, sf_dir):
    from .common import table

    return quality_cascade(table(spark, sf_dir, "documents"))
