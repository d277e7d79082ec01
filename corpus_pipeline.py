"""A corpus pipeline of the training-data operators: each stage reads what its predecessor kept.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recount.llm import line_dedup, packing, quality, simhash, suffix_array
from recount.llm.common import table, written


def _with_text(docs: DataFrame, new: DataFrame, text: str) -> DataFrame:
    """``new`` with the columns of ``docs``: ``text`` replaced where it changed, ``n_chars`` with it."""
    changed = F.coalesce(F.col("text"), F.lit("")) != F.col(text)
    value = {
        "text": F.when(changed, F.col(text)).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
    }
    return new.select(*[value[c].alias(c) if c in value else F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.kept_rows(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters in three or more documents stay in one of them."""
    return _with_text(docs, line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)), "__kept_text")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one of the smallest id stays."""
    return simhash.one_of_each(docs)


def suffix_array_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 400 bytes that start in several places go."""
    return _with_text(docs, suffix_array.without_repeats(docs), "__kept_text")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document in bins of 2048 tokens, one per source and cluster in a bin."""
    return packing.best_fit(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_array_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
