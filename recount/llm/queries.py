"""Queries of the training-data operators and their SQL, as the entry module registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment, bpe, compact_windows, conversation_trie, line_dedup, packing, quality, simhash, suffix_array, token_ids, topk, warc,
    weighted_sampling,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.op1_warc,
    "op2_simhash": simhash.op2_simhash,
    "op3_bpe": bpe.op3_bpe,
    "op4_packing": packing.op4_packing,
    "op5_compact_windows": compact_windows.op5_compact_windows,
    "op6_suffix_array": suffix_array.op6_suffix_array,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_quality": quality.op8_quality,
    "op9_topk": topk.op9_topk,
    "op10_token_ids": token_ids.op10_token_ids,
    "op11_alignment": alignment.op11_alignment,
    "op12_conversation_trie": conversation_trie.op12_conversation_trie,
    "op13_weighted_sampling": weighted_sampling.op13_weighted_sampling,
}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op1_warc": warc.WARC_SQL,
    "op7_line_dedup": line_dedup.LINE_DEDUP_SQL,
    "op8_quality": quality.QUALITY_SQL,
    "op9_topk": topk.TOPK_SQL,
    "op12_conversation_trie": conversation_trie.TRIE_SQL,
}
