"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontaminate, infilling, language, lines, mixing, neighbours, pii, quality_rules, simhash, substrings, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_token_ids": tokens.op2_token_ids,
    "op3_language_id": language.op3_language_id,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_simhash_dedup": simhash.op5_simhash_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_quality_classifier": neighbours.op7_quality_classifier,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_pii_surrogates": pii.op10_pii_surrogates,
    "op11_prefix_trie": conversations.op11_prefix_trie,
    "op12_warc": warc.op12_warc,
    "op13_fill_in_middle": infilling.op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op8_substring_dedup": substrings.OP8_SQL,
    "op11_prefix_trie": conversations.OP11_SQL,
    "op12_warc": warc.OP12_SQL,
    "op13_fill_in_middle": infilling.OP13_SQL,
}
