"""The training-data operators' queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontaminate, language_model, line_dedup, mixing, quotes, simhash, substrings, suffix_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_language_model": language_model.op2_language_model,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_simhash": simhash.op4_simhash,
    "op5_suffixes": suffix_dedup.op5_suffixes,
    "op6_substrings": substrings.op6_substrings,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_neighbours": ann.op8_neighbours,
    "op9_mixing": mixing.op9_mixing,
    "op10_quotes": quotes.op10_quotes,
    "quoted_replies": quotes.quoted_replies,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op5_suffixes": suffix_dedup.SQL,
    "op6_substrings": substrings.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op9_mixing": mixing.SQL,
    "op10_quotes": quotes.SQL,
    "quoted_replies": quotes.QUOTED_SQL,
}
