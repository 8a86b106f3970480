"""Registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import (
    chat_template,
    decontaminate,
    hidden_markov,
    language,
    license_scan,
    ngram_join,
    order_minhash,
    periodic_runs,
    token_align,
    token_codec,
    token_counts,
    toxicity,
    url_rules,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_bpe_codec": token_codec.op1,
        "op2_language_id": language.op2,
        "op3_url_rules": url_rules.op3,
        "op4_toxicity": toxicity.op4,
        "op5_decontaminate": decontaminate.op5,
        "op6_order_minhash": order_minhash.op6,
        "op7_token_counts": token_counts.op7,
        "op8_chat_format": chat_template.op8,
        "op9_ngram_join": ngram_join.op9,
        "op10_license_scan": license_scan.op10,
        "op11_token_align": token_align.op11,
        "op12_markov_score": hidden_markov.op12,
        "op13_periodic_runs": periodic_runs.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_decontaminate": decontaminate.ORACLE,
        "op8_chat_format": chat_template.ORACLE,
        "op9_ngram_join": ngram_join.ORACLE,
        "op10_license_scan": license_scan.oracle(),
    }
