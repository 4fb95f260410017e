"""Queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import (chat, decontaminate, fim, host_rules, line_dedup, mixing, quality, resampling, sharding, simhash, toxicity,
                            url_filter, warc)
from cohortflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]



def _labelled(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": _labelled(toxicity.query),
    "op2_quality": _labelled(quality.query),
    "op3_warc_dictionary": lambda spark, sf_dir: warc.query(spark, table(spark, sf_dir, "pages")),
    "op4_decontamination": lambda spark, sf_dir: decontaminate.query(table(spark, sf_dir, "documents"),
                                                                     table(spark, sf_dir, "benchmark")),
    "op5_kd_sharding": lambda spark, sf_dir: sharding.query(table(spark, sf_dir, "documents")),
    "op6_simhash": lambda spark, sf_dir: simhash.query(table(spark, sf_dir, "documents")),
    "op7_line_dedup": lambda spark, sf_dir: line_dedup.query(table(spark, sf_dir, "pages")),
    "op8_source_mixing": lambda spark, sf_dir: mixing.query(table(spark, sf_dir, "documents")),
    "op9_chat_parts": lambda spark, sf_dir: chat.query(spark, table(spark, sf_dir, "conversations")),
    "op10_host_rules": lambda spark, sf_dir: host_rules.query(table(spark, sf_dir, "documents")),
    "op11_link_graph": lambda spark, sf_dir: url_filter.query(table(spark, sf_dir, "pages")),
    "op12_fill_in_middle": lambda spark, sf_dir: fim.query(table(spark, sf_dir, "documents")),
    "op13_importance_resampling": lambda spark, sf_dir: resampling.query(table(spark, sf_dir, "documents"),
                                                                         table(spark, sf_dir, "benchmark")),
}

ORACLE: dict[str, str] = {
    "op4_decontamination": decontaminate.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op8_source_mixing": mixing.SQL,
    "op9_chat_parts": chat.SQL,
    "op10_host_rules": host_rules.SQL,
    "op11_link_graph": url_filter.SQL,
    "op12_fill_in_middle": fim.SQL,
}
