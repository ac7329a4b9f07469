"""Registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapstats.llm import (
    bpe, decontaminate, fill_in_middle, line_dedup, minhash, nbsvm, periodic_runs, quality_rules, secrets, substring_dedup, suffix_dedup, token_counts,
    toxicity)
from snapstats.llm.common import documents


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": lambda s, d: line_dedup.op1_line_dedup(documents(s, d)),
        "op2_suffix_dedup": lambda s, d: suffix_dedup.op2_suffix_dedup(documents(s, d)),
        "op3_quality_rules": lambda s, d: quality_rules.op3_quality_rules(documents(s, d), spark_table(s, d, "labels")),
        "op4_substring_dedup": lambda s, d: substring_dedup.op4_substring_dedup(documents(s, d)),
        "op5_token_counts": lambda s, d: token_counts.op5_token_counts(documents(s, d)),
        "op6_minhash": lambda s, d: minhash.op6_minhash(documents(s, d)),
        "op7_bpe": lambda s, d: bpe.op7_bpe(documents(s, d)),
        "op8_secrets": lambda s, d: secrets.op8_secrets(documents(s, d)),
        "op9_decontaminate": lambda s, d: decontaminate.op9_decontaminate(documents(s, d), spark_table(s, d, "benchmark")),
        "op10_quality": lambda s, d: nbsvm.op10_quality(documents(s, d), spark_table(s, d, "labels")),
        "op11_periodic_runs": lambda s, d: periodic_runs.op11_periodic_runs(documents(s, d)),
        "op12_fill_in_middle": lambda s, d: fill_in_middle.op12_fill_in_middle(documents(s, d)),
        "op13_toxicity": lambda s, d: toxicity.op13_toxicity(documents(s, d), spark_table(s, d, "labels")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.oracle(),
        "op11_periodic_runs": periodic_runs.oracle(),
        "op12_fill_in_middle": fill_in_middle.oracle(),
    }
