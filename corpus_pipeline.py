"""Training-data pipeline: from raw documents to token ids.

Every stage takes (spark, docs, folder of the tables) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.llm import bpe, decontaminate, line_dedup, minhash, quality_rules
from snapstats.llm.common import documents, stored

# Similarity of the word shingles from which documents are near-duplicates; op6_minhash keeps its own 85.
NEAR_PERCENT = 80

# Several stages have no SQL form; tests compare run() with a plain Python version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, with the labelled good ones as the target."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.quality_filter(docs, labels.where("quality = 1").select("doc_id"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows the text."""
    return line_dedup.line_dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (similarity of NEAR_PERCENT and more)."""
    return minhash.dedup(docs, percent=NEAR_PERCENT)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash", near_duplicates),
    ("decontaminate", leaks),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents, each stage's rows stored before the next reads them."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
