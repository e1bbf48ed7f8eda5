"""Documents to training mix: each stage reads what the one before wrote.

Quality rules reject documents; line dedup takes boilerplate lines out of texts (the source is the site), and
n_chars follows; of each near-duplicate class one document stays, the one with the smallest id; documents that
leak a benchmark item go; the mix says how many words of each document to take.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria.llm import common, decontamination, line_dedup, mixing, near, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep, each judged by itself; null and empty texts go, as they have too few words."""
    return quality.keep(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their sources' boilerplate lines."""
    out = line_dedup.drop_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class at similarity 0.8 or more of 5-word shingles: the row with the smallest id (of the texts
    with that id the one with the smallest hash; of repeated rows one). Rows with a null id cannot be told apart, so all of
    them stay. Null and empty texts are one class."""
    return near.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item. All rows of a leaking id go; rows with a null id, null and empty texts stay."""
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, a row for each row: null texts have size 0 and are taken 0 times,
    a null source is a source, null ids and repeated rows are documents of their own."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: Near-duplicate classes and balanced sampling are iterative; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote is removed once the next one is written; the last one's folder stays,
    as the result reads it."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.shared_dir(spark).rstrip('/')}/pipeline-{spark.sparkContext.applicationId}-{uuid.uuid4()}"
    last = None
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            common.remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
