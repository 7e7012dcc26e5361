"""The corpus pipeline: quality, toxicity, near-duplicates, decontamination, mixing.  Each stage takes the documents
that the one before kept, written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import decontaminate, mixing, neardup, quality, toxicity
from docketry.llm.common import shared_dir, table

STAGES = [
    ("quality classifier", quality.pipeline_stage),
    ("toxicity", toxicity.pipeline_stage),
    ("minhash near-dedup", neardup.one_of_each),
    ("benchmark decontamination", decontaminate.pipeline_stage),
    ("mixing", mixing.pipeline_stage),
]

#: Models that Spark jobs train have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    top = shared_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
    return docs
