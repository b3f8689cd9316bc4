"""From raw documents to a training mix, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import cotrain, decontam, mixing, pii, simhash
from medloom.llm.shared import clear, stage, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return cotrain.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, that with the smallest doc_id stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, give way to their kinds."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target, copies and taken."""
    return mixing.mix(docs).where(F.col("copies") > 0)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("mixture", mixture)]

#: SQL has neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table. What stages leave on the way is deleted once the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), written()
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        clear(spark, before, docs)
    return docs
