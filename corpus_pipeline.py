"""A training-corpus pipeline of text operators: judge quality, drop near duplicates, redact personal data, mix sources, pack sequences.

Stages but the last return the columns they were given, extra ones too, also where an operator adds a column of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satellion.llm.common import set_aside, store
from satellion.llm.mixing import mix_sources
from satellion.llm.near import drop_near_duplicates
from satellion.llm.packing import pack
from satellion.llm.pii import redact
from satellion.llm.quality import score_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain, back = set_aside(docs, ("doc_id", "text"))
    return back(score_quality(plain, labels).where("predicted = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents without words stay as they are."""
    copies = F.when(F.col("size") > 0, F.expr("cast(taken div size as int)")).otherwise(1)
    plain, back = set_aside(docs, ("doc_id", "text", "source"))
    return back(mix_sources(plain).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("packing", packing)]

#: Token ids, an SVD and balanced sampling have no SQL form: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
