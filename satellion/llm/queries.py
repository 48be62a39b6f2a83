"""The registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satellion.llm.oracles import ORACLES  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counts(spans: str, kinds) -> list:
    """Spans of each kind."""

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [count(k) for k in kinds]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.near import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.mixing import mix_sources

    mixed = mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep_columns=False)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.pii import BASE, find_pii
    from satellion.llm.spans import listed

    df = find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    counts = _counts("pii", BASE)
    return df.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.media import media_features

    return media_features(_table(spark, sf_dir, "documents")).drop("media")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.secrets import BASE, find_secrets
    from satellion.llm.spans import listed

    df = find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    counts = _counts("secrets", BASE)
    return df.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.licenses import find_licenses

    df = find_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    at = F.transform("base", lambda b: b["at"])
    return df.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), "base_labels", "labels", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from satellion.llm.quality import score_quality

    return score_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_jaccard_join, op3_mix, op4_pii, op5_pack, op6_media, op7_neighbours, op8_quality, op9_secrets, op10_licenses)}
