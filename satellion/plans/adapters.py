"""Canonical frames from the analytic test tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGT" * 6 + "AC"
ROW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dna(c: str | Column) -> Column:
    """Letters of a text as bases."""
    return F.translate(F.regexp_replace(F.lower(c), "[^a-z]", ""), LETTERS, BASES)


def dna_sql(c: str) -> str:
    return f"translate(regexp_replace(lower({c}),'[^a-z]','','g'),'{LETTERS}','{BASES}')"


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ref_id"), F.col("p_brand").alias("chrom"), (F.col("p_partkey") * 100).alias("first_pos"), (F.col("p_partkey") * 100 + F.col("p_size") * 10).alias("last_pos"),
        dna("p_name").alias("pattern"), (F.col("p_size") / 10.0).alias("copynum"), (F.col("p_partkey") % 3 != 0).alias("is_singleton"),
    )


def read_trs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read repeats; rows of an order are numbered within it, so ids need no global sort."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey") % 5
    gain = F.when(F.col("l_tax") < 0.04, 1.3)
    shift = (
        F.when(k == 0, 0.3).when(k == 1, gain.otherwise(0.0)).when(k == 2, -1.4)
        .when(k == 3, (F.round(F.col("l_tax") * 100).cast("int") / 2).cast("int").cast("double")).otherwise(gain.otherwise(-1.4))
    )
    nth = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*ROW_ORDER[1:]))
    rows = table(spark, sf_dir, "lineitem").select(*ROW_ORDER).withColumn("nth", nth)
    return rows.join(part, rows.l_partkey == part.p_partkey).select(
        (F.col("l_orderkey") * 1000 + F.col("nth")).cast("long").alias("read_id"), F.col("l_orderkey").alias("sid"), F.col("l_partkey").alias("ref_id"),
        (10 + F.col("l_linenumber")).cast("int").alias("left_flank"), (6 + F.col("l_orderkey") % 25).cast("int").alias("right_flank"),
        F.round(F.col("p_size") / 10.0 + shift, 4).alias("copynum"), F.round(1 - F.col("l_discount"), 4).alias("prof_score"), F.round(1 - F.col("l_tax"), 4).alias("flank_score"),
    )


CTE = f"""
refs AS (SELECT p_partkey AS ref_id, p_brand AS chrom, p_partkey*100 AS first_pos, p_partkey*100+p_size*10 AS last_pos, {dna_sql('p_name')} AS pattern,
  p_size/10.0 AS copynum, p_partkey%3<>0 AS is_singleton FROM part),
reads AS (SELECT l_orderkey*1000+nth AS read_id, l_orderkey AS sid, l_partkey AS ref_id, CAST(10+l_linenumber AS INTEGER) AS left_flank, CAST(6+l_orderkey%25 AS INTEGER) AS right_flank,
  round(p_size/10.0 + CASE p_partkey%5 WHEN 0 THEN 0.3 WHEN 1 THEN (CASE WHEN l_tax<0.04 THEN 1.3 ELSE 0 END) WHEN 2 THEN -1.4
    WHEN 3 THEN CAST(round(l_tax*100) AS INTEGER)//2 ELSE (CASE WHEN l_tax<0.04 THEN 1.3 ELSE -1.4 END) END, 4) AS copynum,
  round(1-l_discount,4) AS prof_score, round(1-l_tax,4) AS flank_score
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(ROW_ORDER[1:])}) AS nth FROM lineitem) JOIN part ON l_partkey=p_partkey)
"""


def sql(body: str, more: str = "") -> str:
    """A query over the adapters' frames."""
    return f"WITH {CTE}{',' + more if more else ''} {body}"
