"""Allele calls, support, variability and genotype classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def same_allele(ref: Column, read: Column) -> Column:
    return (read > ref - 0.8) & (read < ref + 0.8)


def copies_of(ref: Column, read: Column) -> Column:
    """Whole copies gained or lost; 0 within 0.8 of the reference."""
    up, down = 1 + F.round(read - (ref + 0.8), 6).cast("int"), -1 - F.round((ref - 0.8) - read, 6).cast("int")
    return F.when(same_allele(ref, read), 0).when(read > ref, up).otherwise(down)


def call_alleles(pairs: DataFrame, refs: DataFrame, least_flank: int = 10) -> DataFrame:
    """(ref_id, copies, same_as_ref, support, copies_float, representative) from flagged pairs whose flanks are long enough; a reference without support for its own allele gets a row with support 0."""
    own = refs.select("ref_id", F.col("copynum").alias("ref_copynum"))
    votes = pairs.where((F.col("left_flank") >= least_flank) & (F.col("right_flank") >= least_flank)).join(own, "ref_id").withColumn("copies", copies_of(F.col("ref_copynum"), F.col("copynum")))
    counted = votes.groupBy("ref_id", "copies").agg(F.count("*").alias("support"), F.min("read_id").alias("representative"), F.max("ref_copynum").alias("ref_copynum"))
    counted = counted.select("ref_id", "copies", (F.col("copies") == 0).cast("int").alias("same_as_ref"), "support", F.when(F.col("copies") == 0, F.col("ref_copynum")).otherwise(0.0).alias("copies_float"), "representative")
    seen = pairs.select("ref_id").distinct().join(counted.where("copies = 0").select("ref_id"), "ref_id", "left_anti").join(own, "ref_id")
    zero = seen.select("ref_id", F.lit(0).alias("copies"), F.lit(1).alias("same_as_ref"), F.lit(0).cast("long").alias("support"), F.col("ref_copynum").alias("copies_float"), F.lit(None).cast("long").alias("representative"))
    return counted.unionByName(zero)


def variability(votes: DataFrame, cluster: str) -> DataFrame:
    """Per cluster: references whose largest change in copies is over 0."""
    per_ref = votes.groupBy(cluster, "ref_id").agg(F.max(F.abs("copies")).alias("change"))
    return per_ref.groupBy(cluster).agg(F.sum((F.col("change") > 0).cast("int")).alias("variability"), F.max("change").alias("largest_change"))


def classify(support: DataFrame, ploidy: int = 2, least: int = 2) -> DataFrame:
    """One row a reference: genotype class flags and supported allele counts."""
    ok = (F.col("support") >= least).cast("int")
    g = support.groupBy("ref_id").agg(
        F.sum(ok).cast("int").alias("alleles_sup"), F.max(ok * F.col("same_as_ref")).alias("same"), F.sum("support").alias("total"),
        F.max(F.when((F.col("support") >= 1) & (F.col("copies") != 0), 1).otherwise(0)).alias("any_change"),
    )
    n, same = F.col("alleles_sup"), F.col("same") == 1
    flag = lambda c: c.cast("int")
    g = g.select(
        "ref_id", "alleles_sup", F.col("same").alias("allele_sup_same_as_ref"), flag(n > 0).alias("has_support"), flag(F.col("total") >= 1).alias("span1"), flag(F.col("total") >= least).alias("span_n"),
        flag((n == 1) & same).alias("homez_same"), flag((n == 1) & ~same).alias("homez_diff"), flag((n > 1) & (n <= ploidy) & same).alias("hetez_same"),
        flag((n > 1) & (n <= ploidy) & ~same).alias("hetez_diff"), flag(n > ploidy).alias("hetez_multi"), F.col("any_change").alias("support_vntr_span1"),
    )
    return g.withColumn("support_vntr", F.greatest("homez_diff", "hetez_same", "hetez_diff", "hetez_multi"))


def allele_strings(support: DataFrame, least: int = 2) -> DataFrame:
    """Per reference, in order reference allele first, then copies: SP and CGL lists and the genotype."""
    ok = support.where(F.col("support") >= least)
    rows = ok.groupBy("ref_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("same_as_ref")).alias("o"), "copies", "support"))).alias("a"), F.max("same_as_ref").alias("ref_seen"))
    miss = F.col("ref_seen") == 0
    lead = F.when(miss, F.array(F.lit("."))).otherwise(F.array().cast("array<string>"))
    n = F.size("a")
    off = 1 - F.col("ref_seen")
    several = F.array_join(F.transform(F.sequence(off, n - F.col("ref_seen")), lambda x: x.cast("string")), "/")
    return rows.select(
        "ref_id", F.when(n == 1, F.concat_ws("/", off.cast("string"), off.cast("string"))).otherwise(several).alias("gt"),
        F.array_join(F.concat(lead, F.transform("a", lambda x: x["support"].cast("string"))), ",").alias("sp"),
        F.array_join(F.concat(lead, F.transform("a", lambda x: x["copies"].cast("string"))), ",").alias("cgl"),
    )


def vcf_records(strings: DataFrame, refs: DataFrame) -> DataFrame:
    """VCF fields of each supported reference; PASS where it is a singleton, SC otherwise."""
    r = refs.select("ref_id", "chrom", "first_pos", "last_pos", "pattern", "copynum", "is_singleton")
    info = F.concat(F.lit("RC="), F.format_string("%.2f", "copynum"), F.lit(";RPL="), F.length("pattern"), F.lit(";RAL="), F.col("last_pos") - F.col("first_pos") + 1, F.lit(";RCP="), F.col("pattern"))
    return strings.join(r, "ref_id").select(
        "chrom", (F.col("first_pos") - 1).alias("pos"), F.concat(F.lit("td"), F.col("ref_id")).alias("id"), F.when(F.col("is_singleton"), "PASS").otherwise("SC").alias("filter"),
        info.alias("info"), F.lit("GT:SP:CGL").alias("format"), F.concat_ws(":", "gt", "sp", "cgl").alias("sample"),
    )
