"""Report frames: size, copy and support distributions with totals, and one-row summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satellion.functions.scalars import percent


def size_table(rows: DataFrame, size: Column, flags: list[str], cap: int) -> DataFrame:
    """(size, n_all, n_<flag>, pct_<flag>): rows and flagged rows by size, with a TOTAL row. Sizes from cap on share one row, marked with a plus. Percentages are of all rows of a size, truncated."""
    g = rows.withColumn("_size", F.least(size, F.lit(cap))).rollup("_size").agg(F.count("*").alias("n_all"), *[F.count_if(F.col(f).cast("int") > 0).alias(f"n_{f}") for f in flags])
    label = F.when(F.col("_size").isNull(), "TOTAL").when(F.col("_size") == cap, f"{cap}+").otherwise(F.col("_size").cast("string"))
    return g.select(label.alias("size"), "n_all", *[f"n_{f}" for f in flags], *[percent(F.col(f"n_{f}"), F.col("n_all")).alias(f"pct_{f}") for f in flags])


def copies_table(support: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Supported alleles that differ from the reference, by keys, with a row of nulls for the total."""
    g = support.where((F.col("copies") != 0) & (F.col("support") >= least))
    return g.groupingSets([[F.col(k) for k in keys], []], *[F.col(k) for k in keys]).agg(F.count("*").alias("n"))


def reads_table(support: DataFrame, refs: DataFrame, classes: DataFrame, unit: str = "locus") -> DataFrame:
    """(reads, singleton, indist, all_refs): how many loci, alleles or alleles of variable loci have how many spanning reads, on an axis without gaps; reads is null in the row of totals."""
    rows = support.join(refs.select("ref_id", "is_singleton"), "ref_id")
    if unit == "locus":
        rows = rows.groupBy("ref_id", "is_singleton").agg(F.sum("support").alias("reads"))
    elif unit == "allele":
        rows = rows.withColumnRenamed("support", "reads")
    elif unit == "vntr_allele":
        rows = rows.join(classes.where("support_vntr > 0").select("ref_id"), "ref_id", "left_semi").withColumnRenamed("support", "reads")
    else:
        raise ValueError(f"unknown unit {unit}")
    one = F.col("is_singleton")
    g = rows.groupBy("reads").agg(F.count_if(one).alias("singleton"), F.count_if(~one).alias("indist"), F.count("*").alias("all_refs"))
    # the axis has as many rows as the best covered locus has reads
    axis = g.agg(F.max("reads").alias("m")).where("m is not null").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long"))).alias("reads"))
    dense = axis.join(g, "reads", "left").na.fill(0, ["singleton", "indist", "all_refs"])
    return dense.rollup("reads").agg(*[F.sum(c).alias(c) for c in ("singleton", "indist", "all_refs")])


def alleles_by_class(support: DataFrame, classes: DataFrame) -> DataFrame:
    """(support, inferred, observed, total): alleles of variable references by reads; inferred where only the changed allele was seen, observed where others were too."""
    hetez = F.greatest("hetez_same", "hetez_diff", "hetez_multi") == 1
    g = support.join(classes.where("support_vntr > 0").select("ref_id", "homez_diff", "hetez_same", "hetez_diff", "hetez_multi"), "ref_id").groupBy("support")
    return g.agg(F.count_if(F.col("homez_diff") == 1).alias("inferred"), F.count_if(hetez).alias("observed"), F.count("*").alias("total"))


def single_read_counts(support: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of references with an allele that one read supports: without and with other support, and of the variable ones by class."""
    rows = support.where("support = 1").join(classes, "ref_id")
    of = lambda c: F.countDistinct(F.when(F.expr(c), F.col("ref_id")))
    return rows.agg(
        of("copies <> 0 and has_support = 0 and support_vntr = 0").alias("n_1a"), of("copies <> 0 and has_support = 1 and support_vntr = 0").alias("n_1b"),
        of("homez_diff = 1").alias("n_2a"), of("greatest(hetez_same, hetez_diff, hetez_multi) = 1").alias("n_2b"),
    )


def summary_counts(classes: DataFrame, refs: DataFrame, best: DataFrame) -> DataFrame:
    """One row for the summary's tables; best(ref_id, read_id) are the pairs flagged best. Reads and references are told apart by whether the reference is a singleton."""
    flags = ["has_support", "span1", "span_n", "homez_same", "homez_diff", "hetez_same", "hetez_diff", "hetez_multi", "support_vntr"]
    sums = classes.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in flags])
    of = lambda key, c: F.countDistinct(F.when(F.expr(c), F.col(key)))
    rows = best.select("ref_id", "read_id").join(refs.select("ref_id", "is_singleton"), "ref_id").join(classes.select("ref_id", "support_vntr"), "ref_id", "left")
    mapped = rows.agg(
        F.countDistinct("ref_id").alias("refs_mapped"), F.countDistinct("read_id").alias("reads_mapped"),
        of("read_id", "is_singleton").alias("reads_singleton"), of("read_id", "not is_singleton").alias("reads_indist"),
        of("ref_id", "is_singleton and coalesce(support_vntr, 0) = 0").alias("invariant_singleton"), of("ref_id", "not is_singleton and coalesce(support_vntr, 0) = 0").alias("invariant_indist"),
        of("ref_id", "is_singleton and support_vntr > 0").alias("vntr_singleton"), of("ref_id", "not is_singleton and support_vntr > 0").alias("vntr_indist"),
    )
    # two frames of one row each
    return sums.withColumn("_k", F.lit(1)).join(mapped.withColumn("_k", F.lit(1)), "_k").drop("_k")


def report_lines(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """(section, nth, value): each section's title, its column names and its rows, comma-joined, by their first columns with totals last."""
    out = None
    for k, (title, df) in enumerate(sections):
        spark = df.sparkSession
        head = spark.createDataFrame([(k, 0, title, 0), (k, 1, ", ".join(df.columns), 0)], "section int, nth int, value string, _o int")
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("TOTAL")) for c in df.columns]
        first = F.col(df.columns[0]).cast("string")
        order = F.coalesce(F.regexp_extract(first, r"^-?\d+", 0).try_cast("int"), F.lit(2**31 - 1))
        rows = df.select(F.lit(k).alias("section"), F.lit(2).alias("nth"), F.concat_ws(", ", *cells).alias("value"), order.alias("_o"))
        part = head.union(rows)
        out = part if out is None else out.union(part)
    return out.orderBy("section", "nth", "_o", "value").select("section", "nth", "value")
