"""Writers: VCF, profiles, FASTA and reports as ordered text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satellion.functions.scalars import left, leb36_encode, right


def vcf_lines(records: DataFrame) -> DataFrame:
    """(chrom, pos, value): tab-joined VCF rows with missing fields as dots."""
    dot = F.lit(".")
    cols = ["chrom", F.col("pos").cast("string"), "id", F.coalesce("ref", dot) if "ref" in records.columns else dot, F.coalesce("alt", dot) if "alt" in records.columns else dot, dot, "filter", "info", "format", "sample"]
    return records.select("chrom", "pos", F.concat_ws("\t", *cols).alias("value"))


def write_vcf(records: DataFrame, path: str, counts: dict[str, int], sample: str = "sample") -> None:
    """An ordered text table: a file with the header, then files of ranges of places, whose names follow that order; reading them by name gives one VCF."""
    spark = records.sparkSession
    head = ["##fileformat=VCFv4.2", *[f"##{k}={v}" for k, v in counts.items()], "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])]
    order = ["chrom", "pos", "value"]
    body = vcf_lines(records).withColumn("pos", F.col("pos").cast("long"))
    spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/part=0")
    body.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(f"{path}/part=1")


def write_vcfs(records: DataFrame, flags: DataFrame, path: str, counts: dict[str, int], sample: str = "sample") -> None:
    """Two tables: all supported references, and of them the variable ones (support_vntr in flags(ref_id, support_vntr)); each header tells how many records follow."""
    own = records.withColumn("ref_id", F.substring("id", 3, 30).cast("long"))
    variable = own.join(flags.where("support_vntr = 1").select("ref_id"), "ref_id", "left_semi")
    for name, some in (("all", own), ("vntr", variable)):
        write_vcf(some.drop("ref_id"), f"{path}/{name}", counts | {"records": some.count()}, sample)


def truncate(spark: SparkSession, path: str) -> None:
    """Leaves an empty table of the same columns."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def spanning_reads(reads: DataFrame, repeats: DataFrame, least_flank: int = 10) -> DataFrame:
    """(sid, value): as FASTA, each read (sid, head, dna) that holds a repeat with flanks of least_flank on both sides, once."""
    spans = repeats.where((F.col("left_flank") >= least_flank) & (F.col("right_flank") >= least_flank)).select("sid")
    return reads.join(spans, "sid", "left_semi").select("sid", F.concat(F.lit(">"), "head", F.lit("\n"), "dna").alias("value"))


def filtered_references(refs: DataFrame, dropped: DataFrame) -> DataFrame:
    """References whose id, whatever its sign, isn't among dropped(ref_id). A null id stays."""
    gone = dropped.select(F.abs("ref_id").alias("_gone"))
    return refs.join(gone, F.abs("ref_id") == F.col("_gone"), "left_anti")


def redundancy_lines(groups: DataFrame, turn: bool = True) -> DataFrame:
    """(head, value): each group's ids in order, as groups(rid, head) hold them, negated if turn: how reference ids are written."""
    ids = groups.groupBy("head").agg(F.sort_array(F.collect_list("rid")).alias("ids"))
    return ids.select("head", F.array_join(F.transform("ids", lambda i: (-i if turn else i).cast("string")), " ").alias("value"))


def leb36_lines(refs: DataFrame, order: str = "rid") -> DataFrame:
    """Profiles as twelve blank-separated fields, ids negative, flanks cut to 60 beside the array."""
    flanks = F.concat(F.upper(right("left_flank", 60)), F.lit("|"), F.upper(left("right_flank", 60)))
    cols = [(-F.col("rid")).cast("string"), F.col("patlen").cast("string"), F.format_string("%.2f", "copynum"), F.size("profile").cast("string"), F.size("profile_rc").cast("string"), leb36_encode("profile"), leb36_encode("profile_rc"), *[F.col(f"n_{b}").cast("string") for b in "acgt"], flanks]
    return refs.select(order, F.concat_ws(" ", *cols).alias("value"))


def fasta_lines(refs: DataFrame, used: DataFrame) -> DataFrame:
    """References whose id isn't used, as FASTA: 20 lower-case flank symbols on either side of the upper-case array."""
    rest = refs.join(used.select("rid").distinct(), "rid", "left_anti")
    return rest.select("rid", F.concat(F.lit(">"), F.col("rid"), F.lit("\n"), F.lower(right("left_flank", 20)), F.upper("sequence"), F.lower(left("right_flank", 20))).alias("value"))


def latex_summary(counts: dict[str, int]) -> str:
    """A two-column table of counts."""
    rows = "\n".join(f"{k.replace('_', ' ')} & {v:,} \\\\" for k, v in counts.items())
    return "\\begin{tabular}{lr}\n" + rows + "\n\\end{tabular}\n"
