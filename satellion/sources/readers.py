"""Readers of sequencing reads, reference repeats, profiles and detector output."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satellion.functions.scalars import leb36_decode
from satellion.functions.shipping import ship

FORMATS = ("fasta", "fastq", "bam", "sam")


def discover(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """(format, sorted files) of a folder that any Spark file system holds: the first of FORMATS that a name contains wins; index files are left out."""
    names = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect() if not r.path.endswith(".bai")]
    for fmt in FORMATS:
        if found := sorted(n for n in names if fmt in n.rsplit("/", 1)[-1].lower()):
            return fmt, found
    raise ValueError(f"no reads in {path}")


def unpack(name: str, raw: bytes) -> list[str]:
    """Texts of a plain, compressed or archived file."""
    low = name.lower()
    if low.endswith((".tgz", ".tbz", ".txz", ".tar", ".tar.gz", ".tar.bz2", ".tar.xz")):
        with tarfile.open(fileobj=io.BytesIO(raw)) as t:
            return [t.extractfile(m).read().decode() for m in t.getmembers() if m.isfile()]
    for end, of in ((".gz", gzip), (".bz2", bz2), (".xz", lzma)):
        if low.endswith(end):
            return [of.decompress(raw).decode()]
    return [raw.decode()]


def fasta_records(text: str):
    """(header, sequence) of each record; lines are joined."""
    for part in text.split(">")[1:]:
        head, _, seq = part.partition("\n")
        yield head.strip(), "".join(seq.split())


def fastq_records(text: str):
    """(header, sequence); sequence and quality may span lines, quality ends by length."""
    lines = iter(text.splitlines())
    for line in lines:
        if not line.startswith("@"):
            if line.strip():
                raise ValueError(f"no FASTQ header: {line[:40]}")
            continue
        head, seq = line[1:].strip(), []
        for line in lines:
            if line.startswith("+"):
                break
            seq.append(line.strip())
        dna, n = "".join(seq), 0
        while n < len(dna):
            n += len(next(lines).strip())
        yield head, dna


def sam_records(text: str):
    """(header, sequence) of primary records; mates get /1 and /2."""
    for line in text.splitlines():
        if line and not line.startswith("@"):
            f = line.split("\t")
            flag = int(f[1])
            if not flag & (256 | 2048):
                yield f[0] + ("" if not flag & 1 else "/1" if flag & 64 else "/2"), f[9]


def read_reads(spark: SparkSession, path: str, strip_key: bool = False, check_unique: bool = False) -> DataFrame:
    """(head, dna, file_idx) of all reads in a folder. Files without a pair mark in their first header get ` vs=<file>` after each header.

    strip_key removes a leading TCAG in either case. check_unique raises when a header repeats.
    """
    ship(spark)
    fmt, files = discover(spark, path)
    number = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "path string, file_idx int")
    records = {"fasta": fasta_records, "fastq": fastq_records, "sam": sam_records}
    if fmt not in records:
        raise ValueError("binary alignments need a decoder that isn't here; give SAM text")

    def run(parts):
        import re

        paired = re.compile(r" [12]:[YN]:\d+:(\d+|[ACGT]+)|/[12]")
        for pdf in parts:
            for name, raw, k in zip(pdf.path, pdf.content, pdf.file_idx):
                for text in unpack(name, bytes(raw)):
                    rows = list(records[fmt](text))
                    mark = f" vs={k}" if fmt != "sam" and rows and not paired.search(rows[0][0]) else ""
                    yield pd.DataFrame({"head": [h + mark for h, _ in rows], "dna": [d for _, d in rows], "file_idx": k})

    reads = spark.read.format("binaryFile").load(files).select("path", "content").join(F.broadcast(number), "path").mapInPandas(run, "head string, dna string, file_idx int")
    if strip_key:
        reads = reads.withColumn("dna", F.regexp_replace("dna", "^(?i)TCAG", ""))
    if check_unique and not duplicate_heads(reads).isEmpty():
        raise ValueError("a read header repeats")
    return reads


def duplicate_heads(reads: DataFrame) -> DataFrame:
    return reads.groupBy("head").count().where("count > 1")


def both_strands(reads: DataFrame) -> DataFrame:
    """Each read and its reverse complement, named `_<length>_RCYES`."""
    turned = F.struct(F.concat("head", F.lit("_"), F.length("dna"), F.lit("_RCYES")).alias("head"), F.reverse(F.translate("dna", "ACGTacgt", "TGCAtgca")).alias("dna"), F.lit(True).alias("is_rc"))
    one = F.struct("head", "dna", F.lit(False).alias("is_rc"))
    rest = [c for c in reads.columns if c not in ("head", "dna")]
    return reads.select(*rest, F.explode(F.array(one, turned)).alias("r")).select("r.*", *rest)


def read_ref_seq(spark: SparkSession, path: str) -> DataFrame:
    """Reference repeats of a headed CSV file."""
    schema = "rid long, firstindex int, lastindex int, copynum double, head string, flankleft string, pattern string, sequence string, flankright string, conserved double"
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True)


def read_leb36(spark: SparkSession, path: str) -> DataFrame:
    """Profiles: twelve blank-separated fields, flanks joined by a bar."""
    f = F.split("value", " ")
    flank = F.split(f[11], r"\|")
    names = {"rid": ("long", 0), "patlen": ("int", 1), "copynum": ("double", 2), "proflen": ("int", 3), "proflen_rc": ("int", 4)}
    cols = [f[i].cast(t).alias(n) for n, (t, i) in names.items()]
    counts = [f[7 + i].cast("int").alias(f"n_{b}") for i, b in enumerate("acgt")]
    return spark.read.text(path).where("value <> ''").select(*cols, leb36_decode(f[5]).alias("profile"), leb36_decode(f[6]).alias("profile_rc"), *counts, flank[0].alias("left_flank"), flank[1].alias("right_flank"))


def read_indist(spark: SparkSession, path: str) -> DataFrame:
    """Ids, one negative number a line, as positive ones."""
    return spark.read.text(path).select(F.regexp_extract("value", r"-?(\d+)", 1).alias("v")).where("v <> ''").select(F.col("v").cast("long").alias("rid"))


def set_indist(refs: DataFrame, indist: DataFrame) -> DataFrame:
    """References with is_singleton and is_indist by a list of indistinguishable ids."""
    marked = refs.drop("is_singleton", "is_indist").join(indist.distinct().withColumn("is_indist", F.lit(True)), "rid", "left")
    return marked.withColumn("is_indist", F.coalesce("is_indist", F.lit(False))).withColumn("is_singleton", ~F.col("is_indist"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read repeats of tab-separated index files; malformed lines raise."""
    ok = F.col("value").rlike(r"^\d+\t[^\t]+\t\d+\t\d+\t[0-9.]+\t\d+\t[A-Za-z]+$")
    f = F.split(F.when(ok, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("malformed index line: "), F.col("value")))), "\t")
    kinds = ("long", "string", "int", "int", "double", "int", "string")
    return spark.read.text(path).select(*[f[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(("rid", "head", "first", "last", "copynum", "patsize", "pattern"), kinds))])


def read_trf(spark: SparkSession, path: str) -> DataFrame:
    """Repeats of detector output: `@header`, then rows of 17 fields. A lone dot is an empty flank. Lines follow their header within a file."""
    kinds = dict(first="int", last="int", period="int", copynum="double", patsize="int", matchperc="int", indelperc="int", score="int", n_a="int", n_c="int", n_g="int", n_t="int", entropy="double", pattern="string", sequence="string", left_flank="string", right_flank="string")
    files = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name()).select("file", F.explode(F.filter(F.split("value", "(?m)^@"), lambda x: F.trim(x) != "")).alias("block"))
    lines = F.filter(F.split("block", "\n"), lambda x: F.trim(x) != "")
    rows = files.select(F.trim(lines[0]).alias("head"), F.posexplode(F.slice(lines, F.lit(2), F.size(lines))).alias("nth", "line"))
    f = F.split(F.trim("line"), " ")
    out = rows.select("head", "nth", *[f[i].cast(t).alias(n) for i, (n, t) in enumerate(kinds.items())])
    return out.withColumns({c: F.when(F.col(c) == ".", "").otherwise(F.col(c)) for c in ("left_flank", "right_flank")})


def mirror_reverse(trs: DataFrame) -> DataFrame:
    """Repeats of reverse reads in forward coordinates: places mirrored, base counts swapped, sequences reverse-complemented, flanks exchanged."""
    n = F.regexp_extract("head", r"_(\d+)_RCYES$", 1)
    rc = F.col("head").rlike(r"_\d+_RCYES$")
    turn = lambda c: F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))
    size = n.try_cast("int")
    pick = lambda a, b: F.when(rc, a).otherwise(b)
    return trs.select(
        F.regexp_replace("head", r"_\d+_RCYES$", "").alias("head"), rc.alias("is_rc"), pick(size - F.col("last") + 1, F.col("first")).alias("first"), pick(size - F.col("first") + 1, F.col("last")).alias("last"),
        *[pick(F.col(f"n_{b}"), F.col(f"n_{a}")).alias(f"n_{a}") for a, b in (("a", "t"), ("c", "g"), ("g", "c"), ("t", "a"))],
        *[pick(turn(b), F.col(a)).alias(a) for a, b in (("pattern", "pattern"), ("sequence", "sequence"), ("left_flank", "right_flank"), ("right_flank", "left_flank"))],
        *[c for c in trs.columns if c not in ("head", "first", "last", "n_a", "n_c", "n_g", "n_t", "pattern", "sequence", "left_flank", "right_flank")],
    )


def spanning(trs: DataFrame, least_pattern: int = 7, least_flank: int = 10) -> DataFrame:
    """trs with spanning: a long enough pattern and both flanks."""
    return trs.withColumn("spanning", (F.col("patsize") >= least_pattern) & (F.length("left_flank") >= least_flank) & (F.length("right_flank") >= least_flank))


def first_seen(rows: DataFrame, head: str, ordinal: str) -> DataFrame:
    """rows with sid: the first ordinal of their header."""
    return rows.withColumn("sid", F.min(ordinal).over(Window.partitionBy(head)))
