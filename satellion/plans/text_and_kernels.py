"""Scalar functions and kernels over the adapters' strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from satellion.functions import kernels, scalars
from satellion.functions.shipping import ship
from satellion.operators import clustering
from satellion.plans.adapters import dna, dna_sql, refs, sql, table
from satellion.plans.registry import query

TURN = "reverse(translate({0},'ACGT','TGCA'))"


@query("x01_reverse_complement", sql(f"SELECT ref_id, {TURN.format('pattern')} AS rc, translate(pattern,'ACGT','TGCA') AS comp FROM refs"))
def x01(s, d):
    return refs(s, d).select("ref_id", scalars.reverse_complement("pattern").alias("rc"), scalars.complement("pattern").alias("comp"))


@query("x03_x09_text", sql("SELECT ref_id, lower(pattern) AS lo, right(pattern, 5) AS r5, substr(pattern, 1, 4) AS l4, length(pattern) AS n, printf('%.2f', copynum) AS copies, replace(chrom,'#','') AS plain FROM refs"))
def x03(s, d):
    return refs(s, d).select("ref_id", F.lower("pattern").alias("lo"), scalars.right("pattern", 5).alias("r5"), scalars.left("pattern", 4).alias("l4"), F.length("pattern").alias("n"), F.format_string("%.2f", "copynum").alias("copies"), F.replace("chrom", F.lit("#"), F.lit("")).alias("plain"))


@query("x05_x06_clean", "SELECT p_partkey, regexp_replace(p_name, '\\s+', '', 'g') AS tight, trim('  ' || p_name || ' ') AS trimmed FROM part")
def x05(s, d):
    return table(s, d, "part").select("p_partkey", scalars.strip_blanks("p_name").alias("tight"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"))


@query("x08_x10_split", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS first_piece, list_last(string_split(o_orderpriority, '-')) AS last_piece FROM orders")
def x08(s, d):
    return table(s, d, "orders").select("o_orderkey", scalars.substring_index("o_orderpriority", "-", 0).alias("first_piece"), scalars.substring_index("o_orderpriority", "-", -1).alias("last_piece"))


@query("x11_m08_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, printf('%d', (o_orderkey*1000)//86400) || 'd ' || printf('%d', (o_orderkey*1000)%86400//3600) || 'h ' || printf('%d', (o_orderkey*1000)%3600//60) || 'm ' || printf('%d', (o_orderkey*1000)%60) || 's' AS took FROM orders")
def x11(s, d):
    return table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), scalars.duration(F.col("o_orderkey") * 1000).alias("took"))


@query("x14_min_rotation", sql("SELECT ref_id, list_min([pattern[i+1:]||pattern[:i] for i in range(0, length(pattern))]) AS smallest FROM refs"))
def x14(s, d):
    return refs(s, d).select("ref_id", scalars.min_rotation("pattern").alias("smallest"))


@query("x16_regex", "SELECT doc_id, regexp_extract(source, '([0-9]+)', 1) AS number, regexp_matches(lang, '^(de|fr)$') AS known FROM documents")
def x16(s, d):
    return table(s, d, "documents").select("doc_id", F.regexp_extract("source", "([0-9]+)", 1).alias("number"), F.col("lang").rlike("^(de|fr)$").alias("known"))


@query("x13_leb36", sql("SELECT ref_id, [ascii(c)*15 % 1001 for c in string_split(pattern, '')] AS ids FROM refs"))
def x13(s, d):
    """Ids made from a pattern, written and read back."""
    ids = F.transform(F.filter(F.split("pattern", ""), lambda c: c != ""), lambda c: (F.ascii(c) * 15 % 1001).cast("int"))
    df = refs(s, d).select("ref_id", ids.alias("ids")).withColumn("code", scalars.leb36_encode("ids"))
    return df.select("ref_id", F.transform(scalars.leb36_decode("code"), lambda x: x.cast("int")).alias("ids"))


@query("m01_m06_numbers", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(trunc(l_extendedprice) AS BIGINT) AS whole, CAST(floor(l_quantity/3+0.5) AS BIGINT) AS nearest, CASE WHEN l_quantity > 0 THEN CAST(trunc(100*l_linenumber/l_quantity) AS INTEGER) ELSE 0 END AS pct, abs(-l_quantity) AS size, -l_partkey AS signed FROM lineitem")
def m01(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_extendedprice").cast("long").alias("whole"), scalars.round_half_up(F.col("l_quantity") / 3).alias("nearest"), scalars.percent(F.col("l_linenumber"), F.col("l_quantity")).alias("pct"), F.abs(-F.col("l_quantity")).alias("size"), (-F.col("l_partkey")).alias("signed"))


@query("u02_anchored_distance", sql("SELECT ref_id, list_min([levenshtein(pattern[1:k], substr(pattern, 3, 6)) for k in range(0, length(pattern)+1)]) AS distance FROM refs"))
def u02(s, d):
    return refs(s, d).withColumn("m", F.substring("pattern", 3, 6)).select("ref_id", scalars.anchored_distance("pattern", "m").cast("long").alias("distance"))


@query("d03_d04_redundancy", sql(f"SELECT min(ref_id) OVER (PARTITION BY least(pattern, {TURN.format('pattern')})) AS group_id, ref_id AS rid, {TURN.format('pattern')} < pattern AS is_rc, ref_id = min(ref_id) OVER (PARTITION BY least(pattern, {TURN.format('pattern')})) AS is_head FROM refs"))
def d04(s, d):
    p = refs(s, d).withColumn("rc", scalars.reverse_complement("pattern")).select(F.col("ref_id").alias("rid"), _codes("pattern").alias("profile"), _codes("rc").alias("profile_rc"))
    return clustering.redundancy_groups(p)


@query("s31_simulated_reads", sql("SELECT ref_id, i AS start, substr(pattern, i+1, 5) AS read FROM (SELECT ref_id, pattern, unnest(range(0, length(pattern)-5+1)) AS i FROM refs WHERE length(pattern) >= 5)"))
def s31(s, d):
    r = refs(s, d).where(F.length("pattern") >= 5).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.length("pattern").cast("long") - 5)))
    return r.select("ref_id", "start", F.substring(F.col("pattern"), (F.col("start") + 1).cast("int"), F.lit(5)).alias("read"))


@query("s09_both_strands", f"SELECT head, dna FROM (SELECT 'p'||p_partkey AS head, {dna_sql('p_name')} AS dna FROM part) UNION ALL SELECT head||'_'||length(dna)||'_RCYES', {TURN.format('dna')} FROM (SELECT 'p'||p_partkey AS head, {dna_sql('p_name')} AS dna FROM part)")
def s09(s, d):
    from satellion.sources.readers import both_strands

    return both_strands(table(s, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("head"), dna("p_name").alias("dna"))).select("head", "dna")


def _codes(c):
    return F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x).cast("short"))


@query("g02_seed_candidates")
def g02(s, d):
    """All references' groups against each other: one head a group is searched, as members share its pattern."""
    r = refs(s, d).withColumn("rc", scalars.reverse_complement("pattern"))
    groups = clustering.redundancy_groups(r.select(F.col("ref_id").alias("rid"), _codes("pattern").alias("profile"), _codes("rc").alias("profile_rc")))
    heads = r.join(groups.where("is_head").select(F.col("rid").alias("ref_id")), "ref_id", "left_semi").select("ref_id", "pattern")
    return clustering.seed_candidates(heads, heads.withColumnRenamed("ref_id", "read_id"))


@query("u03_f07_lcs_filter")
def u03(s, d):
    r = refs(s, d).select("ref_id", "pattern")
    c = g02(s, d).join(r, "ref_id").join(r.select(F.col("ref_id").alias("read_id"), F.col("pattern").alias("read_pattern")), "read_id")
    c = c.withColumn("pattern", F.when(F.col("ref_rc"), scalars.reverse_complement("pattern")).otherwise(F.col("pattern")))
    return clustering.consensus_filter(c, "pattern", "read_pattern").select("ref_id", "read_id", "ref_rc", "lcs")


@query("d01_u04_profiles")
def d01(s, d):
    """Profiles of arrays made of a pattern twice and a half, and their similarity to the pattern's own."""
    ship(s)
    r = refs(s, d).withColumn("array", F.concat("pattern", "pattern", F.expr("substring(pattern, 1, length(pattern) div 2)")))
    p = r.select("ref_id", kernels.profile_of("array", "pattern").alias("p"), kernels.profile_of("pattern", "pattern").alias("q"))
    return p.select("ref_id", "p.pattern", F.round("p.copynum", 2).alias("copynum"), F.round(kernels.similarity("p.profile", "q.profile"), 4).alias("similarity"), kernels.consensus_of("p.profile").alias("consensus"))


@query("d12_flank_align")
def d12(s, d):
    r = refs(s, d).select("ref_id", F.col("pattern").alias("ref_left"), scalars.reverse_complement("pattern").alias("ref_right"))
    pairs = r.withColumns({"left": F.expr("concat(substring(ref_left, 2), 'A')"), "right": F.expr("substring(ref_right, 1, 12)")})
    return clustering.flank_align(pairs).select("ref_id", "is_rc", "lerr", "rerr", "left_len", "right_len")
