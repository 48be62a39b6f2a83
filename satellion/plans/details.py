"""Smaller operations of the steps: range checks, cuts, lookups, runs, bands, mirrored headers and row scores."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satellion.functions import scalars
from satellion.operators import links
from satellion.plans.adapters import read_trs, refs, sql, table
from satellion.plans.registry import query
from satellion.sources import sinks
from satellion.sources.readers import mirror_reverse

TURN = "reverse(translate({0},'ACGT','TGCA'))"


@query("f02_pattern_range", sql("SELECT ref_id, length(pattern) AS n, length(pattern) BETWEEN 7 AND 5000 AS in_range FROM refs"))
def f02(s, d):
    n = F.length("pattern")
    return refs(s, d).select("ref_id", n.alias("n"), n.between(7, 5000).alias("in_range"))


@query("f06_m03_flank_score", sql("SELECT read_id, ref_id, score FROM (SELECT read_id, ref_id, CASE WHEN left_flank+right_flank > 0 THEN round(1-(left_flank%3+right_flank%2)/(left_flank+right_flank), 6) ELSE 0 END AS score FROM reads) WHERE score >= 0.9"))
def f06(s, d):
    """Two parts of the flank lengths stand for the errors."""
    errors, length = F.col("left_flank") % 3 + F.col("right_flank") % 2, F.col("left_flank") + F.col("right_flank")
    scored = read_trs(s, d).select("read_id", "ref_id", F.when(length > 0, F.round(1 - errors / length, 6)).otherwise(0.0).alias("score"))
    return scored.where("score >= 0.9")


@query("f19_x04_flank_cut", sql("SELECT ref_id, right(pattern, 8) AS left_flank, left(pattern, 8) AS right_flank, substr(pattern, 3, 5) AS inner_part, substr(pattern, -4) AS tail FROM refs"))
def f19(s, d):
    """The symbols nearest to the array: the end of what stands before it and the start of what follows."""
    return refs(s, d).select("ref_id", scalars.right("pattern", 8).alias("left_flank"), scalars.left("pattern", 8).alias("right_flank"), F.substring("pattern", 3, 5).alias("inner_part"), scalars.right("pattern", 4).alias("tail"))


@query("j08_j13_match_detail", sql("SELECT read_id, ref_id, chrom, o_orderpriority AS head, length(pattern) AS patsize, prof_score FROM reads JOIN refs USING (ref_id) JOIN orders ON sid = o_orderkey WHERE prof_score >= 0.95"))
def j08(s, d):
    best = read_trs(s, d).where("prof_score >= 0.95")
    heads = table(s, d, "orders").select(F.col("o_orderkey").alias("sid"), F.col("o_orderpriority").alias("head"))
    return best.join(refs(s, d).select("ref_id", "chrom", "pattern"), "ref_id").join(heads, "sid").select("read_id", "ref_id", "chrom", "head", F.length("pattern").alias("patsize"), "prof_score")


@query("j15_copies_gained", sql("SELECT read_id, ref_id, CAST(round(r.copynum - f.copynum) AS BIGINT) AS gained FROM reads r JOIN refs f USING (ref_id)"))
def j15(s, d):
    own = refs(s, d).select("ref_id", F.col("copynum").alias("of_ref"))
    return read_trs(s, d).join(own, "ref_id").select("read_id", "ref_id", F.round(F.col("copynum") - F.col("of_ref")).cast("long").alias("gained"))


@query("j24_w10_size_band", sql("SELECT a.ref_id AS a, b.ref_id AS b FROM refs a JOIN refs b ON a.chrom=b.chrom AND a.ref_id<b.ref_id AND 10*abs(length(a.pattern)-length(b.pattern)) <= length(a.pattern)"))
def j24(s, d):
    """All pairs of a cluster whose pattern sizes are near; sizes are paired first, their references after."""
    r = refs(s, d).select(F.col("ref_id").alias("id"), F.col("chrom").alias("cid"), F.length("pattern").alias("n"))
    return links.size_pairs(r, F.floor(F.col("n") / 10), F.expr("10 * abs(a_n - b_n) <= a_n"))


@query("a15_lost_to_ties", sql("SELECT ref_id, count(*) AS n FROM reads GROUP BY 1 HAVING max(CAST(flank_score >= 0.99 AS INTEGER)) = 0"))
def a15(s, d):
    """References none of whose rows is flagged."""
    return read_trs(s, d).groupBy("ref_id").agg(F.count("*").alias("n"), F.max((F.col("flank_score") >= 0.99).cast("int")).alias("best")).where("best = 0").select("ref_id", "n")


@query("a19_allele_representatives", sql("SELECT ref_id, gained, count(*) AS support, min(read_id) AS representative FROM (SELECT read_id, ref_id, CAST(round(r.copynum - f.copynum) AS BIGINT) AS gained FROM reads r JOIN refs f USING (ref_id)) GROUP BY 1, 2"))
def a19(s, d):
    return j15(s, d).groupBy("ref_id", "gained").agg(F.count("*").alias("support"), F.min("read_id").alias("representative"))


@query("a30_m04_five_way_entropy", sql("SELECT ref_id, round(list_sum([CASE WHEN c > 0 THEN -(c/n)*ln(c/n)/ln(5) ELSE 0 END for c in cs]), 6) AS entropy FROM (SELECT ref_id, length(pattern)::DOUBLE AS n, [(length(pattern)-length(replace(pattern, b, '')))::DOUBLE for b in ['A','C','G','T','-']] AS cs FROM refs) WHERE n > 0"))
def a30(s, d):
    n = F.length("pattern")
    counts = F.array(*[n - F.length(F.replace("pattern", F.lit(b), F.lit(""))) for b in "ACGT-"])
    total = F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(c > 0, -(c / n) * F.log(c / n) / F.log(F.lit(5.0))).otherwise(0.0))
    return refs(s, d).where(n > 0).select("ref_id", F.round(total, 6).alias("entropy"))


@query("a31_worker_totals", "SELECT worker, count(*) AS n_rows, sum(l_linenumber) AS n_lines FROM (SELECT l_orderkey%8 AS worker, l_linenumber FROM lineitem) GROUP BY ROLLUP (worker)")
def a31(s, d):
    """Each worker's counts and their sum, in one pass."""
    return table(s, d, "lineitem").select((F.col("l_orderkey") % 8).alias("worker"), "l_linenumber").rollup("worker").agg(F.count("*").alias("n_rows"), F.sum("l_linenumber").alias("n_lines"))


@query("w07_runs_of_equal_items", sql("SELECT ref_id, item, min(read_id) AS first_read, count(*) AS n FROM (SELECT ref_id, read_id, item, row_number() OVER (PARTITION BY ref_id ORDER BY read_id) - row_number() OVER (PARTITION BY ref_id, item ORDER BY read_id) AS island FROM (SELECT ref_id, read_id, right_flank > 18 AS item FROM reads)) GROUP BY ref_id, item, island"))
def w07(s, d):
    """Adjacent equal items of a reference: a run begins where the item before differs, so one window and one shuffle do."""
    by = W.partitionBy("ref_id").orderBy("read_id")
    rows = read_trs(s, d).select("ref_id", "read_id", (F.col("right_flank") > 18).alias("item")).withColumn("new", F.coalesce((F.col("item") != F.lag("item").over(by)).cast("int"), F.lit(1)))
    return rows.withColumn("island", F.sum("new").over(by)).groupBy("ref_id", "island").agg(F.first("item").alias("item"), F.min("read_id").alias("first_read"), F.count("*").alias("n")).drop("island")


@query("o07_first_of_each", sql("SELECT chrom, ref_id, n FROM (SELECT chrom, ref_id, length(pattern) AS n, row_number() OVER (PARTITION BY chrom ORDER BY length(pattern) DESC, ref_id) AS k FROM refs) WHERE k = 1"))
def o07(s, d):
    """The first row of a mixed order, by one aggregate instead of a sort."""
    n = F.length("pattern")
    return refs(s, d).groupBy("chrom").agg(F.min(F.struct((-n).alias("less"), "ref_id")).alias("x")).select("chrom", "x.ref_id", (-F.col("x.less")).alias("n"))


@query("d02_mirrored_repeats", sql(f"""SELECT ref_id, 'r'||ref_id AS head, rc AS is_rc, CASE WHEN rc THEN 900-last+1 ELSE first END AS first, CASE WHEN rc THEN 900-first+1 ELSE last END AS last,
  CASE WHEN rc THEN n_t ELSE n_a END AS n_a, CASE WHEN rc THEN n_g ELSE n_c END AS n_c, CASE WHEN rc THEN n_c ELSE n_g END AS n_g, CASE WHEN rc THEN n_a ELSE n_t END AS n_t,
  CASE WHEN rc THEN {TURN.format('pattern')} ELSE pattern END AS pattern, CASE WHEN rc THEN {TURN.format('pattern')} ELSE pattern END AS sequence,
  CASE WHEN rc THEN {TURN.format('right(pattern, 3)')} ELSE left(pattern, 3) END AS left_flank, CASE WHEN rc THEN {TURN.format('left(pattern, 3)')} ELSE right(pattern, 3) END AS right_flank
  FROM (SELECT ref_id, pattern, ref_id%2=0 AS rc, 10 AS first, 10+length(pattern) AS last, {', '.join(f"length(pattern)-length(replace(pattern, '{b}', '')) AS n_{b.lower()}" for b in 'ACGT')} FROM refs)"""))
def d02(s, d):
    """Repeats of reverse reads in forward coordinates; every other one is named as reverse, of a read of 900 symbols."""
    n = F.length("pattern")
    head = F.concat(F.lit("r"), F.col("ref_id"), F.when(F.col("ref_id") % 2 == 0, "_900_RCYES").otherwise(""))
    counts = [(n - F.length(F.replace("pattern", F.lit(b), F.lit("")))).alias(f"n_{b.lower()}") for b in "ACGT"]
    rows = refs(s, d).select("ref_id", head.alias("head"), F.lit(10).alias("first"), (n + 10).alias("last"), *counts, "pattern", F.col("pattern").alias("sequence"), scalars.left("pattern", 3).alias("left_flank"), scalars.right("pattern", 3).alias("right_flank"))
    return mirror_reverse(rows)


@query("m02_m07_signed_numbers", sql("SELECT read_id, least(left_flank, right_flank) AS low, greatest(left_flank, right_flank) AS high, abs(left_flank-right_flank) AS apart, -ref_id AS signed_ref FROM reads"))
def m02(s, d):
    left, right = F.col("left_flank"), F.col("right_flank")
    return read_trs(s, d).select("read_id", F.least(left, right).alias("low"), F.greatest(left, right).alias("high"), F.abs(left - right).alias("apart"), (-F.col("ref_id")).alias("signed_ref"))


@query("s29_spanning_reads", sql("SELECT o_orderkey AS sid, '>' || o_orderpriority || chr(10) || o_orderstatus AS value FROM orders WHERE o_orderkey IN (SELECT sid FROM reads WHERE left_flank >= 10 AND right_flank >= 25)"))
def s29(s, d):
    """Orders stand for reads."""
    reads = table(s, d, "orders").select(F.col("o_orderkey").alias("sid"), F.col("o_orderpriority").alias("head"), F.col("o_orderstatus").alias("dna"))
    return sinks.spanning_reads(reads, read_trs(s, d).where("right_flank >= 25"))


@query("s32_filtered_references", sql("SELECT -ref_id AS ref_id, chrom FROM refs WHERE ref_id NOT IN (SELECT ref_id FROM reads WHERE flank_score < 0.93 AND prof_score < 0.92)"))
def s32(s, d):
    """References are written with negative ids."""
    own = refs(s, d).select((-F.col("ref_id")).alias("ref_id"), "chrom")
    return sinks.filtered_references(own, read_trs(s, d).where("flank_score < 0.93 and prof_score < 0.92").select("ref_id"))


@query("s16_redundancy_lines", sql("SELECT min(ref_id) AS head, string_agg(CAST(-ref_id AS VARCHAR), ' ' ORDER BY ref_id) AS value FROM refs GROUP BY chrom, length(pattern)"))
def s16(s, d):
    """Patterns of one size of a cluster stand for a group."""
    own = refs(s, d).select(F.col("ref_id").alias("rid"), F.min("ref_id").over(W.partitionBy("chrom", F.length("pattern"))).alias("head"))
    return sinks.redundancy_lines(own)


@query("j25_reference_pairs", sql("""SELECT a.ref_id AS a, b.ref_id AS b, levenshtein(left(a.pattern, 12), left(b.pattern, 12)) AS ll, levenshtein(right(a.pattern, 12), right(b.pattern, 12)) AS rr,
  levenshtein(left(a.pattern, 12), reverse(translate(right(b.pattern, 12), 'ACGT', 'TGCA'))) AS lr, levenshtein(right(a.pattern, 12), reverse(translate(left(b.pattern, 12), 'ACGT', 'TGCA'))) AS rl
  FROM refs a JOIN refs b ON a.chrom = b.chrom AND a.ref_id < b.ref_id AND 10 * abs(length(a.pattern) - length(b.pattern)) <= length(a.pattern)"""))
def j25(s, d):
    """Brands stand for clusters, the ends of a pattern for its flanks."""
    own = refs(s, d).select("ref_id", F.col("chrom").alias("cid"), "pattern", F.substring("pattern", 1, 12).alias("left_flank"), scalars.right("pattern", 12).alias("right_flank"))
    return links.reference_pairs(own, 0.1)
