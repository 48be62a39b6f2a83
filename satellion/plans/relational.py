"""Relational operators over the adapters' frames: predicates, joins, aggregates, windows, sets, and the calling pipeline."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satellion.functions.scalars import entropy, percent
from satellion.operators import alleles, clustering, links, ranking
from satellion.operators.ids import dense_ids
from satellion.plans.adapters import read_trs, refs, sql, table
from satellion.plans.registry import query

# frames of the calling pipeline, as SQL
RANK = "rank AS (SELECT ref_id, read_id, sid, prof_score AS score, count(*) OVER (PARTITION BY sid) - 1 AS ties FROM (SELECT *, max(prof_score) OVER (PARTITION BY sid) AS m FROM reads WHERE prof_score >= 0.92) WHERE prof_score = m)"
RANKFLANK = "rankflank AS (SELECT ref_id, read_id, sid, flank_score AS score, count(*) OVER (PARTITION BY sid) - 1 AS ties FROM (SELECT *, max(flank_score) OVER (PARTITION BY sid) AS m FROM reads WHERE flank_score >= 0.90) WHERE flank_score = m)"
BBB = "bbb AS (SELECT r.ref_id, r.read_id, r.sid FROM rank r JOIN rankflank f USING (ref_id, read_id) WHERE r.ties = 0 OR f.ties = 0)"
#: Best pairs of a read's repeats: one read may hold several, each of its own place.
PAIRS = """pairs AS (SELECT * FROM (SELECT *, count(*) FILTER (prof_score = p) OVER w AS np, count(*) FILTER (flank_score = f) OVER w AS nf FROM (
  SELECT *, max(prof_score) FILTER (prof_score >= 0.92) OVER v AS p, max(flank_score) FILTER (flank_score >= 0.90) OVER v AS f FROM reads WINDOW v AS (PARTITION BY read_id)
  ) WINDOW w AS (PARTITION BY read_id)) WHERE prof_score = p AND flank_score = f AND (np = 1 OR nf = 1))"""
VOTES = PAIRS + """, votes AS (SELECT r.*, f.copynum AS ref_copynum, CASE WHEN r.copynum > f.copynum-0.8 AND r.copynum < f.copynum+0.8 THEN 0
  WHEN r.copynum > f.copynum THEN 1+CAST(trunc(round(r.copynum-(f.copynum+0.8),6)) AS INTEGER) ELSE -1-CAST(trunc(round((f.copynum-0.8)-r.copynum,6)) AS INTEGER) END AS copies
  FROM pairs r JOIN refs f USING (ref_id) WHERE left_flank >= 10 AND right_flank >= 10)"""
SUPPORT = f"""{VOTES}, counted AS (SELECT ref_id, copies, CAST(copies = 0 AS INTEGER) AS same_as_ref, count(*) AS support, CASE WHEN copies = 0 THEN max(ref_copynum) ELSE 0.0 END AS copies_float, min(read_id) AS representative
  FROM votes GROUP BY ref_id, copies), support AS (SELECT * FROM counted UNION ALL SELECT ref_id, 0, 1, 0, copynum, NULL FROM refs
  WHERE ref_id IN (SELECT ref_id FROM pairs) AND ref_id NOT IN (SELECT ref_id FROM counted WHERE copies = 0))"""
CLASSES = f"""{SUPPORT}, g AS (SELECT ref_id, CAST(sum(CAST(support >= 2 AS INTEGER)) AS INTEGER) AS n, max(CASE WHEN support >= 2 THEN same_as_ref ELSE 0 END) AS same, sum(support) AS total,
  max(CASE WHEN support >= 1 AND copies <> 0 THEN 1 ELSE 0 END) AS any_change FROM support GROUP BY ref_id),
  classes AS (SELECT ref_id, n AS alleles_sup, same AS allele_sup_same_as_ref, CAST(n > 0 AS INTEGER) AS has_support, CAST(total >= 1 AS INTEGER) AS span1, CAST(total >= 2 AS INTEGER) AS span_n,
  CAST(n = 1 AND same = 1 AS INTEGER) AS homez_same, CAST(n = 1 AND same = 0 AS INTEGER) AS homez_diff, CAST(n = 2 AND same = 1 AS INTEGER) AS hetez_same, CAST(n = 2 AND same = 0 AS INTEGER) AS hetez_diff,
  CAST(n > 2 AS INTEGER) AS hetez_multi, any_change AS support_vntr_span1, CAST((n = 1 AND same = 0) OR n >= 2 AS INTEGER) AS support_vntr FROM g)"""
STRINGS = f"""{SUPPORT}, ok AS (SELECT * FROM support WHERE support >= 2), strings AS (SELECT ref_id,
  CASE WHEN count(*) = 1 THEN CASE WHEN max(same_as_ref) = 1 THEN '0/0' ELSE '1/1' END ELSE array_to_string([CAST(x AS VARCHAR) for x in range(1 - max(same_as_ref), count(*) - max(same_as_ref) + 1)], '/') END AS gt,
  CASE WHEN max(same_as_ref) = 0 THEN '.,' ELSE '' END || string_agg(CAST(support AS VARCHAR), ',' ORDER BY same_as_ref DESC, copies) AS sp,
  CASE WHEN max(same_as_ref) = 0 THEN '.,' ELSE '' END || string_agg(CAST(copies AS VARCHAR), ',' ORDER BY same_as_ref DESC, copies) AS cgl FROM ok GROUP BY ref_id)"""


def _rank(s, d):
    return ranking.rank_with_ties(read_trs(s, d).select("ref_id", "read_id", "sid", F.col("prof_score").alias("score")), "sid", "score", 0.92)


def _rankflank(s, d):
    return ranking.rank_with_ties(read_trs(s, d).select("ref_id", "read_id", "sid", F.col("flank_score").alias("score")), "sid", "score", 0.90)


CUTS = ("prof_score", 0.92), ("flank_score", 0.90)


def _bbb(s, d):
    return ranking.flag_best(read_trs(s, d), "sid", *CUTS).select("ref_id", "read_id", "sid", "bbb")


def _pairs(s, d):
    """Flagged pairs of a read's repeats and references."""
    return ranking.flag_best(read_trs(s, d), "read_id", *CUTS).where("bbb = 1")


def _support(s, d):
    return alleles.call_alleles(_pairs(s, d), refs(s, d))


def _votes(s, d):
    own = refs(s, d).select("ref_id", F.col("copynum").alias("ref_copynum"))
    r = _pairs(s, d).where("left_flank >= 10 and right_flank >= 10").join(own, "ref_id")
    return r.withColumn("copies", alleles.copies_of(F.col("ref_copynum"), F.col("copynum")))


# --- calling pipeline
@query("w01_rank_profile", sql("SELECT * FROM rank", RANK))
def w01(s, d):
    return _rank(s, d)


@query("a22_rank_flank", sql("SELECT * FROM rankflank", RANKFLANK))
def a22(s, d):
    return _rankflank(s, d)


@query("w02_keep_best", sql("SELECT ref_id, read_id, sid, prof_score FROM (SELECT *, max(prof_score) OVER (PARTITION BY sid) m FROM reads) WHERE prof_score = m"))
def w02(s, d):
    return ranking.keep_best(read_trs(s, d), "sid", "prof_score").select("ref_id", "read_id", "sid", "prof_score")


@query("w03_one_per_read", sql("SELECT ref_id, sid, read_id, prof_score FROM (SELECT *, row_number() OVER (PARTITION BY ref_id, sid ORDER BY prof_score DESC, read_id DESC) n FROM reads) WHERE n = 1"))
def w03(s, d):
    return ranking.one_per_group(read_trs(s, d), ["ref_id", "sid"], [F.desc("prof_score"), F.desc("read_id")]).select("ref_id", "sid", "read_id", "prof_score")


@query("d19_bbb", sql("SELECT r.ref_id, r.read_id, r.sid, CAST(b.read_id IS NOT NULL AS INTEGER) AS bbb FROM reads r LEFT JOIN bbb b ON r.ref_id = b.ref_id AND r.read_id = b.read_id", f"{RANK}, {RANKFLANK}, {BBB}"))
def d19(s, d):
    return _bbb(s, d)


MULTI = f"""{PAIRS}, o AS (SELECT b.*, f.chrom, f.first_pos, f.last_pos, row_number() OVER w AS n,
  lead(b.ref_id) OVER w AS ref2, lead(b.read_id) OVER w AS read2, lead(chrom) OVER w AS chrom2, lead(first_pos) OVER w AS first2, lead(last_pos) OVER w AS last2
  FROM pairs b JOIN refs f USING (ref_id) WINDOW w AS (PARTITION BY b.sid ORDER BY b.prof_score, b.flank_score, b.ref_id, b.read_id)),
  bad AS (SELECT * FROM o WHERE n = 1 AND ref2 IS NOT NULL AND NOT (chrom = chrom2 AND greatest(last_pos,last2)-least(first_pos,first2)+1 <= 5000))"""


@query("d13_multi_mapped", sql("SELECT ref_id, read_id FROM bad UNION ALL SELECT ref2, read2 FROM bad", MULTI))
def d13(s, d):
    rows = _pairs(s, d).select("ref_id", "read_id", "sid", "prof_score", "flank_score")
    rows = rows.join(refs(s, d).select("ref_id", "chrom", "first_pos", "last_pos"), "ref_id").withColumn("read_len", F.lit(5000))
    return ranking.multi_mapped(rows)


@query("d14_allele_support", sql("SELECT * FROM support", SUPPORT))
def d14(s, d):
    return _support(s, d)


@query("d15_genotype_classes", sql("SELECT * FROM classes", CLASSES))
def d15(s, d):
    return alleles.classify(_support(s, d))


@query("a21_allele_strings", sql("SELECT * FROM strings", STRINGS))
def a21(s, d):
    return alleles.allele_strings(_support(s, d))


@query("d17_vcf_records", sql("""SELECT chrom, first_pos-1 AS pos, 'td'||ref_id AS id, CASE WHEN is_singleton THEN 'PASS' ELSE 'SC' END AS filter,
  'RC='||printf('%.2f',copynum)||';RPL='||length(pattern)||';RAL='||(last_pos-first_pos+1)||';RCP='||pattern AS info, 'GT:SP:CGL' AS format, gt||':'||sp||':'||cgl AS sample FROM strings JOIN refs USING (ref_id)""", STRINGS))
def d17(s, d):
    return alleles.vcf_records(alleles.allele_strings(_support(s, d)), refs(s, d))


@query("a20_variability", sql("SELECT chrom AS cluster, CAST(sum(CAST(change > 0 AS INTEGER)) AS BIGINT) AS variability, max(change) AS largest_change FROM (SELECT f.chrom, v.ref_id, max(abs(v.copies)) AS change FROM votes v JOIN refs f USING (ref_id) GROUP BY 1, 2) GROUP BY 1", VOTES))
def a20(s, d):
    v = _votes(s, d).join(refs(s, d).select("ref_id", F.col("chrom").alias("cluster")), "ref_id")
    return alleles.variability(v, "cluster")


@query("a17_group_lists", sql("SELECT ref_id, string_agg(CAST(same_as_ref AS VARCHAR), ',' ORDER BY copies) AS same_list, string_agg(CAST(support AS VARCHAR), ',' ORDER BY copies) AS support_list FROM support GROUP BY ref_id", SUPPORT))
def a17(s, d):
    g = _support(s, d).groupBy("ref_id").agg(F.sort_array(F.collect_list(F.struct("copies", "same_as_ref", "support"))).alias("a"))
    text = lambda f: F.array_join(F.transform("a", lambda x: x[f].cast("string")), ",")
    return g.select("ref_id", text("same_as_ref").alias("same_list"), text("support").alias("support_list"))


@query("a03_flag_sums", sql("SELECT CAST(sum(has_support) AS BIGINT) has_support, CAST(sum(span1) AS BIGINT) span1, CAST(sum(span_n) AS BIGINT) span_n, CAST(sum(homez_same) AS BIGINT) homez_same, CAST(sum(homez_diff) AS BIGINT) homez_diff, CAST(sum(hetez_same) AS BIGINT) hetez_same, CAST(sum(hetez_diff) AS BIGINT) hetez_diff, CAST(sum(hetez_multi) AS BIGINT) hetez_multi, CAST(sum(support_vntr) AS BIGINT) support_vntr FROM classes", CLASSES))
def a03(s, d):
    flags = ["has_support", "span1", "span_n", "homez_same", "homez_diff", "hetez_same", "hetez_diff", "hetez_multi", "support_vntr"]
    return alleles.classify(_support(s, d)).agg(*[F.sum(c).alias(c) for c in flags])


@query("a13_by_singleton", sql("SELECT is_singleton, support_vntr, count(DISTINCT ref_id) AS n FROM classes JOIN refs USING (ref_id) GROUP BY 1, 2", CLASSES))
def a13(s, d):
    return alleles.classify(_support(s, d)).join(refs(s, d), "ref_id").groupBy("is_singleton", "support_vntr").agg(F.countDistinct("ref_id").alias("n"))


@query("a07_alleles_by_copies", sql("SELECT CAST(copies AS VARCHAR) AS copies, count(*) AS n FROM support WHERE copies <> 0 AND support >= 2 GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*) FROM support WHERE copies <> 0 AND support >= 2", SUPPORT))
def a07(s, d):
    return _support(s, d).where("copies <> 0 and support >= 2").rollup("copies").agg(F.count("*").alias("n")).select(F.coalesce(F.col("copies").cast("string"), F.lit("TOTAL")).alias("copies"), "n")


@query("a08_by_patsize_copies", sql("SELECT length(pattern) AS patsize, copies, count(*) AS n FROM support JOIN refs USING (ref_id) WHERE copies <> 0 AND support >= 2 GROUP BY 1, 2", SUPPORT))
def a08(s, d):
    return _support(s, d).where("copies <> 0 and support >= 2").join(refs(s, d), "ref_id").groupBy(F.length("pattern").alias("patsize"), "copies").agg(F.count("*").alias("n"))


@query("a09_by_arraysize_copies", sql("SELECT least(last_pos-first_pos+1, 311) AS arraysize, copies, count(*) AS n FROM support JOIN refs USING (ref_id) WHERE copies <> 0 AND support >= 2 GROUP BY 1, 2", SUPPORT))
def a09(s, d):
    return _support(s, d).where("copies <> 0 and support >= 2").join(refs(s, d), "ref_id").groupBy(F.least(F.col("last_pos") - F.col("first_pos") + 1, F.lit(311)).alias("arraysize"), "copies").agg(F.count("*").alias("n"))


@query("a10_spanning_per_locus", sql("""SELECT total AS reads, sum(CAST(is_singleton AS INTEGER))::BIGINT AS singleton, sum(CAST(NOT is_singleton AS INTEGER))::BIGINT AS indist, count(*) AS all_refs
  FROM (SELECT ref_id, sum(support)::BIGINT AS total FROM support GROUP BY 1) JOIN refs USING (ref_id) GROUP BY 1""", SUPPORT))
def a10(s, d):
    g = _support(s, d).groupBy("ref_id").agg(F.sum("support").alias("reads")).join(refs(s, d), "ref_id")
    one = F.col("is_singleton").cast("int")
    return g.groupBy("reads").agg(F.sum(one).alias("singleton"), F.sum(1 - one).alias("indist"), F.count("*").alias("all_refs"))


@query("a11_alleles_by_class", sql("""SELECT support, sum(CAST(homez_diff = 1 AS INTEGER))::BIGINT AS inferred, sum(CAST(hetez_same + hetez_diff + hetez_multi > 0 AS INTEGER))::BIGINT AS observed, count(*) AS total
  FROM support JOIN classes USING (ref_id) WHERE support >= 2 GROUP BY 1""", CLASSES))
def a11(s, d):
    sup = _support(s, d)
    g = sup.where("support >= 2").join(alleles.classify(sup), "ref_id")
    return g.groupBy("support").agg(F.sum("homez_diff").alias("inferred"), F.sum((F.col("hetez_same") + F.col("hetez_diff") + F.col("hetez_multi") > 0).cast("int")).alias("observed"), F.count("*").alias("total"))


@query("a12_support_one", sql("SELECT count(DISTINCT ref_id) FILTER (support = 1 AND same_as_ref = 1) AS one_same, count(DISTINCT ref_id) FILTER (support = 1 AND same_as_ref = 0) AS one_diff, count(DISTINCT ref_id) FILTER (support > 1) AS more FROM support", SUPPORT))
def a12(s, d):
    when = lambda c: F.countDistinct(F.when(F.expr(c), F.col("ref_id")))
    return _support(s, d).agg(when("support = 1 and same_as_ref = 1").alias("one_same"), when("support = 1 and same_as_ref = 0").alias("one_diff"), when("support > 1").alias("more"))


# --- predicates
@query("f01_spanning", sql("SELECT read_id, length(pattern) >= 7 AND left_flank >= 12 AND right_flank >= 12 AS spanning FROM reads JOIN refs USING (ref_id)"))
def f01(s, d):
    r = read_trs(s, d).join(refs(s, d).select("ref_id", "pattern"), "ref_id")
    return r.select("read_id", ((F.length("pattern") >= 7) & (F.col("left_flank") >= 12) & (F.col("right_flank") >= 12)).alias("spanning"))


@query("f03_clusters_with_refs", "SELECT DISTINCT l_orderkey AS cid, l_partkey AS node, CASE WHEN l_returnflag = 'R' THEN 'ref' ELSE 'read' END AS kind FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def f03(s, d):
    kind = F.when(F.col("l_returnflag") == "R", "ref").otherwise("read").alias("kind")
    return clustering.clusters_with_refs(table(s, d, "lineitem").select(F.col("l_orderkey").alias("cid"), F.col("l_partkey").alias("node"), kind).distinct())


@query("f04_f05_score_cutoffs", sql("SELECT count(*) FILTER (prof_score >= 0.98) AS n98, count(*) FILTER (prof_score >= 0.95) AS n95 FROM reads"))
def f04(s, d):
    return read_trs(s, d).agg(F.count_if(F.col("prof_score") >= 0.98).alias("n98"), F.count_if(F.col("prof_score") >= 0.95).alias("n95"))


@query("f08_error_limit", sql("SELECT read_id, least(8, CAST(trunc(0.4*left_flank+0.01) AS INTEGER)) AS l, least(8, CAST(trunc(0.4*right_flank+0.01) AS INTEGER)) AS r FROM reads"))
def f08(s, d):
    from satellion.functions.scalars import error_limit

    return read_trs(s, d).select("read_id", error_limit(F.col("left_flank")).alias("l"), error_limit(F.col("right_flank")).alias("r"))


@query("f09_f10_size_ratio", sql("SELECT a.ref_id AS a, b.ref_id AS b FROM refs a JOIN refs b ON a.chrom = b.chrom AND a.ref_id < b.ref_id AND abs(length(a.pattern)-length(b.pattern)) <= CAST(trunc(length(a.pattern)*0.1+1.0) AS INTEGER) AND (greatest(length(a.pattern),length(b.pattern))/least(length(a.pattern),length(b.pattern))-1)*100 <= 15"))
def f09(s, d):
    """Sizes are paired first, their references after; a size of 0 has no ratio."""
    r = refs(s, d).select(F.col("ref_id").alias("id"), F.col("chrom").alias("cid"), F.length("pattern").alias("n"))
    slack = lambda n: (F.col(n) * 0.1 + 1.0).cast("int")
    ratio = F.try_divide(F.greatest("a_n", "b_n"), F.least("a_n", "b_n"))
    return links.size_pairs(r, slack("n"), (F.abs(F.col("a_n") - F.col("b_n")) <= slack("a_n")) & ((ratio - 1) * 100 <= 15))


@query("f11_voting_flanks", sql("SELECT read_id FROM reads WHERE left_flank >= 12 AND right_flank >= 12"))
def f11(s, d):
    return read_trs(s, d).where("left_flank >= 12 and right_flank >= 12").select("read_id")


@query("f16_proximity", sql("SELECT read_id, CAST(chrom = p AND pl - pf + 1 <= 100000 AS INTEGER) AS near FROM (SELECT read_id, chrom, lag(chrom) OVER w AS p, greatest(last_pos, lag(last_pos) OVER w) AS pl, least(first_pos, lag(first_pos) OVER w) AS pf FROM reads JOIN refs USING (ref_id) WINDOW w AS (PARTITION BY sid ORDER BY read_id)) WHERE p IS NOT NULL"))
def f16(s, d):
    w = W.partitionBy("sid").orderBy("read_id")
    r = read_trs(s, d).join(refs(s, d).select("ref_id", "chrom", "first_pos", "last_pos"), "ref_id")
    r = r.select("read_id", "chrom", F.lag("chrom").over(w).alias("p"), F.greatest("last_pos", F.lag("last_pos").over(w)).alias("pl"), F.least("first_pos", F.lag("first_pos").over(w)).alias("pf")).where("p is not null")
    return r.select("read_id", ((F.col("chrom") == F.col("p")) & (F.col("pl") - F.col("pf") + 1 <= 100000)).cast("int").alias("near"))


# --- joins
@query("j01_three_way", "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def j01(s, d):
    n, r = table(s, d, "nation"), table(s, d, "region")
    return table(s, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@query("j02_signed_key", sql("SELECT m.signed_id, f.chrom FROM (SELECT DISTINCT -ref_id AS signed_id FROM reads) m JOIN refs f ON f.ref_id = -m.signed_id"))
def j02(s, d):
    m = read_trs(s, d).select((-F.col("ref_id")).alias("signed_id")).distinct()
    return m.join(refs(s, d), F.col("ref_id") == -F.col("signed_id")).select("signed_id", "chrom")


@query("j04_left_and_semi", "SELECT c_custkey, o.n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o_custkey WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)")
def j04(s, d):
    o = table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = table(s, d, "customer").join(table(s, d, "supplier").select("s_nationkey"), F.col("c_nationkey") == F.col("s_nationkey"), "left_semi")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n")


@query("j05_j06_map_cluster", sql("SELECT r.read_id, f.chrom FROM reads r JOIN refs f USING (ref_id) WHERE r.read_id IN (SELECT read_id FROM reads WHERE flank_score >= 0.96)"))
def j05(s, d):
    r = read_trs(s, d)
    return r.join(r.where("flank_score >= 0.96").select("read_id"), "read_id", "left_semi").join(refs(s, d), "ref_id").select("read_id", "chrom")


@query("j07_j09_rank_join", sql("SELECT r.ref_id, r.read_id, r.score AS prof, f.score AS flank, t.copynum FROM rank r JOIN rankflank f USING (ref_id, read_id) JOIN reads t USING (ref_id, read_id)", f"{RANK}, {RANKFLANK}"))
def j07(s, d):
    key = ["ref_id", "read_id"]
    a, b = _rank(s, d).select(*key, F.col("score").alias("prof")), _rankflank(s, d).select(*key, F.col("score").alias("flank"))
    return a.join(b, key).join(read_trs(s, d).select(*key, "copynum"), key)


@query("j10_common_count", sql("SELECT count(*) AS n FROM rank JOIN rankflank USING (ref_id, read_id)", f"{RANK}, {RANKFLANK}"))
def j10(s, d):
    return _rank(s, d).join(_rankflank(s, d), ["ref_id", "read_id"]).agg(F.count("*").alias("n"))


@query("j11_lost_to_ties", sql("SELECT r.ref_id, f.chrom, f.first_pos FROM rank r JOIN rankflank k USING (ref_id, read_id) LEFT JOIN bbb b USING (ref_id, read_id) JOIN refs f USING (ref_id) GROUP BY 1, 2, 3 HAVING max(CAST(b.sid IS NOT NULL AS INTEGER)) = 0", f"{RANK}, {RANKFLANK}, {BBB}"))
def j11(s, d):
    key = ["ref_id", "read_id"]
    m = _rank(s, d).select(*key).join(_rankflank(s, d).select(*key), key).join(_bbb(s, d).select(*key, "bbb"), key)
    return m.groupBy("ref_id").agg(F.max("bbb").alias("b")).where("b = 0").join(refs(s, d), "ref_id").select("ref_id", "chrom", "first_pos")


@query("j16_two_aliases", "SELECT l_orderkey, l_linenumber, l_partkey, a.n_name AS cust_nation, b.n_name AS supp_nation FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey")
def j16(s, d):
    n = table(s, d, "nation")
    a, b = n.select(F.col("n_nationkey").alias("ka"), F.col("n_name").alias("cust_nation")), n.select(F.col("n_nationkey").alias("kb"), F.col("n_name").alias("supp_nation"))
    x = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(table(s, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = x.join(table(s, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(table(s, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return x.join(a, F.col("c_nationkey") == F.col("ka")).join(b, F.col("s_nationkey") == F.col("kb")).select("l_orderkey", "l_linenumber", "l_partkey", "cust_nation", "supp_nation")


@query("j18_d21_discarded_ids", sql("SELECT DISTINCT unnest([ref_id, origin]) AS id FROM (SELECT ref_id, min(ref_id) OVER (PARTITION BY sid) AS origin FROM reads) WHERE ref_id <> origin"))
def j18(s, d):
    """A read's first reference stands for its origin; both ids of a false mapping are discarded."""
    bad = read_trs(s, d).select("ref_id", F.min("ref_id").over(W.partitionBy("sid")).alias("origin")).where("ref_id <> origin")
    return bad.select(F.explode(F.array("ref_id", "origin")).alias("id")).distinct()


@query("j20_range_condition", "SELECT p_partkey, count(*) AS n FROM part JOIN lineitem ON l_partkey = p_partkey AND l_quantity BETWEEN p_size AND p_size + 10 GROUP BY 1")
def j20(s, d):
    l, p = table(s, d, "lineitem").select("l_partkey", "l_quantity"), table(s, d, "part").select("p_partkey", "p_size")
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).where("l_quantity between p_size and p_size + 10").groupBy("p_partkey").agg(F.count("*").alias("n"))


@query("j21_j22_derived", sql("SELECT f.ref_id, f.chrom, m.b FROM refs f JOIN (SELECT ref_id, max(prof_score) AS b FROM reads GROUP BY 1) m USING (ref_id)"))
def j21(s, d):
    return refs(s, d).join(read_trs(s, d).groupBy("ref_id").agg(F.max("prof_score").alias("b")), "ref_id").select("ref_id", "chrom", "b")


@query("j28_update_from", "SELECT c_custkey, coalesce(o.m, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) o ON c_custkey = o_custkey")
def j28(s, d):
    o = table(s, d, "orders").where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("m"))
    return table(s, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("m", "c_acctbal").alias("c_acctbal"))


@query("j30_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j30(s, d):
    urgent = table(s, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return table(s, d, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j31_semi", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def j31(s, d):
    return table(s, d, "documents").select("doc_id").join(table(s, d, "labels").select("doc_id"), "doc_id", "left_semi")


@query("j32_symmetric_difference", "SELECT coalesce(a.k, b.k) AS k FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity >= 45) a FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity <= 5) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def j32(s, d):
    """Keys of one of two sets alone."""
    rows = table(s, d, "lineitem")
    a, b = (rows.where(c).select(F.col("l_partkey").alias(n)).distinct() for c, n in (("l_quantity >= 45", "a"), ("l_quantity <= 5", "b")))
    return a.join(b, F.col("a") == F.col("b"), "full_outer").where("a is null or b is null").select(F.coalesce("a", "b").alias("k"))


# --- aggregates
@query("a01_a02_counts", sql("SELECT count(*) AS n, count(DISTINCT ref_id) AS refs, count(DISTINCT sid) AS reads FROM reads"))
def a01(s, d):
    return read_trs(s, d).agg(F.count("*").alias("n"), F.countDistinct("ref_id").alias("refs"), F.countDistinct("sid").alias("reads"))


@query("a04_by_pattern_size", sql("SELECT least(length(pattern), 122) AS patsize, count(*) AS n FROM refs GROUP BY 1"))
def a04(s, d):
    return refs(s, d).groupBy(F.least(F.length("pattern"), F.lit(122)).alias("patsize")).agg(F.count("*").alias("n"))


@query("a05_a06_histogram_merge", sql("SELECT size, sum(n_all)::BIGINT AS n_all, sum(n_single)::BIGINT AS n_single, CASE WHEN sum(n_all) > 0 THEN CAST(trunc(100*sum(n_single)/sum(n_all)) AS INTEGER) ELSE 0 END AS pct FROM (SELECT least(last_pos-first_pos+1,311) AS size, 1 AS n_all, 0 AS n_single FROM refs UNION ALL SELECT least(last_pos-first_pos+1,311), 0, 1 FROM refs WHERE is_singleton) GROUP BY 1"))
def a05(s, d):
    size = F.least(F.col("last_pos") - F.col("first_pos") + 1, F.lit(311)).alias("size")
    g = refs(s, d).groupBy(size).agg(F.count("*").alias("n_all"), F.count_if("is_singleton").alias("n_single"))
    return g.withColumn("pct", percent(F.col("n_single"), F.col("n_all")))


@query("a14_having_one", "SELECT l_orderkey, max(l_partkey) AS only_part FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1 HAVING count(*) = 1")
def a14(s, d):
    g = table(s, d, "lineitem").select("l_orderkey", "l_partkey").distinct().groupBy("l_orderkey")
    return g.agg(F.count("*").alias("n"), F.max("l_partkey").alias("only_part")).where("n = 1").select("l_orderkey", "only_part")


@query("a16_many_per_read", sql("SELECT sid, count(ref_id) AS n FROM reads GROUP BY 1 HAVING count(ref_id) > 1"))
def a16(s, d):
    return read_trs(s, d).groupBy("sid").agg(F.count("ref_id").alias("n")).where("n > 1")


@query("a18_cluster_stats", sql("SELECT chrom, min(length(pattern)) AS minpat, max(length(pattern)) AS maxpat, count(*) AS refcount, CAST(floor((max(length(pattern))/min(length(pattern))-1)*100+0.5) AS BIGINT) AS spread FROM refs GROUP BY 1"))
def a18(s, d):
    n = F.length("pattern")
    return refs(s, d).groupBy("chrom").agg(F.min(n).alias("minpat"), F.max(n).alias("maxpat"), F.count("*").alias("refcount"), F.floor((F.max(n) / F.min(n) - 1) * 100 + 0.5).alias("spread"))


@query("a23_mean_similarity", sql("SELECT chrom, round(avg(prof_score), 4) AS profdensity FROM reads JOIN refs USING (ref_id) GROUP BY 1"))
def a23(s, d):
    return read_trs(s, d).join(refs(s, d).select("ref_id", "chrom"), "ref_id").groupBy("chrom").agg(F.round(F.avg("prof_score"), 4).alias("profdensity"))


@query("a24_index_stats", sql("SELECT count(*) AS trs, count(*) FILTER (length(pattern) >= 20) AS trs_ge, count(DISTINCT sid) AS reads, count(DISTINCT sid) FILTER (length(pattern) >= 20) AS reads_ge FROM reads JOIN refs USING (ref_id)"))
def a24(s, d):
    long_ = F.length("pattern") >= 20
    return read_trs(s, d).join(refs(s, d).select("ref_id", "pattern"), "ref_id").agg(F.count("*").alias("trs"), F.count_if(long_).alias("trs_ge"), F.countDistinct("sid").alias("reads"), F.countDistinct(F.when(long_, F.col("sid"))).alias("reads_ge"))


@query("a25_w09_flank_histogram", sql("SELECT flank, n, CAST(sum(n) OVER (ORDER BY flank DESC) AS BIGINT) AS at_least FROM (SELECT least(left_flank, right_flank, 20) AS flank, count(*) AS n FROM reads GROUP BY 1)"))
def a25(s, d):
    g = read_trs(s, d).groupBy(F.least("left_flank", "right_flank", F.lit(20)).alias("flank")).agg(F.count("*").alias("n"))
    return g.withColumn("at_least", F.sum("n").over(W.orderBy(F.desc("flank"))))


@query("a27_coverage", sql("SELECT pos, count(*) AS n FROM (SELECT unnest(range(first_pos//100, last_pos//100+1)) AS pos FROM refs) GROUP BY 1"))
def a27(s, d):
    cell = lambda c: (F.col(c) / 100).cast("long")
    return refs(s, d).select(F.explode(F.sequence(cell("first_pos"), cell("last_pos"))).alias("pos")).groupBy("pos").agg(F.count("*").alias("n"))


# --- windows and sets
@query("w05_dense_ids", "SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS id FROM orders")
def w05(s, d):
    return dense_ids(table(s, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"]).select("o_orderkey", "id")


@query("w06_first_seen", sql("SELECT read_id, min(read_id) OVER (PARTITION BY sid) AS first_id FROM reads"))
def w06(s, d):
    return read_trs(s, d).select("read_id", F.min("read_id").over(W.partitionBy("sid")).alias("first_id"))


@query("w08_suppress_duplicates", sql("SELECT read_id FROM (SELECT read_id, row_number() OVER (PARTITION BY sid, ref_id, copynum ORDER BY read_id) AS n FROM reads) WHERE n = 1"))
def w08(s, d):
    return clustering.first_of_run(read_trs(s, d), ["sid", "ref_id", "copynum"], ["read_id"]).select("read_id")


@query("w11_blocks", sql("SELECT read_id, (row_number() OVER (PARTITION BY ref_id ORDER BY read_id) - 1) // 10 AS block FROM reads"))
def w11(s, d):
    return read_trs(s, d).select("read_id", F.expr("(row_number() over (partition by ref_id order by read_id) - 1) div 10").alias("block"))


@query("o08_o09_key_union", "SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)")
def o08(s, d):
    return table(s, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(s, d, "supplier").select("s_nationkey")).distinct()


@query("o11_duplicate_ids", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def o11(s, d):
    return table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("d16_entropy", sql("""SELECT ref_id, round(CASE WHEN a > 0 THEN -(a/t)*log2(a/t) ELSE 0 END + CASE WHEN c > 0 THEN -(c/t)*log2(c/t) ELSE 0 END + CASE WHEN g > 0 THEN -(g/t)*log2(g/t) ELSE 0 END + CASE WHEN u > 0 THEN -(u/t)*log2(u/t) ELSE 0 END, 6) AS entropy
  FROM (SELECT ref_id, length(pattern) AS t, length(pattern)-length(replace(pattern,'A','')) AS a, length(pattern)-length(replace(pattern,'C','')) AS c, length(pattern)-length(replace(pattern,'G','')) AS g, length(pattern)-length(replace(pattern,'T','')) AS u FROM refs)"""))
def d16(s, d):
    return refs(s, d).select("ref_id", F.round(entropy("pattern"), 6).alias("entropy"))


@query("d18_pcr_degrees", sql("SELECT DISTINCT ref_id, CASE WHEN (da, a) > (db, b) THEN a ELSE b END AS read_id FROM pairs JOIN (SELECT ref_id, x AS a, count(*) AS da FROM ends GROUP BY 1, 2) USING (ref_id, a) JOIN (SELECT ref_id, x AS b, count(*) AS db FROM ends GROUP BY 1, 2) USING (ref_id, b)",
  "pairs AS (SELECT p.ref_id, p.read_id AS a, q.read_id AS b FROM reads p JOIN reads q ON p.ref_id = q.ref_id AND p.left_flank = q.left_flank AND p.right_flank = q.right_flank AND p.copynum = q.copynum AND p.read_id < q.read_id), ends AS (SELECT ref_id, a AS x FROM pairs UNION ALL SELECT ref_id, b FROM pairs)"))
def d18(s, d):
    key = ["ref_id", "left_flank", "right_flank", "copynum"]
    r = read_trs(s, d)
    pairs = r.select(*key, F.col("read_id").alias("a")).join(r.select(*key, F.col("read_id").alias("b")), key).where("a < b").select("ref_id", "a", "b")
    return clustering.duplicates_to_drop(pairs)


@query("g01_components")
def g01(s, d):
    """Orders and parts, each on one of two sides, so an edge turns where its ends' sides differ; recursive SQL over the whole table is too slow, so a test holds it against union-find."""
    e = table(s, d, "lineitem").select(F.col("l_orderkey").alias("a"), (-F.col("l_partkey") - 1).alias("b")).distinct()
    side = lambda c: F.pmod(F.col(c), F.lit(3)) == 0
    return clustering.parity_components(e.withColumn("dir", (side("a") != side("b")).cast("int"))).select("node", "cid", "dir")
