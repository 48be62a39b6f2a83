"""Reports, clusters and the remaining relational forms as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from satellion.functions import scalars
from satellion.functions.storing import store
from satellion.operators import alleles, clustering, links, profiles, reports
from satellion.plans.adapters import read_trs, refs, sql, table
from satellion.plans.registry import query
from satellion.plans.relational import BBB, CLASSES, RANK, RANKFLANK, SUPPORT, _bbb, _rank, _rankflank, _support

PAIR = ["ref_id", "read_id"]
FLAGGED = f"{CLASSES}, flagged AS (SELECT f.*, coalesce(span1,0) AS span1, coalesce(span_n,0) AS span_n, coalesce(support_vntr,0) AS support_vntr FROM refs f LEFT JOIN classes USING (ref_id))"


def _flagged(s, d):
    flags = ["span1", "span_n", "support_vntr"]
    return refs(s, d).join(alleles.classify(_support(s, d)).select("ref_id", *flags), "ref_id", "left").na.fill(0, flags)


def _size_sql(size: str, cap: int) -> str:
    cols = ", ".join(f"sum(CAST({f} > 0 AS INTEGER))::BIGINT AS n_{f}" for f in ("span1", "span_n", "support_vntr"))
    pct = ", ".join(f"CAST(100*n_{f}//n_all AS INTEGER) AS pct_{f}" for f in ("span1", "span_n", "support_vntr"))
    label = f"CASE WHEN s IS NULL THEN 'TOTAL' WHEN s = {cap} THEN '{cap}+' ELSE CAST(s AS VARCHAR) END AS size"
    return f"SELECT {label}, n_all, n_span1, n_span_n, n_support_vntr, {pct} FROM (SELECT s, count(*) AS n_all, {cols} FROM (SELECT least({size}, {cap}) AS s, * FROM flagged) GROUP BY ROLLUP (s))"


@query("s25_a06_pattern_sizes", sql(_size_sql("length(pattern)", 20), FLAGGED))
def s25_pattern(s, d):
    return reports.size_table(_flagged(s, d), F.length("pattern"), ["span1", "span_n", "support_vntr"], 20)


@query("s25_a06_array_sizes", sql(_size_sql("last_pos-first_pos+1", 311), FLAGGED))
def s25_array(s, d):
    return reports.size_table(_flagged(s, d), F.col("last_pos") - F.col("first_pos") + 1, ["span1", "span_n", "support_vntr"], 311)


@query("s25_copies_with_total", sql("SELECT length(pattern) AS patsize, copies, count(*) AS n FROM support JOIN refs USING (ref_id) WHERE copies <> 0 AND support >= 2 GROUP BY GROUPING SETS ((patsize, copies), ())", SUPPORT))
def s25_copies(s, d):
    sized = _support(s, d).join(refs(s, d).select("ref_id", F.length("pattern").alias("patsize")), "ref_id")
    return reports.copies_table(sized, ["patsize", "copies"])


def _reads_sql(rows: str) -> str:
    return f"""SELECT reads, sum(coalesce(singleton,0))::BIGINT AS singleton, sum(coalesce(indist,0))::BIGINT AS indist, sum(coalesce(all_refs,0))::BIGINT AS all_refs FROM (SELECT CAST(unnest(range(0, (SELECT max(reads) FROM ({rows}))+1)) AS BIGINT) AS reads)
  LEFT JOIN (SELECT reads, sum(CAST(is_singleton AS INTEGER)) AS singleton, sum(CAST(NOT is_singleton AS INTEGER)) AS indist, count(*) AS all_refs FROM ({rows}) GROUP BY 1) USING (reads) GROUP BY ROLLUP (reads)"""


UNITS = {
    "locus": "SELECT CAST(sum(support) AS BIGINT) AS reads, is_singleton FROM support JOIN refs USING (ref_id) GROUP BY ref_id, is_singleton",
    "allele": "SELECT support AS reads, is_singleton FROM support JOIN refs USING (ref_id)",
    "vntr_allele": "SELECT support AS reads, is_singleton FROM support JOIN refs USING (ref_id) WHERE ref_id IN (SELECT ref_id FROM classes WHERE support_vntr > 0)",
}


def _reads(unit: str):
    def run(s, d):
        sup = _support(s, d)
        return reports.reads_table(sup, refs(s, d), alleles.classify(sup), unit)

    return query(f"a10_reads_per_{unit}", sql(_reads_sql(UNITS[unit]), CLASSES))(run)


a10_locus, a10_allele, a10_vntr_allele = map(_reads, UNITS)


@query("a11_classes_of_variable", sql("SELECT support, sum(homez_diff)::BIGINT AS inferred, sum(greatest(hetez_same, hetez_diff, hetez_multi))::BIGINT AS observed, count(*) AS total FROM support JOIN classes USING (ref_id) WHERE support_vntr > 0 GROUP BY 1", CLASSES))
def a11_variable(s, d):
    sup = _support(s, d)
    return reports.alleles_by_class(sup, alleles.classify(sup))


@query("a12_single_reads", sql("""SELECT count(DISTINCT ref_id) FILTER (copies <> 0 AND has_support = 0 AND support_vntr = 0) AS n_1a, count(DISTINCT ref_id) FILTER (copies <> 0 AND has_support = 1 AND support_vntr = 0) AS n_1b,
  count(DISTINCT ref_id) FILTER (homez_diff = 1) AS n_2a, count(DISTINCT ref_id) FILTER (hetez_same + hetez_diff + hetez_multi > 0) AS n_2b FROM support JOIN classes USING (ref_id) WHERE support = 1""", CLASSES))
def a12_single(s, d):
    sup = _support(s, d)
    return reports.single_read_counts(sup, alleles.classify(sup))


@query("s26_summary_counts", sql("""SELECT * FROM (SELECT sum(has_support)::BIGINT AS has_support, sum(span1)::BIGINT AS span1, sum(span_n)::BIGINT AS span_n, sum(homez_same)::BIGINT AS homez_same, sum(homez_diff)::BIGINT AS homez_diff, sum(hetez_same)::BIGINT AS hetez_same,
  sum(hetez_diff)::BIGINT AS hetez_diff, sum(hetez_multi)::BIGINT AS hetez_multi, sum(support_vntr)::BIGINT AS support_vntr FROM classes), (SELECT count(DISTINCT ref_id) AS refs_mapped, count(DISTINCT read_id) AS reads_mapped, count(DISTINCT read_id) FILTER (is_singleton) AS reads_singleton,
  count(DISTINCT read_id) FILTER (NOT is_singleton) AS reads_indist, count(DISTINCT ref_id) FILTER (is_singleton AND v = 0) AS invariant_singleton, count(DISTINCT ref_id) FILTER (NOT is_singleton AND v = 0) AS invariant_indist, count(DISTINCT ref_id) FILTER (is_singleton AND v > 0) AS vntr_singleton,
  count(DISTINCT ref_id) FILTER (NOT is_singleton AND v > 0) AS vntr_indist FROM (SELECT b.ref_id, b.read_id, is_singleton, coalesce(support_vntr, 0) AS v FROM bbb b JOIN refs USING (ref_id) LEFT JOIN classes USING (ref_id)))""", f"{CLASSES}, {RANK}, {RANKFLANK}, {BBB}"))
def s26(s, d):
    return reports.summary_counts(alleles.classify(_support(s, d)), refs(s, d), _bbb(s, d).where("bbb = 1"))


# --- clusters
MEMBERS = "members AS (SELECT chrom AS cid, 'ref' AS kind, ref_id AS id, length(pattern) AS patsize FROM refs UNION ALL SELECT DISTINCT f.chrom, 'read', r.read_id, length(f.pattern) FROM reads r JOIN refs f USING (ref_id))"


def _members(s, d):
    r = refs(s, d).withColumn("patsize", F.length("pattern"))
    reads = read_trs(s, d).join(r.select("ref_id", "chrom", "patsize"), "ref_id").select(F.col("chrom").alias("cid"), F.lit("read").alias("kind"), F.col("read_id").alias("id"), "patsize")
    return r.select(F.col("chrom").alias("cid"), F.lit("ref").alias("kind"), F.col("ref_id").alias("id"), "patsize").union(reads)


@query("a18_cluster_table", sql("SELECT cid, min(patsize) AS minpat, max(patsize) AS maxpat, count(*) AS repeatcount, count(*) FILTER (kind = 'ref') AS refcount, CAST(trunc((max(patsize)/min(patsize)-1)*100+0.5) AS INTEGER) AS spread FROM members GROUP BY 1", MEMBERS))
def a18_table(s, d):
    m = _members(s, d)
    return links.cluster_stats(m.drop("patsize"), m.select("kind", "id", "patsize"))


@query("d25_single_ref_clusters", "SELECT l_orderkey AS cid, max(l_partkey) AS ref_id, max(l_partkey) IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS is_mapped FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1 HAVING count(*) = 1")
def d25(s, d):
    l = table(s, d, "lineitem")
    m = l.select(F.col("l_orderkey").alias("cid"), F.lit("ref").alias("kind"), F.col("l_partkey").alias("id")).distinct()
    return links.single_ref_clusters(m, l.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("ref_id")))


@query("d11_joined_clusters", """WITH c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer UNION SELECT o_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey), m AS (SELECT k, -max(k) OVER (PARTITION BY n) - 1 AS cid FROM c)
  SELECT 'ref' AS kind, k AS id, cid FROM m UNION ALL SELECT 'read', o_orderkey, cid FROM orders JOIN m ON o_custkey = k""")
def d11(s, d):
    """Clusters of orders by customer and of customers by nation, joined at the customers."""
    o = table(s, d, "orders").join(table(s, d, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    row = lambda part, cid, kind, id_: [F.lit(part).alias("part"), F.col(cid).alias("cid"), F.lit(kind).alias("kind"), F.col(id_).cast("long").alias("id"), F.lit(False).alias("is_rc")]
    by_customer = o.select(*row(0, "o_custkey", "read", "o_orderkey")).union(o.select(*row(0, "o_custkey", "ref", "o_custkey")).distinct())
    return links.join_clusters(by_customer.union(table(s, d, "customer").select(*row(1, "c_nationkey", "ref", "c_custkey")))).select("kind", "id", "cid")


@query("a26_pair_degrees", sql("SELECT ref_id, x AS read_id, count(*) AS degree FROM (SELECT ref_id, unnest([a, b]) AS x FROM pairs) GROUP BY 1, 2", "pairs AS (SELECT p.ref_id, p.read_id AS a, q.read_id AS b FROM reads p JOIN reads q ON p.ref_id = q.ref_id AND p.left_flank = q.left_flank AND p.right_flank = q.right_flank AND p.copynum = q.copynum AND p.read_id < q.read_id)"))
def a26(s, d):
    """j26 too: each unordered pair once."""
    key = ["ref_id", "left_flank", "right_flank", "copynum"]
    r = read_trs(s, d)
    pairs = r.select(*key, F.col("read_id").alias("a")).join(r.select(*key, F.col("read_id").alias("b")), key).where("a < b")
    return pairs.select("ref_id", F.explode(F.array("a", "b")).alias("read_id")).groupBy("ref_id", "read_id").agg(F.count("*").alias("degree"))


@query("a28_group_count", sql("SELECT count(DISTINCT least(pattern, reverse(translate(pattern,'ACGT','TGCA')))) AS groups FROM refs"))
def a28(s, d):
    code = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x).cast("short"))
    p = refs(s, d).withColumn("rc", scalars.reverse_complement("pattern")).select(F.col("ref_id").alias("rid"), code("pattern").alias("profile"), code("rc").alias("profile_rc"))
    return clustering.redundancy_groups(p).agg(F.countDistinct("group_id").alias("groups"))


# --- joins
@query("j03_reads_of_clusters", sql("SELECT f.chrom AS cid, r.read_id, o.o_custkey AS head FROM reads r JOIN refs f USING (ref_id) JOIN orders o ON r.sid = o.o_orderkey"))
def j03(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("sid"), F.col("o_custkey").alias("head"))
    return read_trs(s, d).join(refs(s, d).select("ref_id", F.col("chrom").alias("cid")), "ref_id").join(o, "sid").select("cid", "read_id", "head")


@query("j12_ties_entries", sql("SELECT r.ref_id, r.read_id, r.ties AS prof_ties, f.ties AS flank_ties FROM rank r JOIN rankflank f USING (ref_id, read_id) WHERE r.ties > 0 AND f.ties > 0", f"{RANK}, {RANKFLANK}"))
def j12(s, d):
    a, b = _rank(s, d).select(*PAIR, F.col("ties").alias("prof_ties")), _rankflank(s, d).select(*PAIR, F.col("ties").alias("flank_ties"))
    return a.join(b, PAIR).where("prof_ties > 0 and flank_ties > 0")


@query("j14_best_of_cluster", sql("SELECT f.chrom AS cid, b.ref_id, b.read_id, r.copynum, f.copynum AS ref_copynum FROM bbb b JOIN refs f USING (ref_id) JOIN reads r ON r.ref_id = b.ref_id AND r.read_id = b.read_id", f"{RANK}, {RANKFLANK}, {BBB}"))
def j14(s, d):
    """j15 too: keys are looked up by one join."""
    f = refs(s, d).select("ref_id", F.col("chrom").alias("cid"), F.col("copynum").alias("ref_copynum"))
    return _bbb(s, d).where("bbb = 1").select(*PAIR).join(read_trs(s, d).select(*PAIR, "copynum"), PAIR).join(f, "ref_id")


@query("j17_results_and_refs", sql("SELECT ref_id, chrom, first_pos, alleles_sup, support_vntr FROM classes JOIN refs USING (ref_id)", CLASSES))
def j17(s, d):
    return alleles.classify(_support(s, d)).select("ref_id", "alleles_sup", "support_vntr").join(refs(s, d).select("ref_id", "chrom", "first_pos"), "ref_id")


@query("j19_two_left_joins", sql("SELECT m.ref_id, m.read_id, r.score AS prof, f.score AS flank FROM reads m LEFT JOIN rank r USING (ref_id, read_id) LEFT JOIN rankflank f USING (ref_id, read_id)", f"{RANK}, {RANKFLANK}"))
def j19(s, d):
    a, b = _rank(s, d).select(*PAIR, F.col("score").alias("prof")), _rankflank(s, d).select(*PAIR, F.col("score").alias("flank"))
    return read_trs(s, d).select(*PAIR).join(a, PAIR, "left").join(b, PAIR, "left")


@query("j27_ids_of_two_files", "SELECT count(*) AS n, count(*) FILTER (a.k IS NULL OR b.k IS NULL) AS unmatched FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem) a FULL JOIN (SELECT o_orderkey AS k FROM orders) b ON a.k = b.k")
def j27(s, d):
    a, b = table(s, d, "lineitem").select(F.col("l_orderkey").alias("a")).distinct(), table(s, d, "orders").select(F.col("o_orderkey").alias("b"))
    return a.join(b, F.col("a") == F.col("b"), "full_outer").agg(F.count("*").alias("n"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("unmatched"))


@query("j29_in_subquery", sql("SELECT count(DISTINCT ref_id) AS n FROM refs WHERE ref_id IN (SELECT ref_id FROM bbb)", f"{RANK}, {RANKFLANK}, {BBB}"))
def j29(s, d):
    return refs(s, d).join(_bbb(s, d).where("bbb = 1").select("ref_id"), "ref_id", "left_semi").agg(F.countDistinct("ref_id").alias("n"))


# --- predicates, orders, scalars
@query("f12_same_allele", sql("SELECT read_id, r.copynum > f.copynum-0.8 AND r.copynum < f.copynum+0.8 AS same FROM reads r JOIN refs f USING (ref_id)"))
def f12(s, d):
    own = refs(s, d).select("ref_id", F.col("copynum").alias("ref_copynum"))
    return read_trs(s, d).join(own, "ref_id").select("read_id", alleles.same_allele(F.col("ref_copynum"), F.col("copynum")).alias("same"))


@query("f13_supported", sql("SELECT ref_id, copies, support FROM support WHERE support >= 2", SUPPORT))
def f13(s, d):
    return _support(s, d).where("support >= 2").select("ref_id", "copies", "support")


@query("f17_f18_clean", "SELECT p_partkey, regexp_matches(p_name, '^[a-z]+ [a-z]+') AS valid, regexp_replace(upper(p_name), '[^ACGT]', 'N', 'g') AS clean FROM part")
def f17(s, d):
    return table(s, d, "part").select("p_partkey", F.col("p_name").rlike("^[a-z]+ [a-z]+").alias("valid"), scalars.clean_dna("p_name").alias("clean"))


@query("o02_by_length_then_text", sql("SELECT ref_id, row_number() OVER (ORDER BY length(pattern), pattern, ref_id) AS place FROM refs"))
def o02(s, d):
    """o01 and o05 too: several keys, parallel ranges."""
    from satellion.operators.ids import dense_ids

    return dense_ids(refs(s, d).select("ref_id", F.length("pattern").alias("n"), "pattern"), ["n", "pattern", "ref_id"], "place").select("ref_id", "place")


@query("o10_union_of_lengths", sql("SELECT ref_id, count(*) AS n_lengths FROM (SELECT DISTINCT ref_id, w FROM reads, (SELECT unnest([10, 12, 14]) AS w) WHERE left_flank >= w AND right_flank >= w) GROUP BY 1"))
def o10(s, d):
    each = read_trs(s, d).withColumn("w", F.explode(F.array(F.lit(10), F.lit(12), F.lit(14)))).where("left_flank >= w and right_flank >= w")
    return each.select("ref_id", "w").distinct().groupBy("ref_id").agg(F.count("*").alias("n_lengths"))


@query("x12_x17_directions", sql("SELECT ref_id, NOT is_singleton AS turned, repeat('a', length(pattern)) AS quality, last_pos-first_pos+1 AS arlen, copynum > 1 AS several FROM refs"))
def x12(s, d):
    """m09 and m10 too."""
    return refs(s, d).select("ref_id", (~F.col("is_singleton")).alias("turned"), F.expr("repeat('a', length(pattern))").alias("quality"), (F.col("last_pos") - F.col("first_pos") + 1).alias("arlen"), (F.col("copynum") > 1).alias("several"))


@query("d23_assembly_required", sql("SELECT ref_id, max(CAST(left_flank < 12 OR right_flank < 12 AS INTEGER)) AS assembly FROM reads GROUP BY 1"))
def d23(s, d):
    """References that any read fails to span."""
    return read_trs(s, d).groupBy("ref_id").agg(F.max(((F.col("left_flank") < 12) | (F.col("right_flank") < 12)).cast("int")).alias("assembly"))


@query("d20_indistinguishable")
def d20(s, d):
    """References whose profile and flanks pass as another one's; the pattern's neighbours stand for flanks."""
    r = refs(s, d).where("length(pattern) >= 6").select(F.col("ref_id").alias("rid"), F.concat("pattern", "pattern").alias("sequence"), "pattern", F.col("pattern").alias("left_flank"), F.col("pattern").alias("right_flank"))
    p = store(profiles.build_profiles(r))
    return links.indistinguishable(p, p, store(clustering.redundancy_groups(p)))


@query("d22_a23_edge_scores")
def d22(s, d):
    """A repeat's profile against that of its own array of two and a half copies, best of four orientations."""
    r = refs(s, d).withColumn("sequence", F.concat("pattern", "pattern"))
    a = profiles.build_profiles(r.select("ref_id", "chrom", "sequence", "pattern")).select("ref_id", F.col("chrom").alias("cid"), F.col("profile").alias("ref_profile"), F.col("profile_rc").alias("ref_profile_rc"))
    b = profiles.build_profiles(r.select("ref_id", F.concat("sequence", F.expr("left(pattern, length(pattern) div 2)")).alias("sequence"), "pattern")).select("ref_id", F.col("profile").alias("read_profile"), F.col("profile_rc").alias("read_profile_rc"))
    return profiles.mean_density(profiles.edge_scores(a.join(b, "ref_id")))
