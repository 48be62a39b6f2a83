"""Redundancy groups, spaced-seed candidates, flank checks and parity components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satellion.functions import kernels
from satellion.functions.scalars import error_limit, reverse_complement
from satellion.functions.shipping import ship
from satellion.functions.storing import discard, store

#: Least pattern lengths of the size ranges and their seed masks (* skips a symbol).
RANGES = (6, 10, 17, 25, 30, 39, 59, 89, 134, 201, 303, 474, 715, 1111)
MASKS = (
    "111*1", "1111*11", "11111*111", "11111*1111", "111111*11111*11", "111111*111111*11", "111*11111*111*111*11",
    "11*111*11111**11**111*11*11", "11*111*11111**11**111*11*11", "11*111*11111**11**111*11*11", "11*111*11111**11**111*11*11",
    "1**11***1111**11*11**1*11*11*111**11", "1**11***1111**11*11**1*11*11*111**11**111", "1**11***1111**11*11**1*11*11*111**11**111*1*11",
)


def min_representation(p: str, rc: str) -> tuple[Column, Column]:
    """The smaller of profile and reverse profile (by length, then elements) and whether it is the reverse one."""
    a, b = F.struct(F.size(p).alias("n"), F.col(p).alias("p")), F.struct(F.size(rc).alias("n"), F.col(rc).alias("p"))
    return F.least(a, b)["p"], b < a


def redundancy_groups(profiles: DataFrame) -> DataFrame:
    """profiles(rid, profile, profile_rc) -> (group_id, rid, is_rc, is_head): equal profiles in either orientation; the head is the smallest id."""
    low, turned = min_representation("profile", "profile_rc")
    a, b = F.struct(F.size("profile").alias("n"), F.col("profile").alias("p")), F.struct(F.size("profile_rc").alias("n"), F.col("profile_rc").alias("p"))
    keyed = profiles.select("rid", F.xxhash64(F.least(a, b)["p"], F.greatest(a, b)["p"]).alias("h"), F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), turned.alias("is_rc"))
    heads = keyed.groupBy("h", "lo", "hi").agg(F.min("rid").alias("group_id"))
    return keyed.join(heads, ["h", "lo", "hi"]).select("group_id", "rid", "is_rc", (F.col("rid") == F.col("group_id")).alias("is_head"))


def size_range(n: Column) -> Column:
    """Range 1.. of a pattern length; 0 below all."""
    out = F.lit(0)
    for i, least in enumerate(RANGES):
        out = F.when(n >= least, i + 1).otherwise(out)
    return out


def seeds(df: DataFrame, pattern: str, id_: str, neighbours: bool = False) -> DataFrame:
    """(id_, range, size, seed): distinct masked windows inside each pattern, by its own size range.

    With neighbours, also by every other range that holds a size within 10 % of it, so patterns on either side of a limit still meet.
    """
    n = F.length(pattern)
    low, high = (size_range(F.floor((n - 1) / 1.1)), size_range(F.ceil((n + 1) / 0.9))) if neighbours else (size_range(n), size_range(n))
    ranged = df.select(id_, pattern, n.alias("size"), F.explode(F.sequence(low, high)).alias("range")).where("range > 0")
    windows = F.array().cast("array<string>")
    for r, mask in enumerate(MASKS):
        windows = F.when((F.col("range") == r + 1) & (F.col("size") >= len(mask)), _windows(pattern, mask)).otherwise(windows)
    return ranged.select(id_, "range", "size", F.explode(F.array_distinct(windows)).alias("seed"))


def _windows(pattern: str, mask: str) -> Column:
    n = F.length(pattern)
    return F.transform(
        F.sequence(F.lit(0), F.greatest(n - len(mask), F.lit(0))),
        lambda i: F.concat(*[F.substring(F.col(pattern), i + k + 1, F.lit(1)) for k, m in enumerate(mask) if m == "1"]),
    )


def seed_candidates(refs: DataFrame, reads: DataFrame) -> DataFrame:
    """refs(ref_id, pattern), reads(read_id, pattern) -> (ref_id, read_id, ref_rc): a seed in common and sizes within 10 %. Joined on seed hash by Spark's skew-aware join, then distinct."""
    both = refs.select("ref_id", "pattern", F.lit(False).alias("rc")).union(refs.select("ref_id", reverse_complement("pattern").alias("pattern"), F.lit(True)))
    keyed = both.withColumn("k", F.struct("ref_id", "rc"))
    left = seeds(keyed, "pattern", "k", neighbours=True).select("k", "range", "seed", F.col("size").alias("ref_size"))
    right = seeds(reads, "pattern", "read_id").select("read_id", "range", "seed", F.col("size").alias("read_size"))
    slack = (F.col("read_size") * 0.10 + 1.0).cast("int")
    near = left.join(right, ["range", "seed"]).where(F.abs(F.col("ref_size") - F.col("read_size")) <= slack)
    return near.select("k.ref_id", "read_id", F.col("k.rc").alias("ref_rc")).distinct()


def consensus_filter(cands: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs whose consensus patterns share a long enough subsequence."""
    ship(cands.sparkSession)
    short = F.least(F.length(a), F.length(b))
    return cands.withColumn("lcs", kernels.lcs(a, b)).where(F.col("lcs") >= F.least((0.85 * short + 0.5).cast("int"), short - 1))


def flank_align(pairs: DataFrame, max_flank: int = 60) -> DataFrame:
    """pairs(..., ref_left, ref_right, left, right) with lerr, rerr, left_len, right_len and is_rc of the better accepted orientation (forward on ties); others are left out.

    Left flanks are compared from the array outwards. Reversing the pair swaps and complements the read's flanks. max_flank is 64 or less.
    """
    ship(pairs.sparkSession)
    turn = lambda c: F.reverse(F.col(c))
    comp = lambda c: F.translate(c, "ACGT", "TGCA")
    df = pairs.withColumns({"_rl": F.substring(turn("ref_left"), 1, max_flank + 10), "_rr": F.substring("ref_right", 1, max_flank + 10), "_l": F.substring(turn("left"), 1, max_flank), "_r": F.substring("right", 1, max_flank)})
    df = df.withColumns({"_cl": comp("_r"), "_cr": comp("_l")})
    df = df.withColumns({"_f1": kernels.anchored("_rl", "_l", 8), "_f2": kernels.anchored("_rr", "_r", 8), "_b1": kernels.anchored("_rl", "_cl", 8), "_b2": kernels.anchored("_rr", "_cr", 8)})
    ok = lambda e1, c1, e2, c2: (F.col(e1) <= error_limit(F.length(c1))) & (F.col(e2) <= error_limit(F.length(c2)))
    fwd, bwd = ok("_f1", "_l", "_f2", "_r"), ok("_b1", "_cl", "_b2", "_cr")
    rc = bwd & (~fwd | (F.col("_b1") + F.col("_b2") < F.col("_f1") + F.col("_f2")))
    pick = lambda a, b: F.when(F.col("is_rc"), b).otherwise(a)
    out = df.where(fwd | bwd).withColumn("is_rc", rc)
    out = out.withColumns({"lerr": pick(F.col("_f1"), F.col("_b1")), "rerr": pick(F.col("_f2"), F.col("_b2")), "left_len": pick(F.length("_l"), F.length("_cl")), "right_len": pick(F.length("_r"), F.length("_cr"))})
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def parity_components(edges: DataFrame) -> DataFrame:
    """edges(a, b, dir) -> (node, cid, dir): components by smallest id, with each node's direction relative to it.

    Labels are (id, direction) pairs: a neighbour's label arrives with the edge's direction added. The smallest pair wins, so an
    even path wins over an odd one where directions contradict. Every round is written to the shared folder, and the one before deleted.
    """
    both = edges.select("a", "b", F.col("dir").cast("int").alias("dir")).union(edges.select("b", "a", F.col("dir").cast("int"))).where("a is not null and b is not null and dir is not null").distinct()
    both = store(both)
    lab = F.struct(F.col("node").alias("cid"), F.lit(0).alias("dir"))
    labels = store(both.select(F.col("a").alias("node")).distinct().select("node", lab.alias("lab")))
    while True:
        own = labels.select(F.col("node").alias("near_node"), "lab")
        near = both.join(own, both.b == own.near_node).groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.col("lab.cid").alias("cid"), F.col("lab.dir").bitwiseXOR(F.col("dir")).alias("dir"))).alias("near"))
        moved = labels.select("node", "lab").join(near, "node").select("node", F.col("lab").alias("was"), F.least("lab", "near").alias("lab"))
        jump = moved.select(F.col("node").alias("far"), F.col("lab").alias("to"))
        nxt = moved.join(jump, F.col("lab.cid") == F.col("far")).select("node", "was", F.least("lab", F.struct(F.col("to.cid").alias("cid"), F.col("lab.dir").bitwiseXOR(F.col("to.dir")).alias("dir"))).alias("lab"))
        nxt = store(nxt)
        discard(labels)
        if nxt.where("was <> lab").isEmpty():
            discard(both)
            return nxt.select("node", F.col("lab.cid").alias("cid"), F.col("lab.dir").alias("dir"))
        labels = nxt


def clusters_with_refs(members: DataFrame) -> DataFrame:
    """members(node, cid, kind) of clusters that hold a reference."""
    has = members.groupBy("cid").agg(F.bool_or(F.col("kind") == "ref").alias("r")).where("r").select("cid")
    return members.join(has, "cid", "left_semi")


def duplicate_pairs(trs: DataFrame, max_diff: int = 2, max_len: int = 5000) -> DataFrame:
    """trs(ref_id, read_id, first, last, dna) -> unordered pairs (ref_id, a, b) with equal places and read lengths and a common subsequence of all but max_diff symbols. A start of 0 is never compared."""
    ship(trs.sparkSession)
    t = trs.where((F.col("first") != 0) & (F.length("dna") <= max_len)).withColumn("n", F.length("dna"))
    key = ["ref_id", "first", "last", "n"]
    a, b = t.select(*key, F.col("read_id").alias("a"), F.col("dna").alias("x")), t.select(*key, F.col("read_id").alias("b"), F.col("dna").alias("y"))
    return a.join(b, key).where("a < b").withColumn("lcs", kernels.lcs("x", "y")).where(F.col("lcs") >= F.col("n") - max_diff).select("ref_id", "a", "b")


def duplicates_to_drop(pairs: DataFrame) -> DataFrame:
    """(ref_id, read_id) that lose a pair: the read of higher degree, then of higher id. Pairs are judged one by one."""
    ends = pairs.select("ref_id", F.explode(F.array("a", "b")).alias("read_id"))
    degree = ends.groupBy("ref_id", "read_id").agg(F.count("*").alias("n"))
    d = lambda c: degree.select("ref_id", F.col("read_id").alias(c), F.struct("n", "read_id").alias(f"d{c}"))
    return pairs.join(d("a"), ["ref_id", "a"]).join(d("b"), ["ref_id", "b"]).select("ref_id", F.greatest("da", "db")["read_id"].alias("read_id")).distinct()


def first_of_run(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows without an earlier equal: duplicate suppression."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
