"""From candidates to clusters: verification of representatives, fan-out to all members, flank checks, joining and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satellion.functions import kernels
from satellion.functions.scalars import error_limit
from satellion.functions.shipping import ship
from satellion.functions.storing import store
from satellion.operators.clustering import consensus_filter, parity_components, seed_candidates

PROFILE_COLUMNS = ("profile", "profile_rc")
FLANK_COLUMNS = ("left_flank", "right_flank")


def _named(df: DataFrame, id_: str, role: str, columns: tuple[str, ...]) -> DataFrame:
    return df.select(F.col(id_), *[F.col(c).alias(f"{role}_{c}") for c in columns])


def similar_pairs(cands: DataFrame, refs: DataFrame, reads: DataFrame, cutoff: float = 0.88) -> DataFrame:
    """cands(ref_id, read_id, ref_rc) whose consensus patterns share enough and whose profiles, with the reference turned where ref_rc says so, are cutoff similar: (ref_id, read_id, is_rc, sim)."""
    ship(cands.sparkSession)
    df = cands.join(_named(refs, "ref_id", "ref", PROFILE_COLUMNS), "ref_id").join(_named(reads, "read_id", "read", ("profile",)), "read_id")
    df = df.withColumn("_p", F.when(F.col("ref_rc"), F.col("ref_profile_rc")).otherwise(F.col("ref_profile")))
    df = df.withColumns({"_a": kernels.consensus_of("_p"), "_b": kernels.consensus_of("read_profile")})
    df = consensus_filter(df, "_a", "_b").withColumn("sim", kernels.similarity("_p", "read_profile"))
    return df.where(F.col("sim") >= cutoff).select("ref_id", "read_id", F.col("ref_rc").alias("is_rc"), F.round("sim", 4).alias("sim"))


def fan_out(links: DataFrame, ref_groups: DataFrame, read_groups: DataFrame) -> DataFrame:
    """links(ref_id, read_id, is_rc, ...) between heads, repeated for every member of both groups.

    Groups are (group_id, rid, is_rc, is_head) rows. A member's direction against its head is the xor of both is_rc, and a pair's is the xor of the link's and both
    members'. A head without a group stands for itself.
    """

    def members(groups: DataFrame, name: str) -> DataFrame:
        head = groups.where("is_head").select("group_id", F.col("is_rc").alias("_head"))
        return groups.join(head, "group_id").select(F.col("group_id").alias(f"{name}_id"), F.col("rid").alias(f"_{name}"), (F.col("is_rc") != F.col("_head")).alias(f"_{name}_rc"))

    df = links.join(members(ref_groups, "ref"), "ref_id", "left").join(members(read_groups, "read"), "read_id", "left")
    turned = lambda c: F.coalesce(F.col(c), F.lit(False))
    odd = (F.col("is_rc").cast("int") + turned("_ref_rc").cast("int") + turned("_read_rc").cast("int")) % 2 == 1
    rest = [c for c in links.columns if c not in ("ref_id", "read_id", "is_rc")]
    return df.select(F.coalesce("_ref", "ref_id").alias("ref_id"), F.coalesce("_read", "read_id").alias("read_id"), odd.alias("is_rc"), *rest)


def flank_errors(pairs: DataFrame, max_flank: int = 60) -> DataFrame:
    """pairs(..., is_rc, ref_left_flank, ref_right_flank, read_left_flank, read_right_flank) with lerr and rerr.

    Flanks are read from the array outwards. Where is_rc, the read's flanks change sides and are complemented. A read flank is cut to the reference's length, and max_flank is 64 or less.
    """
    ship(pairs.sparkSession)
    out = lambda c: F.reverse(F.coalesce(F.col(c), F.lit("")))
    same = lambda c: F.coalesce(F.col(c), F.lit(""))
    comp = lambda c: F.translate(c, "ACGTacgt", "TGCAtgca")
    ref = {"_rl": F.substring(out("ref_left_flank"), 1, max_flank), "_rr": F.substring(same("ref_right_flank"), 1, max_flank)}
    own, far = F.substring(out("read_left_flank"), 1, max_flank), F.substring(same("read_right_flank"), 1, max_flank)
    df = pairs.withColumns(ref | {"_l": F.when(F.col("is_rc"), comp(far)).otherwise(own), "_r": F.when(F.col("is_rc"), comp(own)).otherwise(far)})
    df = df.withColumns({"_ll": F.length("_l"), "_rlen": F.length("_r"), "_l": F.substring(F.col("_l"), F.lit(1), F.length("_rl")), "_r": F.substring(F.col("_r"), F.lit(1), F.length("_rr"))})
    df = df.withColumns({"lerr": kernels.anchored("_rl", "_l", 8), "rerr": kernels.anchored("_rr", "_r", 8), "left_len": F.col("_ll"), "right_len": F.col("_rlen")})
    return df.drop("_rl", "_rr", "_l", "_r", "_ll", "_rlen")


def verify_links(cands: DataFrame, refs: DataFrame, reads: DataFrame, ref_groups: DataFrame, read_groups: DataFrame, cutoff: float = 0.88, max_flank: int = 60) -> DataFrame:
    """(ref_id, read_id, is_rc, sim, lerr, rerr): candidates of heads are aligned once, then every member pair is held against its own flanks."""
    pairs = fan_out(similar_pairs(cands, refs, reads, cutoff), ref_groups, read_groups)
    pairs = pairs.join(_named(refs, "ref_id", "ref", FLANK_COLUMNS), "ref_id").join(_named(reads, "read_id", "read", FLANK_COLUMNS), "read_id")
    df = flank_errors(pairs, max_flank).where((F.col("lerr") <= error_limit(F.col("left_len"))) & (F.col("rerr") <= error_limit(F.col("right_len"))))
    return df.select("ref_id", "read_id", "is_rc", "sim", "lerr", "rerr").distinct()


def cluster_links(links: DataFrame) -> DataFrame:
    """links(ref_id, read_id, is_rc) -> (cid, kind, id, is_rc): clusters with directions. References and reads have ids of their own, from 0; in cid, which only labels, a reference counts as -id - 1."""
    edges = links.select((-F.col("ref_id") - 1).alias("a"), F.col("read_id").alias("b"), F.col("is_rc").cast("int").alias("dir"))
    parts = parity_components(edges)
    return parts.select("cid", F.when(F.col("node") < 0, "ref").otherwise("read").alias("kind"), F.when(F.col("node") < 0, -F.col("node") - 1).otherwise(F.col("node")).alias("id"), (F.col("dir") == 1).alias("is_rc"))


def join_clusters(members: DataFrame) -> DataFrame:
    """members(part, cid, kind, id, is_rc) of clusters found apart, joined where they share a repeat; directions are turned to agree.

    Every member is tied to its cluster's first one, so a cluster of n members costs n edges.
    """
    signed = F.when(F.col("kind") == "ref", -F.col("id") - 1).otherwise(F.col("id"))
    m = members.select("part", "cid", signed.alias("node"), F.col("is_rc").cast("int").alias("dir"))
    first = m.groupBy("part", "cid").agg(F.min(F.struct("node", "dir")).alias("f"))
    edges = m.join(first, ["part", "cid"]).select(F.col("f.node").alias("a"), F.col("node").alias("b"), F.col("f.dir").bitwiseXOR(F.col("dir")).alias("dir"))
    parts = parity_components(edges)
    return parts.select("cid", F.when(F.col("node") < 0, "ref").otherwise("read").alias("kind"), F.when(F.col("node") < 0, -F.col("node") - 1).otherwise(F.col("node")).alias("id"), (F.col("dir") == 1).alias("is_rc"))


def cluster_stats(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """members(cid, kind, id) and sizes(kind, id, patsize) -> (cid, minpat, maxpat, repeatcount, refcount, spread)."""
    g = members.join(sizes, ["kind", "id"]).groupBy("cid")
    out = g.agg(F.min("patsize").alias("minpat"), F.max("patsize").alias("maxpat"), F.count("*").alias("repeatcount"), F.count_if(F.col("kind") == "ref").alias("refcount"))
    return out.withColumn("spread", ((F.col("maxpat") / F.col("minpat") - 1) * 100 + 0.5).cast("int"))


def largest_clusters(stats: DataFrame) -> DataFrame:
    """One row: clusters, and the largest count of repeats, references and spread."""
    return stats.agg(F.count("*").alias("clusters"), *[F.max(c).alias(f"largest_{c}") for c in ("repeatcount", "refcount", "spread")])


def single_ref_clusters(members: DataFrame, mapped: DataFrame) -> DataFrame:
    """(cid, ref_id, is_mapped) of clusters with one reference; mapped(ref_id) are the references with reads."""
    one = members.where("kind = 'ref'").groupBy("cid").agg(F.count("*").alias("n"), F.max("id").alias("ref_id")).where("n = 1")
    seen = mapped.select("ref_id").distinct().withColumn("_seen", F.lit(True))
    return one.join(seen, "ref_id", "left").select("cid", "ref_id", F.coalesce("_seen", F.lit(False)).alias("is_mapped"))


def indistinguishable(filtered: DataFrame, full: DataFrame, full_groups: DataFrame, flanks: tuple[int, ...] = (10, 20, 50), cutoff: float = 0.88) -> DataFrame:
    """(rid, n_lengths): repeats of filtered that pass as another repeat of full, and at how many flank lengths.

    filtered(rid) is a part of full(rid, pattern, profile, profile_rc, left_flank, right_flank); full_groups are full's redundancy groups. Members of a group with equal
    flanks and directions are one class, and only classes are held against each other, so copies cost nothing. Alignment is done once; each length repeats the flank check only.
    """
    kinds = ["group_id", "is_rc", *FLANK_COLUMNS]
    member = full_groups.select("group_id", "rid", "is_rc").join(full.select("rid", *[F.coalesce(c, F.lit("")).alias(c) for c in FLANK_COLUMNS]), "rid")
    classes = store(member.groupBy(*kinds).agg(F.min("rid").alias("cls"), (F.min("rid") < F.max("rid")).alias("several")))
    groups = classes.select("group_id", F.col("cls").alias("rid"), "is_rc", (F.col("cls") == F.col("group_id")).alias("is_head"))
    heads = store(full.join(full_groups.where("is_head").select("rid"), "rid", "left_semi").select("rid", "pattern", *PROFILE_COLUMNS))
    a, b = heads.withColumnRenamed("rid", "ref_id"), heads.withColumnRenamed("rid", "read_id")
    pairs = fan_out(similar_pairs(seed_candidates(a, b), a, b, cutoff), groups, groups).join(classes.select(F.col("cls").alias("ref_id"), "several"), "ref_id").where("ref_id <> read_id or several")
    own = lambda name: classes.withColumnRenamed("cls", name)
    pairs = pairs.join(_named(own("ref_id"), "ref_id", "ref", FLANK_COLUMNS), "ref_id").join(_named(own("read_id"), "read_id", "read", FLANK_COLUMNS), "read_id")
    cut = pairs.withColumn("flank", F.explode(F.array(*[F.lit(n) for n in flanks])))
    cut = cut.withColumns({c: F.expr(f"right({c}, flank)") for c in ("ref_left_flank", "read_left_flank")} | {c: F.expr(f"left({c}, flank)") for c in ("ref_right_flank", "read_right_flank")})
    checked = flank_errors(cut, max(flanks)).where((F.col("lerr") <= error_limit(F.col("left_len"))) & (F.col("rerr") <= error_limit(F.col("right_len"))))
    found = checked.select(F.col("ref_id").alias("cls"), "flank").distinct().groupBy("cls").agg(F.count("*").alias("n_lengths"))
    rows = member.join(classes.join(found, "cls").select(*kinds, "n_lengths"), kinds).select("rid", "n_lengths")
    return rows.join(filtered.select("rid"), "rid", "left_semi")


def id_blocks(rows: DataFrame, keys: list[str], block: int = 256) -> DataFrame:
    """rows(id, *keys) -> (*keys, ids, lo, hi): ids of rows with equal keys, sorted, in arrays of `block` at most. Null ids are left out."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    numbered = rows.where("id is not null").withColumn("_block", ((nth - 1) / block).cast("long"))
    return numbered.groupBy(*keys, "_block").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("lo"), F.max("id").alias("hi")).drop("_block")


def size_pairs(rows: DataFrame, reach: Column, near: Column, made: dict[str, Column] | None = None, block: int = 256) -> DataFrame:
    """rows(id, cid, n, ...) -> (a, b, *made): pairs a < b of a cluster that are `near`, whose sizes are within `reach` (a column of n) of a's.

    Rows equal in all but id are one class: conditions and made columns, over a_n, b_n, a_... and b_..., are computed for pairs of blocks of classes and only then
    repeated for their members. Sizes are part of the key by bands of eight; pairs of blocks, each of like cost, are dealt evenly.
    """
    spark = rows.sparkSession
    keys = [c for c in rows.columns if c != "id"]
    rest = [c for c in keys if c != "cid"]
    blocks = id_blocks(rows, keys, block)
    of = lambda side: [F.col(c).alias(f"{side}_{c}") for c in [*rest, "ids", "lo", "hi"]]
    band = lambda n: F.floor(n / 8)
    left = blocks.select("cid", *of("a"), F.explode(F.sequence(band(F.col("n") - reach), band(F.col("n") + reach))).alias("band"))
    right = blocks.select("cid", *of("b"), band(F.col("n")).alias("band"))
    pairs = left.join(right, ["cid", "band"]).where(near & (F.col("a_lo") < F.col("b_hi")))
    dealt = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cid", "a_lo", "b_lo")
    known = dealt.select("a_ids", "b_ids", *[c.alias(name) for name, c in (made or {}).items()])
    each = known.withColumn("a", F.explode("a_ids")).drop("a_ids").withColumn("b", F.explode("b_ids"))
    return each.where("a < b").select("a", "b", *(made or {}))


def reference_pairs(refs: DataFrame, slack: float = 0.10) -> DataFrame:
    """refs(ref_id, cid, pattern, left_flank, right_flank) -> (a, b, ll, rr, lr, rl): pairs a < b of a cluster whose patterns' sizes are within slack of a's, with four
    distances: left to left and right to right flank, then each to the complement of the other side's, as the pair turned would show.
    """
    comp = lambda c: F.reverse(F.translate(c, "ACGT", "TGCA"))
    rows = refs.select(F.col("ref_id").alias("id"), "cid", F.length("pattern").alias("n"), F.col("left_flank").alias("l"), F.col("right_flank").alias("r"))
    sides = {"ll": ("a_l", "b_l"), "rr": ("a_r", "b_r"), "lr": ("a_l", comp("b_r")), "rl": ("a_r", comp("b_l"))}
    return size_pairs(rows, F.floor(F.col("n") * slack), F.abs(F.col("a_n") - F.col("b_n")) <= F.col("a_n") * slack, {k: F.levenshtein(x, y).cast("long") for k, (x, y) in sides.items()})


def flank_classes(pairs: DataFrame) -> DataFrame:
    """pairs(a, b, lerr, rerr, left_len, right_len) between references of a cluster -> (ref_id, n_left, n_right, n_both, distinguishable): whose flanks are alike on which side."""
    hit = lambda e, n: F.col(e) <= error_limit(F.col(n))
    both = pairs.select(F.explode(F.array("a", "b")).alias("ref_id"), hit("lerr", "left_len").alias("l"), hit("rerr", "right_len").alias("r"))
    g = both.groupBy("ref_id").agg(F.count_if(F.col("l") & ~F.col("r")).alias("n_left"), F.count_if(~F.col("l") & F.col("r")).alias("n_right"), F.count_if(F.col("l") & F.col("r")).alias("n_both"))
    return g.withColumn("distinguishable", F.col("n_both") == 0)
