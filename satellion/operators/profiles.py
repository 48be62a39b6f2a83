"""Profiles of both strands of a repeat, their composition and their similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satellion.functions import kernels
from satellion.functions.scalars import clean_dna, reverse_complement
from satellion.functions.shipping import ship


def once_each(rows: DataFrame, keys: list[str], made: dict[str, Column]) -> DataFrame:
    """rows with the columns made of keys alone: each is made once for all rows with equal keys (nulls equal too), and different keys are dealt evenly."""
    spark = rows.sparkSession
    kinds = rows.select(*keys).distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = kinds.select(*keys, *[c.alias(n) for n, c in made.items()]).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(kinds, same).drop(*[f"_k_{k}" for k in keys])


def build_profiles(trs: DataFrame) -> DataFrame:
    """trs(..., sequence, pattern) with pattern, copynum, conserved, profile, profile_rc and base counts n_a..n_t.

    The reverse profile is built anew from the reversed array and pattern. Patterns of null or empty repeats stay, with empty profiles. Equal repeats are aligned once.
    """
    ship(trs.sparkSession)
    seq, pat = clean_dna("sequence"), clean_dna("pattern")
    rest = [c for c in trs.columns if c not in ("pattern", "copynum", "conserved", "profile", "profile_rc", "n_a", "n_c", "n_g", "n_t")]
    made = {"_f": kernels.profile_of(F.col("_s"), F.col("_p")), "_r": kernels.profile_of(reverse_complement("_s"), reverse_complement("_p"))}
    built = once_each(trs.select(*rest, seq.alias("_s"), pat.alias("_p")), ["_s", "_p"], made)
    upper = F.coalesce(F.upper("sequence"), F.lit(""))
    counts = [(F.length(upper) - F.length(F.replace(upper, F.lit(b), F.lit("")))).alias(f"n_{b.lower()}") for b in "ACGT"]
    return built.select(*rest, "_f.pattern", "_f.copynum", "_f.conserved", "_f.profile", F.col("_r.profile").alias("profile_rc"), *counts)


def solid_counts(profile: str | Column) -> Column:
    """A, C, G, T and dash counts of each column of a profile: a literal table of compositions is looked up by id."""
    table = F.lit([[int(x) for x in row] for row in kernels.compositions()])
    return F.transform(profile, lambda i: F.get(table, i.cast("int")))


def column_entropy(profile: str | Column) -> Column:
    """Mean entropy, in base 5, of the columns of a profile; 0 for an empty one."""
    part = lambda n: F.when(n > 0, -(n / 10.0) * F.ln(n / 10.0) / F.ln(F.lit(5.0))).otherwise(0.0)
    each = F.transform(solid_counts(profile), lambda row: F.aggregate(row, F.lit(0.0), lambda a, n: a + part(n)))
    return F.when(F.size(each) > 0, F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.size(each)).otherwise(0.0)


def edge_scores(pairs: DataFrame) -> DataFrame:
    """pairs(..., ref_profile, ref_profile_rc, read_profile, read_profile_rc) with is_rc and score.

    The score is the best of four orientations, to four places; the direction is that of the better one against the read's forward profile, forward on ties.
    Pairs with equal profiles are aligned once.
    """
    ship(pairs.sparkSession)
    both = {"_ff": ("ref_profile", "read_profile"), "_rf": ("ref_profile_rc", "read_profile"), "_fr": ("ref_profile", "read_profile_rc"), "_rr": ("ref_profile_rc", "read_profile_rc")}
    s = {k: kernels.similarity(a, b) for k, (a, b) in both.items()}
    out = once_each(pairs, ["ref_profile", "ref_profile_rc", "read_profile", "read_profile_rc"], s)
    return out.withColumns({"is_rc": F.col("_ff") < F.col("_rf"), "score": F.round(F.greatest(F.lit(0.0), *s), 4)}).drop(*s)


def mean_density(edges: DataFrame, cluster: str = "cid") -> DataFrame:
    """Mean score of each cluster's edges, to four places."""
    return edges.groupBy(cluster).agg(F.round(F.avg("score"), 4).alias("profdensity"))
