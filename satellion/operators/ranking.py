"""Best matches with ties, pruning, and evidence flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_with_ties(df: DataFrame, item: str, score: str, least: float | None = None) -> DataFrame:
    """Rows whose score is the best of their item and at least `least`, with ties = rows as good, less one."""
    rows = df if least is None else df.where(F.col(score) >= least)
    best = W.partitionBy(item)
    kept = rows.withColumn("_best", F.max(score).over(best)).where(F.col(score) == F.col("_best")).drop("_best")
    return kept.withColumn("ties", F.count("*").over(best) - 1)


def keep_best(df: DataFrame, item: str, score: str) -> DataFrame:
    """Rows of the best score of their item."""
    return df.withColumn("_best", F.max(score).over(W.partitionBy(item))).where(F.col(score) == F.col("_best")).drop("_best")


def one_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in an order that leaves no ties."""
    return df.withColumn("_nth", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where("_nth = 1").drop("_nth")


def flank_score(left_errors: Column, right_errors: Column, left_len: Column, right_len: Column) -> Column:
    """1 - errors per flank symbol; 0 where both flanks are empty."""
    size = left_len + right_len
    return F.when(size == 0, 0.0).otherwise(1 - (left_errors + right_errors) / F.nullif(size, F.lit(0)))


def mark_best(map_: DataFrame, rank: DataFrame, rankflank: DataFrame) -> DataFrame:
    """map with bbb: ranked best by profile and by flanks, and untied in one of both at least."""
    key = ["ref_id", "read_id"]
    both = rank.select(*key, F.col("ties").alias("t1")).join(rankflank.select(*key, F.col("ties").alias("t2")), key).where("t1 = 0 or t2 = 0").select(*key).withColumn("bbb", F.lit(1))
    return map_.drop("bbb").join(both, key, "left").withColumn("bbb", F.coalesce("bbb", F.lit(0)))


def flag_best(rows: DataFrame, item: str, first: tuple[str, float], second: tuple[str, float]) -> DataFrame:
    """rows with bbb: best of their item by two scores, each at least its limit, and untied in one of both at least.

    What rank_with_ties twice and mark_best give, in one pass over the item's rows and without a join, where both scores stand in one frame.
    """
    of_item = W.partitionBy(item)
    best = {f"_best{k}": F.max(F.when(F.col(score) >= least, F.col(score))).over(of_item) for k, (score, least) in enumerate((first, second))}
    hit = [F.coalesce(F.col(score) == F.col(f"_best{k}"), F.lit(False)) for k, (score, _) in enumerate((first, second))]
    alone = [F.sum(h.cast("int")).over(of_item) == 1 for h in hit]
    return rows.withColumns(best).withColumn("bbb", (hit[0] & hit[1] & (alone[0] | alone[1])).cast("int")).drop(*best)


def multi_mapped(rows: DataFrame) -> DataFrame:
    """Pairs that lose their flag. rows: best pairs (sid, ref_id, read_id, prof_score, flank_score, chrom, first_pos, last_pos, read_len).

    The two worst rows of a read with several lose it unless they lie on one chromosome within a read's length; later rows stay.
    """
    order = W.partitionBy("sid").orderBy("prof_score", "flank_score", "ref_id", "read_id")
    first = rows.select("*", F.row_number().over(order).alias("nth"), F.lead(F.struct("ref_id", "read_id", "chrom", "first_pos", "last_pos")).over(order).alias("nxt")).where("nth = 1 and nxt is not null")
    near = (F.col("chrom") == F.col("nxt.chrom")) & (F.greatest("last_pos", "nxt.last_pos") - F.least("first_pos", "nxt.first_pos") + 1 <= F.col("read_len"))
    return first.where(~near).select(F.explode(F.array(F.struct("ref_id", "read_id"), F.struct("nxt.ref_id", "nxt.read_id"))).alias("p")).select("p.ref_id", "p.read_id")


def drop_multi_mapped(map_: DataFrame, rows: DataFrame) -> DataFrame:
    """map with the flag taken from multi-mapped pairs."""
    return map_.join(multi_mapped(rows).withColumn("_lost", F.lit(0)), ["ref_id", "read_id"], "left").withColumn("bbb", F.coalesce("_lost", "bbb")).drop("_lost")
