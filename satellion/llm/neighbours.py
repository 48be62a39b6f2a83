"""Approximate nearest neighbours: stable random projections in a kd-tree, with an early stop by a chi-square test.

Unit vectors are projected to a few Gaussian dimensions. The squared projected distance of a pair over its squared
distance follows a chi-square law with that many degrees of freedom. A query meets the kd-tree's leaves in order of projected distance and verifies
their points exactly, until the law says that whatever is left, at the projected distance reached, is nearer than the k-th best with
probability below 1 - certainty.

The tree's top is fitted on a bounded sample of projections; every point is dealt to its cell, and a cell of many points to
several blocks, each with the rest of a tree of its own. Queries travel, points stay: first a query searches one block of its own cell, which bounds its
k-th best, then all blocks of those cells that the test can't rule out at that bound (all other cells, if its own held too few points). Neither side is
broadcast, only the top's boxes are, whose number is bounded. Equal vectors share one point, which stands for its k + 1 smallest ids: that
is all ties can need, so copies cost nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm.common import store


def chi2_cdf(x: float, m: int) -> float:
    """Chi-square distribution function for an even number m of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(m // 2):
        total += term
        term *= half / (k + 1)
    return 1 - math.exp(-half) * total


def chi2_quantile(p: float, m: int) -> float:
    """By bisection."""
    low, high = 0.0, 1.0
    while chi2_cdf(high, m) < p:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, m) < p else (low, mid)
    return high


def projection(dims: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).normal(size=(dims, m))


class KdTree:
    """Median splits along the widest axis; leaves hold up to `leaf` points, boxes are tight."""

    def __init__(self, points: np.ndarray, leaf: int = 512):
        self.places: list[np.ndarray] = []
        self._build(points, np.arange(len(points)), leaf)
        self.low, self.high = (np.array([f(points[at], axis=0) for at in self.places]) for f in (np.min, np.max))

    def _build(self, points: np.ndarray, at: np.ndarray, leaf: int) -> None:
        p = points[at]
        spread = p.max(0) - p.min(0)
        axis = int(np.argmax(spread))
        if len(at) <= leaf or spread[axis] == 0:
            self.places.append(at)
            return
        order = np.argpartition(p[:, axis], len(at) // 2)
        self._build(points, at[order[: len(at) // 2]], leaf)
        self._build(points, at[order[len(at) // 2 :]], leaf)

    def leaves(self, q: np.ndarray):
        """(squared distance, points) of the leaves in order of their distance from q."""
        d = (np.maximum(np.maximum(self.low - q, q - self.high), 0) ** 2).sum(1)
        for k in np.argsort(d, kind="stable").tolist():
            yield float(d[k]), self.places[k]


def search(tree: KdTree, points: np.ndarray, q: np.ndarray, z: np.ndarray, k: int, stop: float, best: float) -> np.ndarray:
    """Places of the points that may be among q's k nearest of these points; best is the k-th best cosine known so far. Rows are unit vectors, z is q projected."""
    found, cos = [], np.zeros(0)
    for d, at in tree.leaves(z):
        if len(cos) >= k:
            best = max(best, np.partition(cos, len(cos) - k)[len(cos) - k])
        if d > stop * max(2 - 2 * best, 1e-12):
            break
        found.append(at)
        cos = np.concatenate((cos, points[at] @ q))
    if not found:
        return np.zeros(0, np.int64)
    # ties with the k-th stay, and rounding gets room
    at, least = np.concatenate(found), max(best, np.partition(cos, len(cos) - k)[len(cos) - k] if len(cos) > k else -2)
    return at[cos >= least - 1e-9]


class Cells:
    """The tree's top: median splits of a sample down to cells of `size` sampled points, at most `most` of them."""

    def __init__(self, sample: np.ndarray, size: int, most: int):
        self.splits: list[tuple[int, float, int, int]] = []  # axis, value, below, above; cells are negative
        self.count = 0
        self._build(sample, size, max(1, most))

    def _build(self, p: np.ndarray, size: int, most: int) -> int:
        spread = p.max(0) - p.min(0) if len(p) else np.zeros(1)
        axis = int(np.argmax(spread))
        if len(p) <= size or most < 2 or spread[axis] == 0:
            self.count += 1
            return -self.count
        value, k = float(np.median(p[:, axis])), len(self.splits)
        under = p[:, axis] < value
        if not under.any():
            value = float(p[p[:, axis] > value, axis].min())
            under = p[:, axis] < value
        self.splits.append((axis, value, 0, 0))
        a, b = self._build(p[under], size, most // 2), self._build(p[~under], size, most - most // 2)
        self.splits[k] = (axis, value, a, b)
        return k

    def cell(self, z: np.ndarray) -> np.ndarray:
        """Each row's cell."""
        out = np.zeros(len(z), dtype=np.int64)
        todo = [(0 if self.splits else -1, np.arange(len(z)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                out[at] = -node - 1
            else:
                axis, value, a, b = self.splits[node]
                under = z[at, axis] < value
                todo += [(a, at[under]), (b, at[~under])]
        return out


def unit(x: np.ndarray) -> np.ndarray:
    y = x / np.abs(x).max(1, keepdims=True)
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def usable(v: str) -> Column:
    """Vectors that are not null or empty, without null or non-finite components, and not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(v).isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, m: int = 8, certainty: float = 0.8, seed: int = 11, block: int = 8192, sample_rows: int = 16384, cells: int = 512, query_block: int = 1 << 15) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows, by cosine, of each row whose vec_id is divisible by every.

    Unusable vectors (see usable) and null ids take no part. Vectors of different lengths are not compared. A vec_id that
    is repeated stands for each of its vectors; rows equal in id and vector count once. A query's own id is left out. An empty
    table has no rows to return; other columns are not read.

    The top of the tree is fitted on sample_rows rows, chosen by hash, and has `cells` cells a length of vectors at most; blocks hold about `block` points,
    and a block that more than query_block queries visit is met by as many tasks. All rows are indexed.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null").where(usable("v")).withColumn("v", F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x))).distinct()
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    listed = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    tops = fit_cells(rows, m, seed, block, sample_rows, cells)
    if not tops:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(tops)

    def dealt(df: DataFrame, extra: str) -> DataFrame:
        """df with the cell of each vector and its place in the projection."""

        def run(parts):
            for pdf in parts:
                dims = pdf.v.map(len).to_numpy()
                cell, z = np.zeros(len(pdf), dtype=np.int64), [None] * len(pdf)
                for n in np.unique(dims):
                    at = np.flatnonzero(dims == n)
                    low = unit(np.array(pdf.v.iloc[at].tolist(), dtype=np.float64)) @ projection(n, m, seed)
                    cell[at] = shared.value[n].cell(low) if n in shared.value else 0
                    for i, x in zip(at, low):
                        z[i] = x
                yield pdf.assign(dims=dims, cell=cell, z=z)

        return df.mapInPandas(run, f"v array<double>, {extra}dims int, cell int, z array<double>")

    points = store(dealt(listed, "ids array<long>, "))
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = store(dealt(asked.select("v").distinct(), ""))
    boxes = points.groupBy("dims", "cell").agg(
        F.count("*").alias("n"), *[f(F.col("z")[i]).alias(f"{name}{i}") for i in range(m) for name, f in (("low", F.min), ("high", F.max))]
    ).select("dims", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.array(*[f"low{i}" for i in range(m)]).alias("low"), F.array(*[f"high{i}" for i in range(m)]).alias("high"))
    boxes = store(boxes)  # a row a cell: bounded
    stop = chi2_quantile(certainty, m)
    keep = points.join(F.broadcast(boxes.select("dims", "cell", "blocks")), ["dims", "cell"]).select("dims", "cell", F.pmod(F.xxhash64("v", F.lit(2)), F.col("blocks")).cast("int").alias("b"), "v", "ids", "z")
    own = queries.join(F.broadcast(boxes.select("dims", "cell", "blocks")), ["dims", "cell"]).select("dims", "cell", F.pmod(F.xxhash64("v", F.lit(3)), F.col("blocks")).cast("int").alias("b"), "v", "z", F.lit(-1.0).alias("best"))
    first = store(visit(keep, own, k + 1, stop, query_block))
    best = first.groupBy("v").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("score"), asc=False).alias("top")).select("v", F.when(F.col("n") > k, F.get("top", F.lit(k))).otherwise(-1.0).alias("best"))
    gap = F.aggregate(F.zip_with("z", F.zip_with("low", "high", lambda x, y: F.struct(x.alias("low"), y.alias("high"))), lambda z, x: F.greatest(x["low"] - z, z - x["high"], F.lit(0.0))), F.lit(0.0), lambda a, x: a + x * x)
    home = F.pmod(F.xxhash64("v", F.lit(3)), F.col("blocks")).cast("int")
    others = (
        queries.withColumnRenamed("cell", "own").join(best, "v", "left").withColumn("best", F.coalesce("best", F.lit(-1.0))).join(F.broadcast(boxes), "dims")
        .where(gap <= stop * F.greatest(2 - 2 * F.col("best"), F.lit(1e-12)))
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where((F.col("cell") != F.col("own")) | (F.col("b") != home))
        .select("dims", "cell", "b", "v", "z", "best")
    )
    found = first.union(visit(keep, others, k + 1, stop, query_block))
    near = found.select("v", F.col("ids"), "score").withColumn("vec_id", F.explode("ids")).groupBy("v", "vec_id").agg(F.max("score").alias("score"))
    nearest_of = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("score"), "vec_id"))
    # all askers of one vector have the same candidates, but for their own ids
    near = near.withColumn("nth", nearest_of).where(F.col("nth") <= k + 1).drop("nth")
    answers = asked.withColumnRenamed("vec_id", "query_id").join(near, "v").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fit_cells(rows: DataFrame, m: int, seed: int, block: int, sample_rows: int, cells: int) -> dict[int, Cells]:
    """The tree's top of each length of vectors, fitted on a sample of distinct vectors; a cell is for about half a block of points."""
    sized = rows.select("v").distinct().select(F.size("v").alias("dims"), "v")
    counts = {r.dims: r.n for r in sized.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    chosen = sized.orderBy(F.xxhash64("v", F.lit(1)), "v").limit(sample_rows)

    def project(parts):
        for pdf in parts:
            for n, part in pdf.groupby("dims"):
                low = unit(np.array(part.v.tolist(), dtype=np.float64)) @ projection(int(n), m, seed)
                yield pd.DataFrame({"dims": part.dims, "z": list(low)})

    sample = chosen.mapInPandas(project, "dims int, z array<double>").toPandas()
    out = {}
    for n, total in counts.items():
        z = np.array(sample.z[sample.dims == n].tolist(), dtype=np.float64).reshape(-1, m)
        out[n] = Cells(z, max(1, len(z) * block // (2 * total)), min(cells, max(1, len(z) // 8)))
    return out


def visit(points: DataFrame, queries: DataFrame, k: int, stop: float, query_block: int) -> DataFrame:
    """(v, ids, score) of points that may be among the k nearest of each query vector v in the blocks it visits. Queries stream past a block's points; a block that many visit is met by several tasks."""
    spots = ["dims", "cell", "b"]
    busy = queries.groupBy(*spots).agg(F.ceil(F.count("*") / query_block).cast("int").alias("salts"))
    left = points.join(busy, spots).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    right = queries.join(busy, spots).withColumn("salt", F.pmod(F.xxhash64("v", F.lit(5)), F.col("salts")).cast("int"))
    keys = [*spots, "salt"]
    both = left.select(*keys, F.lit(0).alias("role"), "v", "ids", "z", F.lit(None).cast("double").alias("best")).union(
        right.select(*keys, F.lit(1).alias("role"), "v", F.lit(None).cast("array<long>").alias("ids"), "z", "best"))

    def run(parts):
        now, held, ready = None, [], None
        for pdf in parts:
            out = []
            for key, part in pdf.groupby(keys, sort=False):
                if key != now:
                    now, held, ready = key, [], None
                own = part.role.to_numpy() == 0
                if own.any():
                    held.append(part[own])
                asks = part[~own]
                if not len(asks) or not held:
                    continue
                if ready is None:
                    block = pd.concat(held)
                    raw = np.array(block.v.tolist(), dtype=np.float64)
                    ready = raw, unit(raw), block.ids.tolist(), KdTree(np.array(block.z.tolist(), dtype=np.float64))
                raw, points, ids, tree = ready
                qs = np.array(asks.v.tolist(), dtype=np.float64)
                for q, u, z, best in zip(qs, unit(qs), asks.z, asks.best):
                    at = search(tree, points, u, np.asarray(z), k, stop, best)
                    if len(at):
                        out += [(q, ids[j], float(x)) for j, x in zip(at, cosine(q, raw[at]))]
            yield pd.DataFrame(out, columns=["v", "ids", "score"])

    return both.repartition(*keys).sortWithinPartitions(*keys, "role").mapInPandas(run, "v array<double>, ids array<long>, score double")


def cosine(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    """In double precision, summed in one order for every row."""
    scale, big = np.abs(q).max(), np.abs(points).max(1)
    q, points = q / scale, points / big[:, None]
    return (points * q).sum(1) / (np.sqrt((points * points).sum(1)) * np.sqrt((q * q).sum()))
