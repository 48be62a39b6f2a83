"""Mixing sources to target weights by cube-method balanced sampling.

A document of a source is taken floor(m) times, with m = target / source size, and once more with probability
m - floor(m). The cube method decides these last copies so that the count of documents and their tokens stay balanced: the
flight moves three open probabilities at a time through the null space of both constraints until one is 0
or 1. Flights run in cells of a few hundred documents; what stays open (two a cell at most) flies again
together, level by level, until one cell a source is left, and only its last two or so documents are landed, by
the choice nearest to the target. Cells are hash ranges of ids within a source, and of the copy's number where rows are equal in id, source and
size, so a source or a group of copies with a third of all rows is dealt over many tasks, and reruns agree.
"""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm.common import BLANKS, count_words, set_aside, store

#: Documents a cell, about.
CELL = 512


def targets(totals: list[tuple[str | None, int]], most: int = 3) -> dict[str | None, float]:
    """Target of each source: weights 1, 2, 3 repeating by code point (null last) share all sizes; a target stops at most times its size, the excess is shared anew."""
    order = sorted(totals, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be", "surrogatepass")))
    weight = {s: 1 + i % 3 for i, (s, _) in enumerate(order)}
    out, open_, left = {}, dict(order), float(sum(n for _, n in order))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s, n in open_.items() if left * weight[s] / total > most * n]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = float(most * open_.pop(s))
        left = sum(n for _, n in order) - math.fsum(out.values())
    return out


def flight(p: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Moves p along the null space of (1, size) until two entries at most are neither 0 nor 1."""
    p, eps = list(p), 1e-9
    work: list[int] = []
    rest = iter([i for i, x in enumerate(p) if eps < x < 1 - eps])
    while True:
        work = [i for i in work if eps < p[i] < 1 - eps]
        while len(work) < 3 and (i := next(rest, None)) is not None:
            work.append(i)
        if len(work) < 3:
            return [round(x) if not eps < x < 1 - eps else x for x in p]
        a, b, c = (size[i] for i in work)
        u = (c - b, a - c, b - a)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(work, u) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(work, u) if d)
        step = up if rng.random() * (up + down) < down else -down
        for i, d in zip(work, u):
            p[i] = min(1.0, max(0.0, p[i] + step * d))


def landing(p: list[float], size: list[float]) -> list[float]:
    """Settles the open entries: of all choices the one whose tokens, then documents, stay nearest to the expectation."""
    open_ = [i for i, x in enumerate(p) if 0 < x < 1]
    want, count = sum(p[i] * size[i] for i in open_), sum(p[i] for i in open_)
    best = min(range(1 << len(open_)), key=lambda m: (abs(want - sum(size[i] for k, i in enumerate(open_) if m >> k & 1)), abs(count - m.bit_count())))
    out = list(p)
    for k, i in enumerate(open_):
        out[i] = float(best >> k & 1)
    return out


def flier(seed: int, level: int):
    """Flies one cell, and lands it where it is its source's only one."""

    def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "copy"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        p = flight(pdf.p.tolist(), pdf["size"].tolist(), random.Random(f"{seed}/{level}/{key[0]}/{key[1]}"))
        if pdf.cells[0] == 1:
            p = landing(p, pdf["size"].tolist())
        return pdf.assign(p=p)

    return fly


def mix_sources(documents: DataFrame, seed: int = 17, most: int = 3, cell: int = CELL, keep_columns: bool = True) -> DataFrame:
    """documents with size, source_size, target and taken added; extra columns stay (columns of these four names are replaced) unless keep_columns is False.

    Sizes are words; null texts have 0, and an empty source takes nothing; rows with a null source are a source. Repeated rows count one by one; null
    ids are ids like others. An empty table stays empty. The sources' totals go to the driver, one row a source, and come back as a
    small table that is broadcast only while the session's threshold allows it. cell is 8 or more, so that every level leaves fewer documents open.
    """
    if cell < 8:
        raise ValueError("cell must be 8 or more")
    ship(documents.sparkSession)
    plain, back = set_aside(documents, ("doc_id", "source", "text"), ("size", "source_size", "target", "taken"))
    size = count_words(F.coalesce("text", F.lit("")), BLANKS)
    sized = plain.withColumn("size", size)
    decided = decide(store(sized.select("doc_id", "source", "size")), seed, most, cell)
    if not keep_columns:
        return decided
    # Equal rows (in id, source and size) are taken alike but for one copy more or less, so three numbers tell all their
    # shares; only where copies differ the row's number among its equals picks one.
    key = F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("\x02")), F.coalesce("source", F.lit("\x02")), F.col("size").cast("string")).alias("_key")
    share = decided.select(key, "source_size", "target", "taken").groupBy("_key").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.min("taken").alias("_low"), F.max("taken").alias("_high"), F.sum("taken").alias("_sum"), F.count("*").alias("_n")
    )
    left = sized.withColumn("_key", key).join(share, "_key")
    columns = [*sized.columns, "source_size", "target"]
    alike = left.where("_low = _high").select(*columns, F.col("_low").alias("taken"))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("text")))
    high = F.round((F.col("_sum") - F.col("_n") * F.col("_low")) / (F.col("_high") - F.col("_low")))
    mixed = left.where("_low < _high").withColumn("_nth", nth).select(*columns, F.when(F.col("_nth") <= high, F.col("_high")).otherwise(F.col("_low")).alias("taken"))
    return back(alike.union(mixed))


def decide(sized: DataFrame, seed: int, most: int, cell: int) -> DataFrame:
    """sized(doc_id, source, size) with source_size, target and taken."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect()
    goal = targets([(r.source, r.n) for r in totals], most)
    plan = sized.sparkSession.createDataFrame([(r.source, r.n, goal[r.source], max(1, math.ceil(r.docs / cell))) for r in totals], "name string, source_size long, target double, cells int")
    m = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # equal rows are counted, then told apart by a number, so they spread over cells whatever their order
    equal = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    rows = equal.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n").join(plan, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = rows.withColumns({"whole": F.floor(m).cast("int"), "p": m - F.floor(m), "cell": F.pmod(F.xxhash64("doc_id", "size", "copy"), F.col("cells")).cast("int")})
    done = None
    level = 0
    while True:
        out = store(rows.groupBy("source", "cell").applyInPandas(flier(seed, level), rows.schema))
        done = out if done is None else done.union(out)
        if out.where("p > 0 and p < 1").isEmpty():
            break
        fewer = F.ceil(F.col("cells") * 3 / cell).cast("int")
        rows = out.where("p > 0 and p < 1").withColumn("cells", fewer).withColumn("cell", F.pmod("cell", "cells").cast("int"))
        level += 1
    taken = ((F.col("whole") + F.col("p").cast("int")) * F.col("size")).alias("taken")
    return done.where("p = 0 or p = 1").select("doc_id", "source", "size", "source_size", "target", taken)
