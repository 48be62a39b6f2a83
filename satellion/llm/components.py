"""Connected components by minimum labels with pointer jumping; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satellion.llm.common import discard, store


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (id, comp): comp is the smallest id reachable, for every id that has a link.

    Each round takes the smallest label among a node's neighbours and then that label's own label, so labels
    travel doubling distances. Null ends and loops are left out. Nothing goes to the driver but whether a label changed; tables of past
    rounds are deleted.
    """
    both = links.select("a", "b").where("a is not null and b is not null and a <> b")
    edges = store(both.union(both.select("b", "a")).distinct())
    labels = store(edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp")))
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        moved = labels.join(near, "id").select("id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = moved.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        nxt = store(moved.join(jump, "comp").select("id", "was", F.col("far").alias("comp")))
        discard(labels)
        if nxt.where("was <> comp").isEmpty():
            discard(edges)
            return nxt.select("id", "comp")
        labels = nxt
