"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.session import materialize


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _star(rows: DataFrame, keep: Column) -> DataFrame:
    """Connect the kept neighbours of every node with the smallest node around it.

    The minima are written first: a join of two plain shuffles is one whose hot
    keys Spark can split. Node tables grow with the input and are never broadcast.
    """
    low = materialize(rows.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "cc-low")
    joined = rows.filter(keep).join(low.hint("merge"), "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list.

    The component is the smallest node that can be reached. Large-star and
    small-star rounds alternate until the edge set stands still; each round is
    two min-aggregations (combined before the shuffle) and two equi-joins, so a
    hub with any number of neighbours is never gathered in one task. Rows with
    a null end, self loops and repeated edges are allowed; nodes that occur
    only in self loops or null rows are not returned.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u is not null and v is not null and u <> v")
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = _digest(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(_star(both, F.col("v") > F.col("u")).distinct(), "cc-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        moved = large.join(low.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(low.select("u", F.col("m").alias("v")))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        e = materialize(small.distinct(), "cc")
        now = _digest(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
