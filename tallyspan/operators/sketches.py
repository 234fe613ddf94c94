"""Bottom-k sketches: the k least hashes of a set, a bounded sample that merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes are the first 13 hexadecimal digits of an MD5: 52 bits, whole in a double.
SPAN = float(1 << 52)


def hashed(item: Column, seed: str) -> Column:
    """A uniform hash of an item below 2^52, the same wherever it is computed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), item.cast("string"))), 1, 13), 16, 10).cast("long")


def bottom_k(rows: DataFrame, sets: list[str], item: str, k: int, seed: str = "0", salts: int = 32) -> DataFrame:
    """``(sets, rank, hash, item)``: of each set the k different items with the least hashes.

    Which items these are doesn't depend on order or partitioning. A set's
    items meet in ``salts`` parts first, of which each keeps k, so no task
    holds a large set. Null items are none.
    """
    each = rows.filter(F.col(item).isNotNull()).select(*sets, F.col(item).alias("item")).distinct().withColumn("hash", hashed(F.col("item"), seed))
    order = [F.col("hash"), F.col("item")]
    some = each.withColumn("__salt", F.pmod("hash", F.lit(salts)))
    part = some.withColumn("__r", F.row_number().over(Window.partitionBy(*sets, "__salt").orderBy(*order))).filter(F.col("__r") <= k)
    least = part.withColumn("rank", F.row_number().over(Window.partitionBy(*sets).orderBy(*order))).filter(F.col("rank") <= k)
    return least.select(*sets, "rank", "hash", "item")


def merged(sketches: DataFrame, sets: list[str], k: int) -> DataFrame:
    """The sketch of the union of sketches: ``sets`` name the sets to come."""
    each = sketches.select(*sets, "hash", "item").distinct()
    return each.withColumn("rank", F.row_number().over(Window.partitionBy(*sets).orderBy("hash", "item"))).filter(F.col("rank") <= k).select(*sets, "rank", "hash", "item")


def sizes(sketches: DataFrame, sets: list[str], k: int) -> DataFrame:
    """``(sets, n_items, is_exact)``: the number of different items, exact below k, else from the k-th least hash (error about 1 / sqrt(k))."""
    g = sketches.groupBy(*sets).agg(F.count(F.lit(1)).alias("__n"), F.max("hash").alias("__h"))
    return g.select(*sets, F.when(F.col("__n") < k, F.col("__n").cast("double")).otherwise((k - 1) * SPAN / (F.col("__h") + 1)).alias("n_items"), (F.col("__n") < k).alias("is_exact"))


def overlaps(sketches: DataFrame, of: str, k: int) -> DataFrame:
    """``(a, b, jaccard)`` of all pairs of sets that share an item of their sketches: the share of common items among the k least of both."""
    s = sketches.select(F.col(of).alias("s"), "hash", "item")
    pairs = s.select(F.col("s").alias("a"), "hash", "item").join(s.select(F.col("s").alias("b"), "hash", "item"), ["hash", "item"]).filter("a < b").select("a", "b").distinct()
    own = pairs.join(s, F.col("s") == F.col("a")).select("a", "b", "hash", "item").unionByName(pairs.join(s, F.col("s") == F.col("b")).select("a", "b", "hash", "item"))
    each = own.groupBy("a", "b", "hash", "item").agg(F.count(F.lit(1)).alias("n"))
    least = each.withColumn("rank", F.row_number().over(Window.partitionBy("a", "b").orderBy("hash", "item"))).filter(F.col("rank") <= k)
    return least.groupBy("a", "b").agg((F.count_if(F.col("n") == 2) / F.count(F.lit(1))).alias("jaccard"))
