"""Comparing two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(keys, change, old_*, new_*)`` of added, removed and changed rows; nulls compare as equal values."""
    a = old.select(*keys, F.lit(1).alias("__a"), *[F.col(c).alias(f"old_{c}") for c in columns])
    b = new.select(*keys, F.lit(1).alias("__b"), *[F.col(c).alias(f"new_{c}") for c in columns])
    both = a.join(b, keys, "full_outer")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(~same, "changed")
    return both.withColumn("change", change).filter("change is not null").drop("__a", "__b")


def digest(rows: DataFrame) -> DataFrame:
    """``(n, digest)`` of a table whatever its row order or partitioning: the sum of row hashes, repeats included."""
    h = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.sum(F.conv(F.substring(h, i, 12), 16, 10).cast("decimal(38,0)"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.concat_ws("-", part(1).cast("string"), part(13).cast("string"), part(25).cast("string")).alias("digest"))


def order_independent(queries: dict) -> DataFrame:
    """``(query, same, n)``: whether each query gives the same rows for its input as it lies, dealt by a key, and in one reversed order.

    ``queries`` maps a name to (function of a DataFrame, its input, a column to deal by).
    Both dealings have as many partitions as any shuffle, so that tasks don't grow with the input.
    """
    out = None
    for name, (run, rows, key) in queries.items():
        seen = [digest(run(x)).withColumn("way", F.lit(i)) for i, x in enumerate((rows, rows.repartition(key), rows.repartitionByRange(F.desc(key))))]
        all_ways = seen[0].unionByName(seen[1]).unionByName(seen[2])
        one = all_ways.agg(F.lit(name).alias("query"), (F.count_distinct("n", "digest") == 1).alias("same"), F.min("n").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def equal_tables(a: DataFrame, b: DataFrame) -> bool:
    """Whether both hold the same rows the same number of times."""
    return a.columns == b.columns and digest(a).first() == digest(b).first()


def group_fingerprint(rows: DataFrame, group: str, ident: Column) -> DataFrame:
    """One hash for a partition of ids into groups, independent of group names and order: the sum of the groups' hashes.

    Ids of one group are the unit a fingerprint needs together.
    """
    each = rows.groupBy(group).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(ident)), ","), 256).alias("h"))
    return each.agg(F.count(F.lit(1)).alias("n_groups"), F.sum(F.conv(F.substring("h", 1, 14), 16, 10).cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def largest_changes(old: DataFrame, new: DataFrame, key: str, value: str, limit: int) -> DataFrame:
    """The largest absolute changes of a keyed number, with how many more changed."""
    both = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key, "full_outer")
    moved = both.withColumn("delta", F.coalesce("new", F.lit(0)) - F.coalesce("old", F.lit(0))).filter(~F.col("old").eqNullSafe(F.col("new")))
    n = moved.agg(F.count(F.lit(1)).alias("n"))
    top = moved.orderBy(F.abs("delta").desc(), key).limit(limit)
    return top.crossJoin(F.broadcast(n)).withColumn("n_more", F.greatest(F.col("n") - limit, F.lit(0))).drop("n")


def missing_and_stale(expected: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Keys expected but not stored, and stored but no longer expected."""
    a = expected.select(key).distinct().join(stored.select(key), key, "left_anti").withColumn("state", F.lit("missing"))
    b = stored.select(key).distinct().join(expected.select(key), key, "left_anti").withColumn("state", F.lit("stale"))
    return a.unionByName(b)


def compare_counts(old: DataFrame, new: DataFrame, measures: dict[str, str]) -> DataFrame:
    """``(measure, old_n, new_n, delta)``: all rows, and the rows of each value of each named column, in both versions."""

    def counted(rows: DataFrame, alias: str) -> DataFrame:
        names = F.array(F.lit("rows"), *[F.concat(F.lit(f"{k}:"), F.coalesce(F.col(c).cast("string"), F.lit("?"))) for k, c in measures.items()])
        return rows.select(F.explode(names).alias("measure")).groupBy("measure").agg(F.count(F.lit(1)).alias(alias))

    both = counted(old, "old_n").join(counted(new, "new_n"), "measure", "full_outer")
    return both.withColumn("delta", F.coalesce("new_n", F.lit(0)) - F.coalesce("old_n", F.lit(0)))


def comparison_rollup(rows: DataFrame, by: str, left: str, right: str) -> DataFrame:
    """Both-sided, one-sided and differing keys of each ``by``; fails where nothing stands on both sides, as that compares nothing."""
    a, b = F.col(left), F.col(right)
    g = rows.groupBy(by).agg(
        F.count_if(a.isNotNull() & b.isNotNull()).alias("both_sides"), F.count_if(b.isNull()).alias("only_left"), F.count_if(a.isNull()).alias("only_right"), F.count_if(a != b).alias("differing")
    )
    nothing = F.raise_error(F.format_string("nothing to compare in %s", F.col(by).cast("string"))).cast("bigint")
    return g.withColumn("both_sides", F.when(F.col("both_sides") > 0, F.col("both_sides")).otherwise(nothing))
