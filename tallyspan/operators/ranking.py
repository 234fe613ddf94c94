"""Top-k with ties, latest rows, samples and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_with_ties(rows: DataFrame, value: str, order: list[Column], by: list[str] | None = None, k: int = 5, cap: int = 8) -> DataFrame:
    """The k first rows and all that tie with the k-th.

    If these are more than ``cap``, only the full ranks above the tie; if there
    is no full rank, plainly the first k. ``position`` numbers the rows.
    """
    by = by or []
    order = [F.col(value).desc(), *order]
    if not by:  # without a key, the first rows that can matter are taken before any window
        rows = rows.orderBy(*order).limit(cap + k)
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    few = rows.withColumn("__rank", F.rank().over(part.orderBy(F.col(value).desc()))).filter(F.col("__rank") <= k)
    # rows above rank k cannot matter; ties at one rank may be many, but only the first cap + 1 of them decide
    few = few.withColumn("position", F.row_number().over(part.orderBy(*order))).filter(F.col("position") <= cap + k)
    marked = few.withColumn("__cut", F.min(F.when(F.col("position") <= k, F.col(value))).over(part))
    marked = marked.withColumn("__n", F.count_if(F.col(value) >= F.col("__cut")).over(part)).withColumn("__above", F.count_if(F.col(value) > F.col("__cut")).over(part))
    keep = F.when(F.col("__n") <= cap, F.col(value) >= F.col("__cut")).when(F.col("__above") > 0, F.col(value) > F.col("__cut")).otherwise(F.col("position") <= k)
    return marked.filter(keep).drop("__rank", "__cut", "__n", "__above")


def first_rows(rows: DataFrame, by: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key in a total order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def occurrence(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``occurrence``: the how-manieth of equal labels."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def stratified_sample(rows: DataFrame, key: str, stratum: str, rate: float, least: int, seed: int) -> DataFrame:
    """max(ceil(rate * n), least) rows of each stratum in the order of a seeded hash: the same rows on every run.

    Rows are counted by the hash's first three digits; whole buckets are taken
    or left, and only the bucket that the last drawn row lies in is ranked.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    marked = rows.withColumn("__h", digest).withColumn("__b", F.substring("__h", 1, 3)).withColumn("__s", F.coalesce(F.to_json(F.struct(stratum)), F.lit("")))
    counts = marked.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy("__s").orderBy("__b")
    counts = counts.withColumn("__first", F.sum("__n").over(upto) - F.col("__n")).withColumn("__all", F.sum("__n").over(Window.partitionBy("__s")))
    counts = counts.withColumn("__want", F.greatest(F.ceil(F.lit(rate) * F.col("__all")), F.lit(least))).filter(F.col("__first") < F.col("__want"))
    drawn = marked.join(counts.select("__s", "__b", "__n", "__first", "__want"), ["__s", "__b"])
    whole = drawn.filter(F.col("__first") + F.col("__n") <= F.col("__want"))
    w = Window.partitionBy("__s", "__b").orderBy("__h", key)
    cut = drawn.filter(F.col("__first") + F.col("__n") > F.col("__want")).withColumn("__rn", F.row_number().over(w) + F.col("__first")).filter(F.col("__rn") <= F.col("__want"))
    return whole.select(*rows.columns).unionByName(cut.select(*rows.columns))


def share_shift(rows: DataFrame, period: str, group: str, value: str, now: Column, before: Column, digits: int = 1) -> DataFrame:
    """Shares of two periods in percent and their shift in points; groups of one period count 0 in the other."""
    part = lambda p, name: rows.filter(F.col(period) == p).groupBy(group).agg(F.sum(value).alias(name))
    both = part(now, "a").join(part(before, "b"), group, "full_outer").fillna(0, ["a", "b"])
    totals = both.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    x = both.crossJoin(F.broadcast(totals))
    pa, pb = F.round(100 * F.try_divide(F.col("a"), F.col("ta")), digits), F.round(100 * F.try_divide(F.col("b"), F.col("tb")), digits)
    return x.select(group, pa.alias("share_now"), pb.alias("share_before"), F.round(pa - pb, digits).alias("shift"))


def tag_union(rows: DataFrame, key: str, source_pos: str, tag: str, tag_pos: str, order: str, most: int = 3) -> DataFrame:
    """The first source's tags in their order, then the others' by how many sources carry them (ties by ``order``), at most ``most``."""
    per = rows.groupBy(key, tag).agg(
        F.min(F.when(F.col(source_pos) == 1, F.col(tag_pos))).alias("__lead"),
        F.count_distinct(F.when(F.col(source_pos) > 1, F.col(source_pos))).alias("__n"),
        F.min(order).alias("__o"),
    )
    w = Window.partitionBy(key).orderBy(F.col("__lead").asc_nulls_last(), F.col("__n").desc(), "__o")
    return per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select(key, tag, "rank")


def ratio_outliers(rows: DataFrame, group: str, numerator: str, denominator: str, tolerance: float = 0.15, least: float = 50) -> DataFrame:
    """Rows whose ratio is off their group's median by more than ``tolerance`` of it; small denominators are not judged."""
    fit = rows.filter(F.col(denominator) >= least).withColumn("ratio", F.col(numerator) / F.col(denominator))
    med = fit.groupBy(group).agg(F.percentile("ratio", 0.5).alias("median"))
    off = F.when(F.col("median") == 0, 1.0).otherwise(F.abs(F.col("ratio") - F.col("median")) / F.col("median"))
    return fit.join(med, group).withColumn("deviation", off).filter(F.col("deviation") > tolerance)


def guarded_correlation(rows: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Pearson correlation; null below three points or without variance."""
    ok = F.col(x).isNotNull() & F.col(y).isNotNull()
    stats = rows.filter(ok).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"), F.corr(x, y).alias("r"))
    return stats.select(*by, "n", F.when((F.col("n") >= 3) & (F.col("vx") > 0) & (F.col("vy") > 0), F.col("r")).alias("r"))


def measured_sum(rows: DataFrame, by: list[str], value: str, alias: str) -> DataFrame:
    """Sums of the groups in which every row has a value; a group with an unknown has no sum."""
    g = rows.groupBy(*by).agg(F.sum(value).alias(alias), F.count(value).alias("__known"), F.count(F.lit(1)).alias("__n"))
    return g.filter("__known = __n").drop("__known", "__n")


def share_bounds(rows: DataFrame, by: list[str], flag: str, digits: int = 9) -> DataFrame:
    """The share of rows with flag 1: its bounds while flags are unknown, and the share itself once none is."""
    g = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count(flag).alias("__known"), F.coalesce(F.sum(flag), F.lit(0)).alias("__hits"))
    part = lambda x: F.round(x / F.col("n"), digits)
    open_ = F.col("n") - F.col("__known")
    return g.select(*by, "n", open_.alias("unresolved"), part(F.col("__hits")).alias("low"), part(F.col("__hits") + open_).alias("high"), F.when(open_ == 0, part(F.col("__hits"))).alias("share"))


def most_frequent(rows: DataFrame, by: list[str], value: str, latest: Column) -> DataFrame:
    """The value with the most rows of each key and that number; a tie goes to the value seen last."""
    per = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), latest.alias("__last"))
    best = per.groupBy(*by).agg(F.max_by(F.struct(value, "n"), F.struct("n", "__last")).alias("b"))
    return best.select(*by, f"b.{value}", "b.n")
