"""Fail-closed checks: completeness, gaps, conservation, invariants, release gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uniform(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The one value of each group; a group with several fails the query and is named."""
    g = rows.groupBy(group).agg(F.count_distinct(value).alias("__n"), F.min(value).alias(value))
    several = F.raise_error(F.format_string(f"{group} %s has several values of {value}", F.col(group).cast("string")))
    return g.select(group, F.when(F.col("__n") > 1, several).otherwise(F.col(value)).alias(value))


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The name of the first check that holds; a check that can't be told holds too. Null if none does."""
    out = None
    for failed, name in checks:
        held = F.coalesce(failed, F.lit(True))
        out = F.when(held, name) if out is None else out.when(held, name)
    return out


def period_gaps(expected: DataFrame, stored: DataFrame, key: str, period: str, stamp: str, reason: str) -> DataFrame:
    """``(period, key, gap)`` of the expected units that are not plainly there.

    A stamp that moved since storing comes before a unit that is not stored,
    and both before the reason the stored unit carries.
    """
    e = expected.select(key, period, F.col(stamp).alias("__e"))
    s = stored.select(key, F.col(stamp).alias("__s"), F.col(reason).alias("__r"), F.lit(True).alias("__have"))
    both = e.join(s, key, "left")
    gap = F.when(F.col("__have") & ~F.col("__e").eqNullSafe(F.col("__s")), "changed").when(F.col("__have").isNull(), "not_stored").otherwise(F.col("__r"))
    return both.select(period, key, gap.alias("gap"))


def period_complete(gaps: DataFrame, period: str, running: Column) -> DataFrame:
    """A period is complete with at least one unit, no gap, and not while it runs."""
    g = gaps.groupBy(period).agg(F.count(F.lit(1)).alias("n"), F.count("gap").alias("n_gaps"))
    return g.withColumn("complete", (F.col("n") > 0) & (F.col("n_gaps") == 0) & ~F.coalesce(running, F.lit(True)))


def conservation(source: DataFrame, statuses: DataFrame, key: str) -> DataFrame:
    """Units without exactly one status, and statuses of no unit: ``(key, problem)``, empty if all is conserved."""
    per = statuses.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = source.select(key, F.lit(1).alias("__s")).distinct().join(per, key, "full_outer")
    problem = F.when(F.col("__s").isNull(), "no_source").when(F.col("n").isNull(), "no_status").when(F.col("n") > 1, "several")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def split_valid(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantined)``: rows without a reason, and the others with it."""
    marked = rows.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def acquisition_state(rows: DataFrame, by: list[str], ended: str, failed: str, found: str) -> DataFrame:
    """complete if every scan ended and none failed, partial if something was found, else failed."""
    g = rows.groupBy(*by).agg(F.bool_and(F.coalesce(F.col(ended), F.lit(False))).alias("e"), F.bool_or(F.coalesce(F.col(failed), F.lit(True))).alias("f"), F.sum(F.coalesce(found, F.lit(0))).alias("n"))
    return g.select(*by, F.when(F.col("e") & ~F.col("f"), "complete").when(F.col("n") > 0, "partial").otherwise("failed").alias("state"))


def release_gate(withheld_before: DataFrame, withheld_now: DataFrame, key: str, cap: int) -> DataFrame:
    """One row: newly withheld units, and whether they stay within the cap."""
    new = withheld_now.select(key).distinct().join(withheld_before.select(key), key, "left_anti")
    return new.agg(F.count(F.lit(1)).alias("newly_withheld")).withColumn("passes", F.col("newly_withheld") <= cap)


def receipts(observations: DataFrame, rows: DataFrame, on: list[str], order: Column, keep: int | None = None) -> DataFrame:
    """The rows behind each observation, numbered in a total order; ``keep`` is the number a receipt lists."""
    from pyspark.sql import Window

    w = Window.partitionBy(*on).orderBy(order)
    out = rows.join(observations, on, "left_semi").withColumn("receipt", F.row_number().over(w))
    return out if keep is None else out.filter(F.col("receipt") <= keep)
