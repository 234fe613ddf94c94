"""Logs of requests: paged lists with cursors, lookups that stop after failures in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.scan import Machine, scan


def stopping(limit: int) -> Machine:
    """Phases are the failures in a row; at ``limit`` nothing more is asked. Hits and misses are answers and begin anew."""
    rules = {}
    for n in range(limit):
        rules[f"failed_{n}", "failed"] = (f"failed_{n + 1}" if n + 1 < limit else "stopped", ("n_asked",))
        for answer in ("hit", "miss"):
            rules[f"failed_{n}", answer] = ("failed_0", ("n_asked",))
    return Machine("failed_0", rules)


def stop_after(log: DataFrame, unit: str, order: list[str], outcome: str, limit: int = 3, **options: int) -> DataFrame:
    """``log`` with ``state`` (hit, miss, failed or not_asked) and ``n_asked`` so far.

    Lookups behind ``limit`` failures in a row of their unit are not asked,
    whatever the log says of them: they are neither misses nor failures.
    """
    got = scan(log, unit, order, {"__run": (outcome, stopping(limit))}, **options)
    return got.withColumn("state", F.when(F.col("__run") == "stopped", "not_asked").otherwise(F.col(outcome))).drop("__run")


def paged_lists(pages: DataFrame, scope: str, page: str, used: str, following: str, announced: str, items: str) -> DataFrame:
    """``(scope, n_pages, n_items, announced, ended, state)`` of lists landed page by page.

    Each page tells the cursor it was asked with (``used``; none on the first)
    and the one ``following``. A list ends with the first page that is empty,
    has no following cursor, repeats the one it was asked with, or completes the
    announced number of different items; it breaks before a page that was not
    asked with the cursor before it. Pages behind the end don't count. The
    number announced is the first page's. ``state``: complete, short, over or
    unannounced.
    """
    w = Window.partitionBy(scope).orderBy(page)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    base = pages.select(scope, page, used, following, announced, items)
    first = base.select(scope, page, F.explode(items).alias("__i")).groupBy(scope, "__i").agg(F.min(page).alias(page))
    new = first.groupBy(scope, page).agg(F.count(F.lit(1)).alias("__new"))
    held = base.join(new, [scope, page], "left").withColumn("__held", F.sum(F.coalesce("__new", F.lit(0))).over(upto)).withColumn("__total", F.first(announced).over(upto))
    ends = (
        F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, "empty_page")
        .when(F.coalesce(F.col(following), F.lit("")) == "", "no_cursor")
        .when(F.col(following).eqNullSafe(F.col(used)), "repeated_cursor")
        .when(F.col("__held") >= F.col("__total"), "all_held")
    )
    broken = ~F.col(used).eqNullSafe(F.lag(following).over(w))
    held = held.withColumn("__ends", ends).withColumn("__broken", broken)
    open_ = F.coalesce(F.max(F.col("__ends").isNotNull()).over(before), F.lit(False))
    read = held.withColumn("__behind", open_ | F.max("__broken").over(upto))
    read = read.withColumn("__gap", F.max(F.col("__broken") & ~open_).over(Window.partitionBy(scope)))
    g = read.groupBy(scope).agg(
        F.count_if(~F.col("__behind")).alias("n_pages"),
        F.coalesce(F.max(F.when(~F.col("__behind"), F.col("__held"))), F.lit(0)).cast("long").alias("n_items"),
        F.min_by("__total", page).alias("announced"),
        F.max(F.when(~F.col("__behind"), F.col("__ends"))).alias("__ends"),
        F.max("__gap").alias("__gap"),
    )
    ended = F.coalesce("__ends", F.when(F.col("__gap"), "missing_page").otherwise("open"))
    state = F.when(F.col("announced").isNull(), "unannounced").when(F.col("n_items") == F.col("announced"), "complete").when(F.col("n_items") < F.col("announced"), "short").otherwise("over")
    return g.select(scope, "n_pages", "n_items", "announced", ended.alias("ended"), state.alias("state"))
