"""Entities and periods over time: returning, traced, compared; turns of a conversation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.session import materialize


def returning(seen: DataFrame, key: str, period: str) -> DataFrame:
    """``(key, n_earlier)``: entities of the last period that were there in an earlier one too."""
    last = seen.agg(F.max(period).alias("__last"))
    marked = seen.select(key, period).distinct().crossJoin(F.broadcast(last))
    g = marked.groupBy(key).agg(F.count_if(F.col(period) == F.col("__last")).alias("__now"), F.count_if(F.col(period) < F.col("__last")).alias("n_earlier"))
    return g.filter("__now > 0 and n_earlier > 0").drop("__now")


def suppress_twins(rows: DataFrame, key: str, order: list[str], twins: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``rows`` in a total order without those that a kept row before them names as its twin.

    A row is settled as soon as no open row before it names it, so all rows of
    one depth are settled in a round; rounds are as many as the longest chain
    of twins, not as many as rows.
    """
    place = lambda name: rows.select(F.col(key).alias(name), F.struct(*order).alias(f"__{name}"))
    named = twins.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    edges = materialize(named.join(place("src"), "src").join(place("dst"), "dst").filter("__src < __dst").select("src", "dst"), "twins")
    gone: list[DataFrame] = []
    while not edges.isEmpty():
        kept = edges.select("src").distinct().join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_anti")
        dropped = materialize(edges.join(kept, "src").select("dst").distinct(), "twins-dropped")
        gone.append(dropped)
        if len(gone) > 8:  # the plan stays small, whatever the number of rounds
            gone = [materialize(reduce(DataFrame.unionByName, gone), "twins-gone")]
        rest = edges.join(kept, "src", "left_anti").join(dropped, "dst", "left_anti")
        edges = materialize(rest.join(dropped.select(F.col("dst").alias("src")), "src", "left_anti"), "twins")
    if not gone:
        return rows
    return rows.join(reduce(DataFrame.unionByName, gone).select(F.col("dst").alias(key)), key, "left_anti")


def last_periods(rows: DataFrame, period: str, n: int) -> DataFrame:
    """The n newest periods that exist; they need not follow each other."""
    return rows.select(period).distinct().orderBy(F.desc(period)).limit(n)


def week_comparison(per_day: DataFrame, week: str, day: str, value: str) -> DataFrame:
    """``(week, basis, delta)`` against the week before: totals if both have as many days, else their shared weekdays, else none."""
    w = Window.orderBy(week)  # one row per week
    per = per_day.groupBy(week).agg(F.count(F.lit(1)).alias("days"), F.sum(value).alias("n"))
    pairs = per.select(week, "days", "n", F.lag(week).over(w).alias("pw"), F.lag("days").over(w).alias("pd"), F.lag("n").over(w).alias("pn"))
    now = per_day.select(week, F.col(day).alias("__d"), F.col(value).alias("__a"))
    before = per_day.select(F.col(week).alias("pw"), F.col(day).alias("__d"), F.col(value).alias("__b"))
    shared = pairs.select(week, "pw").join(now, week).join(before, ["pw", "__d"]).groupBy(week).agg((F.sum("__a") - F.sum("__b")).alias("shared"))
    basis = F.when(F.col("pw").isNull(), "none").when(F.col("days") == F.col("pd"), "total").when(F.col("shared").isNotNull(), "weekdays").otherwise("none")
    delta = F.when(F.col("days") == F.col("pd"), F.col("n") - F.col("pn")).otherwise(F.col("shared"))
    return pairs.join(shared, week, "left").select(week, basis.alias("basis"), delta.alias("delta"))


def earliest_trace(candidates: DataFrame, unit: str, pos: str, ident: str, period: str) -> DataFrame:
    """``(unit, pos, period)``: the earliest earlier period of the first candidate id that has one.

    Only the first period of each id matters, so no id's rows meet each other.
    """
    first = candidates.groupBy(ident).agg(F.min(period).alias("__first"))
    hit = candidates.join(first, ident).filter(F.col("__first") < F.col(period))
    return hit.groupBy(unit).agg(F.min(F.struct(F.col(pos).alias("pos"), F.col("__first").alias("p"))).alias("m")).select(unit, F.col("m.pos").alias(pos), F.col("m.p").alias(period))


def turn_kinds(turns: DataFrame, unit: str, order: str, role: str, asks: str = "user", procedure: str = "system") -> DataFrame:
    """``(unit, order, kind, parent, exchange)``: question, follow_up, answer, resumption, statement or procedure.

    An answer follows a question at once, a resumption later; their parent is
    the last asking turn before. ``exchange`` counts the questions so far.
    """
    w = Window.partitionBy(unit).orderBy(order)
    before = F.lag(role).over(w)
    asked = F.last(F.when(F.col(role) == asks, F.col(order)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    kind = (
        F.when(F.col(role) == procedure, "procedure")
        .when((F.col(role) == asks) & (F.col("__before") == asks), "follow_up")
        .when(F.col(role) == asks, "question")
        .when(F.col("__before") == asks, "answer")
        .when(F.col("__asked").isNotNull(), "resumption")
        .otherwise("statement")
    )
    marked = turns.select(unit, order, role, before.alias("__before"), asked.alias("__asked")).withColumn("kind", kind)
    parent = F.when(F.col("kind").isin("answer", "resumption"), F.col("__asked"))
    count = F.sum(F.when(F.col("kind") == "question", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.select(unit, order, "kind", parent.alias("parent"), count.alias("exchange"))


def union_of_spans(rows: DataFrame, keys: list[str], label: str, first: str, last: str) -> DataFrame:
    """Closed spans of equal label that overlap or touch become one (gaps and islands)."""
    w = Window.partitionBy(*keys, label).orderBy(first, last)
    reach = F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("__new", F.when(F.col(first) <= F.date_add(reach, 1), 0).otherwise(1))
    islands = marked.withColumn("__i", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, label, "__i").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("__i")


def sessions(rows: DataFrame, key: str, ts: str, gap: Column) -> DataFrame:
    """``rows`` with ``session``: a new one starts after more than ``gap`` seconds without a row."""
    w = Window.partitionBy(key).orderBy(ts)
    idle = F.unix_micros(F.col(ts)) - F.unix_micros(F.lag(ts).over(w))
    return rows.withColumn("__new", F.when(idle <= gap.cast("long") * 1_000_000, 0).otherwise(1)).withColumn("session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def segments(kinds: DataFrame, texts: DataFrame, unit: str, order: str, text: str) -> DataFrame:
    """``(unit, exchange, n_turns, n_answers, n_chars)`` of the exchanges of each unit; turns before the first question are exchange 0."""
    both = kinds.join(texts.select(unit, order, F.length(text).alias("__len")), [unit, order])
    return both.groupBy(unit, "exchange").agg(F.count(F.lit(1)).alias("n_turns"), F.count_if(F.col("kind") == "answer").alias("n_answers"), F.sum("__len").alias("n_chars"))


def commit_on_finish(parts: DataFrame, unit: str, refused: Column) -> tuple[DataFrame, DataFrame]:
    """``(accepted parts, (unit, n_refused))``: a unit's parts stand only if none of them is refused; a check that can't be told refuses."""
    marked = parts.withColumn("__bad", F.coalesce(refused, F.lit(True)))
    held = marked.groupBy(unit).agg(F.count_if("__bad").alias("n_refused")).filter("n_refused > 0")
    return marked.join(held, unit, "left_anti").drop("__bad"), held


def first_reply(turns: DataFrame, unit: str, order: str, role: str, asks: str, answers: str) -> DataFrame:
    """``(unit, order, reply)``: each asking turn with the first later turn of the answering role, null without one."""
    w = Window.partitionBy(unit).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    nxt = F.first(F.when(F.col(role) == answers, F.col(order)), ignorenulls=True).over(w)
    return turns.withColumn("reply", nxt).filter(F.col(role) == asks).select(unit, order, "reply")


def replayed(old: DataFrame, new: DataFrame, label: list[str], old_order: list[str], new_order: list[str], old_id: str, new_id: str) -> DataFrame:
    """``(old_id, new_id)``: the n-th row of a label before is its n-th row now; rows without a counterpart have null."""
    number = lambda o: F.row_number().over(Window.partitionBy(*label).orderBy(*o))
    a = old.select(*label, F.col(old_id).alias("old_id"), number(old_order).alias("__n"))
    b = new.select(*label, F.col(new_id).alias("new_id"), number(new_order).alias("__n"))
    return a.join(b, [*label, "__n"], "full_outer").select("old_id", "new_id")
