"""Announced questions and the turns that put them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def put_questions(rows: DataFrame, unit: str, order: list[str], asker: str, announced: str, ident: str) -> DataFrame:
    """``(unit, asker, ident, turn)``: each announced question with the first free later turn of its asker, null without one.

    ``announced`` says whether a row is an announcement or a turn. In order,
    every question takes the first turn behind it that no question before it
    has taken; so the turns of an asker serve a queue. How many came when
    nobody waited is the depth that the running balance of questions and turns
    has reached below zero, so no row is looked at twice: the n-th turn that
    serves puts the n-th question.
    """
    w = Window.partitionBy(unit, asker).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    base = rows.select(unit, asker, *[c for c in dict.fromkeys([*order, ident]) if c not in (unit, asker)], F.col(announced).alias("__q"))
    balance = F.sum(F.when(F.col("__q"), 1).otherwise(-1)).over(upto)
    free = base.withColumn("__b", balance).withColumn("__free", F.greatest(F.lit(0), -F.min("__b").over(upto)))
    seen = F.sum(F.col("__q").cast("int")).over(upto)
    number = F.when(F.col("__q"), seen).otherwise(F.sum((~F.col("__q")).cast("int")).over(upto) - F.col("__free"))
    wasted = ~F.col("__q") & (F.col("__free") > F.coalesce(F.lag("__free").over(w), F.lit(0)))
    numbered = free.withColumn("__n", number).withColumn("__wasted", wasted).filter(~F.col("__wasted"))
    each = numbered.groupBy(unit, asker, "__n").agg(F.max(F.when(F.col("__q"), F.col(ident))).alias(ident), F.max(F.when(~F.col("__q"), F.col(ident))).alias("turn"))
    return each.select(unit, asker, ident, "turn")


def named_askers(questions: DataFrame, ident: str, turn: str, asker: str, people: DataFrame, name: str, person: str) -> DataFrame:
    """``(ident, turn, person, source)``: who asked, by the turn that put it, else the only person of that name, else the name alone."""
    only = people.groupBy(F.col(name).alias("__name")).agg(F.min(person).alias("__person"), F.count_distinct(person).alias("__n")).filter("__n = 1")
    got = questions.join(only, F.col(asker) == F.col("__name"), "left")
    source = F.when(F.col(turn).isNotNull(), "turn").when(F.col("__person").isNotNull(), "candidate").otherwise("name")
    return got.select(ident, turn, F.when(F.col(turn).isNull(), F.col("__person")).alias("person"), source.alias("source"))
