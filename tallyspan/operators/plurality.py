"""Plurality, deviation and cover checks over grouped counts; unknown is never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STANCES = ("yes", "no", "abstain")
MEASURES = (*STANCES, "absent")


def leading(counts: dict[str, Column] | None = None, stances: tuple[str, ...] = STANCES) -> Column:
    """The stance with the most votes; null when nobody voted or the top is shared."""
    have = counts or {s: F.col(s) for s in stances}
    zeroed = {s: F.coalesce(c, F.lit(0)) for s, c in have.items()}
    top = F.greatest(*zeroed.values())
    leaders = F.filter(F.array(*[F.when(c == top, F.lit(s)) for s, c in zeroed.items()]), lambda x: x.isNotNull())
    return F.when((top > 0) & (F.size(leaders) == 1), leaders[0])


def merge_groups(rows: DataFrame, vote: str, group: Column, measures: tuple[str, ...] = MEASURES, order: str = "pos") -> DataFrame:
    """One row per vote and canonical group: counts added, the first position kept."""
    named = rows.withColumn("grp", F.coalesce(group, F.lit("unknown")))
    sums = [F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in measures]
    return named.groupBy(vote, "grp").agg(*sums, F.min(order).alias(order))


def refile(counts: DataFrame, moves: DataFrame, vote: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``counts`` after moving single votes between groups: ``moves (vote, from_grp, to_grp, stance)``; emptied groups go."""
    total = sum(F.coalesce(F.col(m), F.lit(0)) for m in measures)
    signed = lambda side, step: moves.select(vote, F.col(side).alias("grp"), *[F.when(F.col("stance") == m, step).otherwise(0).alias(m) for m in measures], F.lit(side == "from_grp").alias("left"))
    both = counts.select(vote, "grp", *measures).withColumn("left", F.lit(False)).unionByName(signed("from_grp", -1)).unionByName(signed("to_grp", 1))
    out = both.groupBy(vote, "grp").agg(*[F.sum(m).alias(m) for m in measures], F.bool_or("left").alias("left"))
    return out.filter((total != 0) | ~F.col("left")).drop("left")


def covers_total(counts: DataFrame, totals: DataFrame, vote: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``(vote, covers)``: whether the groups add up to the total on every measure; no rows, nulls or four zeros cover nothing."""
    sums = counts.groupBy(vote).agg(*[F.sum(F.coalesce(m, F.lit(0))).alias(f"s_{m}") for m in measures])
    same, zero = F.lit(True), F.lit(True)
    for m in measures:
        same = same & (F.col(m) == F.col(f"s_{m}"))
        zero = zero & (F.col(m) == 0)
    joined = totals.join(sums, vote, "left")
    return joined.select(vote, F.coalesce(same & ~zero, F.lit(False)).alias("covers"))


def latest_members(members: DataFrame, vote: str, identity: str, order: list[str]) -> DataFrame:
    """The last row of each identity in a vote."""
    w = Window.partitionBy(vote, identity).orderBy(*[F.desc(o) for o in order])
    return members.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def deviators(members: DataFrame, counts: DataFrame, vote: str, no_group: tuple[str, ...] = ("independent", "unknown"), measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``(vote, grp, state, leading, n_deviators)``: complete, partial, no_members or unlisted.

    Nobody is named unless the members' own tally equals the group's counts.
    """
    return tallied_deviators(tally_of(members, vote, measures), counts, vote, no_group, measures)


def tally_of(members: DataFrame, vote: str, measures: tuple[str, ...] = MEASURES, *more: Column) -> DataFrame:
    """``(vote, grp, m_<measure>, m_all)``: how the members of each group voted; ``more`` are further aggregates."""
    return members.groupBy(vote, "grp").agg(*[F.count_if(F.col("stance") == m).alias(f"m_{m}") for m in measures], F.count(F.lit(1)).alias("m_all"), *more)


def tallied_deviators(tally: DataFrame, counts: DataFrame, vote: str, no_group: tuple[str, ...] = ("independent", "unknown"), measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``deviators`` from the members' tally."""
    listed = counts.filter(~F.col("grp").isin(list(no_group))).withColumn("listed", F.lit(True))
    have = counts.select(vote).distinct().withColumn("has_rows", F.lit(True))
    joined = listed.join(tally.filter(~F.col("grp").isin(list(no_group))), [vote, "grp"], "full_outer").join(have, vote, "left_semi")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    equal = F.lit(True)
    for m in measures:
        equal = equal & (zero(m) == zero(f"m_{m}"))
    equal = equal & (zero("m_all") == sum(zero(m) for m in measures))
    state = F.when(F.col("listed").isNull(), "unlisted").when(equal, "complete").when(zero("m_all") == 0, "no_members").otherwise("partial")
    lead = leading({s: F.col(s) for s in STANCES})
    n = F.when(F.col("state") == "complete", F.when(F.col("leading") == "yes", zero("m_no")).when(F.col("leading") == "no", zero("m_yes")).otherwise(0))
    return joined.withColumn("state", state).withColumn("leading", F.when(F.col("listed"), lead)).select(vote, "grp", "state", "leading", n.cast("long").alias("n_deviators"))


def deviator_count(groups: DataFrame, cover: DataFrame, vote: str) -> DataFrame:
    """``(vote, n_deviators)``: null unless every group is complete and the groups cover the total."""
    per = groups.groupBy(vote).agg(F.bool_and(F.col("state") == "complete").alias("ok"), F.sum("n_deviators").alias("n"))
    return cover.join(per, vote, "left").select(vote, F.when(F.col("ok") & F.col("covers"), F.col("n")).alias("n_deviators"))


def member_flags(members: DataFrame, groups: DataFrame, vote: str) -> DataFrame:
    """``members`` with ``deviates`` 1, 0 or null (cannot be told)."""
    against = ((F.col("leading") == "yes") & (F.col("stance") == "no")) | ((F.col("leading") == "no") & (F.col("stance") == "yes"))
    joined = members.join(groups.select(vote, "grp", "state", "leading"), [vote, "grp"], "left")
    return joined.withColumn("deviates", F.when(F.col("state") == "complete", F.coalesce(against, F.lit(False)).cast("int"))).drop("state", "leading")


def absorbable(moves: DataFrame, counts: DataFrame, vote: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``(vote, accepted)``: whether the groups can give up all moved votes; a vote whose moves exceed one count is refused as a whole."""
    asked = moves.groupBy(vote, F.col("from_grp").alias("grp"), "stance").agg(F.count(F.lit(1)).alias("n"))
    have = F.coalesce(*[F.when(F.col("stance") == m, F.col(m)) for m in measures])
    fits = asked.join(counts, [vote, "grp"], "left").withColumn("fits", F.coalesce(F.col("n") <= have, F.lit(False)))
    return fits.groupBy(vote).agg(F.bool_and("fits").alias("accepted"))
