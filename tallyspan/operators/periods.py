"""The period-metric engine: observe, compare with strictly earlier periods, gate, rank."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.scalars import id_sort_key
from tallyspan.session import materialize


@dataclass(frozen=True)
class MetricSpec:
    """One registry entry; the extension point for new metrics."""

    metric_id: str
    direction: str = "max"
    aggregation: str = "extreme"
    min_history: int = 8
    tie_rank: int = 0
    min_value: float | None = None
    requires_topic: bool = False
    version: int = 1

    def __post_init__(self) -> None:
        if self.direction not in ("max", "min"):
            raise ValueError(f"{self.metric_id}: direction {self.direction!r}")
        if self.aggregation not in ("extreme", "count", "grouped_extreme"):
            raise ValueError(f"{self.metric_id}: aggregation {self.aggregation!r}")
        if self.min_history < 1:
            raise ValueError(f"{self.metric_id}: min_history {self.min_history}")


def validate_registry(specs: list[MetricSpec]) -> None:
    """Ids and tie ranks are unique."""
    for what in ("metric_id", "tie_rank"):
        seen = [getattr(s, what) for s in specs]
        if len(set(seen)) != len(seen):
            raise ValueError(f"{what} repeats: {seen}")


def periods_of(stored: DataFrame, expected: DataFrame, key: str = "unit", period: str = "period") -> DataFrame:
    """Periods of the union of stored and expected units: ``(period, n_stored, n_expected, n_missing, n_stale)``."""
    a = stored.select(key, period).distinct().withColumn("s", F.lit(1))
    b = expected.select(key, period).distinct().withColumn("e", F.lit(1))
    both = a.join(b, [key, period], "full_outer")
    return both.groupBy(period).agg(
        F.count("s").alias("n_stored"), F.count("e").alias("n_expected"), F.count_if(F.col("s").isNull()).alias("n_missing"), F.count_if(F.col("e").isNull()).alias("n_stale")
    )


def observe(candidates: DataFrame, spec: MetricSpec, periods: DataFrame, period: str = "period") -> DataFrame:
    """``(period, value, denominator, cited, topic, n)`` for every period.

    Candidates have ``id, value`` and optionally ``denominator, group_id,
    topic, tie_value``. The extreme's ties go to the highest ``tie_value``,
    then to the lowest id; a count of nothing is 0; an extreme of nothing is no
    observation. Grouped extremes add up value, denominator and tie value of
    each group, whose topic is the first of its topics.
    """
    rows = candidates.filter(F.col("value").isNotNull())
    for name, kind in (("denominator", "long"), ("topic", "string"), ("tie_value", "double")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    sign = -1 if spec.direction == "max" else 1
    if spec.aggregation == "count":
        got = rows.groupBy(period).agg(
            F.count(F.lit(1)).cast("double").alias("value"), F.lit(None).cast("long").alias("denominator"), F.min_by("id", id_sort_key("id")).alias("cited"),
            F.min_by("topic", id_sort_key("id")).alias("topic"), F.count(F.lit(1)).alias("n"),
        )
        out = periods.select(period).join(got, period, "left")
        return out.withColumn("value", F.coalesce("value", F.lit(0.0))).withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    if spec.aggregation == "grouped_extreme":
        rows = rows.groupBy(period, F.col("group_id").alias("id")).agg(
            F.sum("value").alias("value"), F.sum("denominator").alias("denominator"), F.min("topic").alias("topic"), F.sum("tie_value").alias("tie_value")
        )
    order = F.struct((sign * F.col("value")).alias("v"), F.coalesce(-F.col("tie_value"), F.lit(0.0)).alias("t"), id_sort_key("id").alias("k"))
    best = rows.groupBy(period).agg(F.min_by(F.struct("value", "denominator", "id", "topic"), order).alias("b"), F.count(F.lit(1)).alias("n"))
    flat = best.select(period, F.col("b.value").cast("double").alias("value"), F.col("b.denominator").alias("denominator"), F.col("b.id").alias("cited"), F.col("b.topic").alias("topic"), "n")
    return periods.select(period).join(flat, period, "left")


def observe_all(candidates: dict[str, DataFrame], specs: list[MetricSpec], periods: DataFrame, period: str = "period") -> DataFrame:
    """What ``observe`` says of every metric and period, with the metric's settings beside it.

    The metrics' candidates are put under each other, so all extremes meet in
    one shuffle, after the sums of all groups, and all counts in another.
    """
    by: dict[str, list[DataFrame]] = {"extreme": [], "grouped_extreme": [], "count": []}
    for s in specs:
        have = candidates[s.metric_id]
        of = lambda name, kind: (F.col(name) if name in have.columns else F.lit(None)).cast(kind).alias(name)  # noqa: B023, E731
        ident = F.col("group_id") if s.aggregation == "grouped_extreme" else F.col("id")
        by[s.aggregation].append(
            have.filter(F.col("value").isNotNull()).select(
                F.lit(s.metric_id).alias("metric_id"), F.lit(-1 if s.direction == "max" else 1).alias("__sign"), period, ident.cast("string").alias("id"),
                of("value", "double"), of("denominator", "long"), of("topic", "string"), of("tie_value", "double"),
            )
        )
    stacked = {k: reduce(DataFrame.unionByName, v) for k, v in by.items() if v}
    found, keys = [], ["metric_id", period]
    if "grouped_extreme" in stacked:
        sums = stacked["grouped_extreme"].groupBy(*keys, "__sign", "id").agg(F.sum("value").alias("value"), F.sum("denominator").alias("denominator"), F.min("topic").alias("topic"), F.sum("tie_value").alias("tie_value"))
        stacked["extreme"] = stacked["extreme"].unionByName(sums) if "extreme" in stacked else sums
    if "extreme" in stacked:
        place = F.struct((F.col("__sign") * F.col("value")).alias("v"), F.coalesce(-F.col("tie_value"), F.lit(0.0)).alias("t"), id_sort_key("id").alias("k"))
        best = stacked["extreme"].groupBy(*keys).agg(F.min_by(F.struct("value", "denominator", "id", "topic"), place).alias("b"), F.count(F.lit(1)).alias("n"))
        found.append(best.select(*keys, "b.value", "b.denominator", F.col("b.id").alias("cited"), "b.topic", "n"))
    if "count" in stacked:
        number, first = F.count(F.lit(1)), id_sort_key("id")
        found.append(stacked["count"].groupBy(*keys).agg(number.cast("double").alias("value"), F.lit(None).cast("long").alias("denominator"), F.min_by("id", first).alias("cited"), F.min_by("topic", first).alias("topic"), number.alias("n")))
    settings = periods.sparkSession.createDataFrame(
        [(s.metric_id, s.direction, s.min_history, s.tie_rank, None if s.min_value is None else float(s.min_value), s.requires_topic, s.aggregation == "count") for s in specs],
        "metric_id string, direction string, min_history int, tie_rank int, min_value double, requires_topic boolean, __counts boolean",
    )
    every = periods.select(period).crossJoin(F.broadcast(settings))  # a row for each metric of the registry
    out = every.join(reduce(DataFrame.unionByName, found), keys, "left")
    zero = lambda c, kind: F.when(F.col("__counts"), F.coalesce(c, F.lit(0).cast(kind))).otherwise(F.col(c)).alias(c)
    return out.select("metric_id", "direction", "min_history", "tie_rank", "min_value", "requires_topic", period, zero("value", "double"), "denominator", "cited", "topic", zero("n", "long"))


def strict_prior(rows: DataFrame, by: list[str], order: str, value: str, term: str, usable: Column, direction: Column, min_history: Column) -> DataFrame:
    """Baseline columns from strictly earlier usable rows: the same term if it has enough of them, else all.

    Adds ``base_kind, base_n, base_from, base_to, eligible, percentile``; the
    percentile is the share of baseline values strictly beaten. The history is
    one small row for each different (``by``, order, term, value), met by a
    range join whose matches are counted as they come; no row holds a history.
    """
    marked = rows.withColumn("__max", direction == "max").withColumn("__least", min_history).withColumn("__ok", F.coalesce(usable, F.lit(False)))
    point = [*by, order, term, value, "__max"]
    past = marked.filter("__ok").groupBy(*by, order, term, value).agg(F.count(F.lit(1)).alias("__n"))
    past = past.select(*[F.col(c).alias(f"__{c}") for c in by], F.col(order).alias("__o"), F.col(term).alias("__t"), F.col(value).alias("__v"), "__n")
    now = marked.select(*point).distinct()
    earlier = F.col("__o") < F.col(order)
    for c in by:
        earlier = earlier & F.col(f"__{c}").eqNullSafe(F.col(c))
    own = F.col("__t").eqNullSafe(F.col(term))
    beaten = F.coalesce(F.when(F.col("__max"), F.col(value) > F.col("__v")).otherwise(F.col(value) < F.col("__v")), F.lit(False))
    n = lambda *when: F.coalesce(F.sum(F.when(F.lit(True) if not when else when[0] if len(when) == 1 else when[0] & when[1], F.col("__n"))), F.lit(0))
    found = now.join(past, earlier, "left").groupBy(*point).agg(
        n().alias("__n_all"), n(own).alias("__n_term"), n(beaten).alias("__k_all"), n(own, beaten).alias("__k_term"),
        F.min("__o").alias("__from_all"), F.max("__o").alias("__to_all"), F.min(F.when(own, F.col("__o"))).alias("__from_term"), F.max(F.when(own, F.col("__o"))).alias("__to_term"),
    )
    keys = F.lit(True)
    for c in point:
        keys = keys & marked[c].eqNullSafe(found[c])
    joined = marked.join(found, keys).select(marked["*"], *[found[c] for c in found.columns if c not in point])
    same = F.col("__n_term") >= F.col("__least")
    pick = lambda c: F.when(same, F.col(f"__{c}_term")).otherwise(F.col(f"__{c}_all"))
    return (
        joined.withColumn("base_kind", F.when(same, "term").otherwise("all"))
        .withColumn("base_n", pick("n").cast("int"))
        .withColumn("base_from", pick("from"))
        .withColumn("base_to", pick("to"))
        .withColumn("eligible", F.col("__ok") & (F.col("base_n") >= F.col("__least")))
        .withColumn("percentile", F.when(F.col("__ok") & (F.col("base_n") > 0), pick("k") / F.col("base_n")))
        .drop(*[c for c in joined.columns if c.startswith("__")])
    )


def withheld_reason(floor: float = 0.5, topic: str | None = None) -> Column:
    """The first gate that a fact fails, null if it is posted. Needs value, eligible, percentile, min_value, requires_topic, and a ``topic`` column if any metric requires one."""
    has_topic = F.col(topic).isNotNull() if topic else F.lit(False)
    return (
        F.when(F.col("value").isNull(), "no_observation")
        .when(~F.coalesce("eligible", F.lit(False)) | F.col("percentile").isNull(), "not_comparable")
        .when(F.col("min_value").isNotNull() & (F.col("value") < F.col("min_value")), "below_min_value")
        .when(F.col("requires_topic") & ~has_topic, "no_topic")
        .when(F.col("percentile") < floor, "below_floor")
    )


def rank_facts(facts: DataFrame, period: str = "period") -> DataFrame:
    """``rank`` 1..n over the posted facts of a period: percentile descending, then tie rank; withheld rows have none."""
    posted = F.col("withheld").isNull()
    w = Window.partitionBy(period, posted).orderBy(F.col("percentile").desc(), "tie_rank")
    return facts.withColumn("rank", F.when(posted, F.row_number().over(w)))


def compute_facts(candidates: dict[str, DataFrame], specs: list[MetricSpec], periods: DataFrame, floor: float = 0.5, period: str = "period", order: str = "period_no", term: str = "term") -> DataFrame:
    """All metrics over all periods. ``periods (period, period_no, term, complete)``; the loop is over the registry only."""
    validate_registry(specs)
    rows = observe_all(candidates, specs, periods, period)
    rows = rows.join(periods.select(period, order, term, "complete"), period)
    # a row for each metric and period: written once, as the baseline below reads it three times
    rows = materialize(rows.withColumn("value", F.when(F.col("complete"), F.col("value"))), "observations")
    usable = F.col("complete") & F.col("value").isNotNull()
    rows = strict_prior(rows, ["metric_id"], order, "value", term, usable, F.col("direction"), F.col("min_history"))
    return rank_facts(rows.withColumn("withheld", withheld_reason(floor, "topic")), period)
