"""Half-open validity intervals [start, end), null end = open: joins, coalescing, sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR = "9999-12-31"


def covers(day: Column, start: Column, end: Column) -> Column:
    return (start <= day) & (end.isNull() | (day < end))


def as_of_join(facts: DataFrame, intervals: DataFrame, keys: list[str], day: str, start: str = "valid_from", end: str = "valid_until", how: str = "inner") -> DataFrame:
    """Facts with the intervals of the same key that cover their day."""
    right = intervals.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in intervals.columns if c not in keys])
    on = covers(F.col(day), F.col(start), F.col(end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return facts.join(right, on, how).drop(*[f"__{k}" for k in keys])


def bucket_as_of_join(points: DataFrame, intervals: DataFrame, point_day: str, width_days: int, start: str = "valid_from", end: str = "valid_until") -> DataFrame:
    """As-of join without an equality key: intervals are dealt to the day buckets they touch, so the join has one.

    Open ends reach to the last point's bucket; each pair is found in exactly one bucket.
    """
    no = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / width_days).cast("int")
    last = points.agg(F.max(point_day).alias("__last"))
    spans = intervals.crossJoin(F.broadcast(last)).withColumn("__stop", F.least(F.coalesce(F.date_sub(end, 1), "__last"), F.col("__last")))
    dealt = spans.filter(F.col("__stop") >= F.col(start)).withColumn("__b", F.explode(F.sequence(no(F.col(start)), no(F.col("__stop"))))).drop("__stop", "__last")
    return points.withColumn("__b", no(F.col(point_day))).join(dealt, "__b").filter(covers(F.col(point_day), F.col(start), F.col(end))).drop("__b")


def overlap_pairs(a: DataFrame, b: DataFrame, keys: list[str], a_id: str, b_id: str, start: str = "start", end: str = "end") -> DataFrame:
    """Pairs of closed ranges (dates or numbers) of the same key that overlap.

    Ranges are dealt to the buckets that they touch, as wide as the mean
    length; a pair is found in the first bucket that both touch, so a key with
    many ranges is many small groups.
    """
    number = lambda c, rows: F.datediff(c, F.lit("1970-01-01").cast("date")) if dict(rows.dtypes)[c] in ("date", "timestamp") else F.col(c)
    sized = lambda rows: rows.select((number(end, rows) - number(start, rows) + 1).cast("double").alias("n"))
    width = max(1.0, sized(a).unionByName(sized(b)).agg(F.avg("n").alias("n")).first()["n"] or 1.0)

    def dealt(rows: DataFrame, ident: str, side: str, name: str) -> DataFrame:
        no = lambda c: F.floor(number(c, rows) / width).cast("bigint")
        kept = rows.filter(F.col(start) <= F.col(end)).select(*keys, F.col(ident).alias(name), F.col(start).alias(f"s{side}"), F.col(end).alias(f"e{side}"), no(start).alias(f"f{side}"), no(end).alias("__last"))
        return kept.withColumn("__b", F.explode(F.sequence(f"f{side}", "__last"))).drop("__last")

    x, y = dealt(a, a_id, "1", "left_id"), dealt(b, b_id, "2", "right_id")
    return x.join(y, [*keys, "__b"]).filter("s1 <= e2 and s2 <= e1 and __b = greatest(f1, f2)").select(*keys, "left_id", "right_id")


def proved_stretches(intervals: DataFrame, key: str, label: str) -> DataFrame:
    """``(key, label, valid_from, valid_until)``: the stretches of a key that one label only covers; those of a key don't overlap.

    Null labels don't count, and intervals without a day cover nothing.
    """
    known = intervals.filter(F.col(label).isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_until").isNull() | (F.col("valid_from") < F.col("valid_until"))))
    own = sweep(known.select(key, label, "valid_from", "valid_until").repartition(key), [key, label]).drop("n")  # dealt once for all steps
    one = sweep(own, [key]).filter("n = 1").select(F.col(key).alias("__k"), F.col("valid_from").alias("__f"), F.col("valid_until").alias("__u"))
    # a stretch of one label may hold several pieces, as one label follows another
    meet = (F.col(key) == F.col("__k")) & (F.col("__u").isNull() | (F.col("valid_from") < F.col("__u"))) & (F.col("valid_until").isNull() | (F.col("__f") < F.col("valid_until")))
    return own.join(one, meet).select(key, label, F.greatest("valid_from", "__f").alias("valid_from"), F.least("valid_until", "__u").alias("valid_until"))


def proved_label(facts: DataFrame, intervals: DataFrame, key: str, day: str, label: str) -> DataFrame:
    """The only label that covers a fact's day; null where none or several do, or the key is unknown.

    It depends on key and day only, so it is settled among the intervals first
    and facts are shuffled once, by their key.
    """
    return as_of_join(facts, proved_stretches(intervals, key, label), [key], day, how="left").drop("valid_from", "valid_until")


def coalesce_intervals(rows: DataFrame, keys: list[str], label: str, start: str = "valid_from", end: str = "valid_until") -> DataFrame:
    """Adjacent intervals of equal label become one (gaps and islands)."""
    w = Window.partitionBy(*keys).orderBy(start)
    prev_end, prev_label = F.lag(F.coalesce(end, F.lit(FAR).cast("date"))).over(w), F.lag(label).over(w)
    new = F.when(prev_end.eqNullSafe(F.col(start)) & prev_label.eqNullSafe(F.col(label)), 0).otherwise(1)
    island = F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = rows.withColumn("__new", new).withColumn("__island", island)
    far = F.max(F.coalesce(end, F.lit(FAR).cast("date")))
    return marked.groupBy(*keys, label, "__island").agg(F.min(start).alias(start), F.nullif(far, F.lit(FAR).cast("date")).alias(end)).drop("__island")


def fill_stretches(memberships: DataFrame, mandates: DataFrame, keys: list[str], label: str, gap_label: str) -> DataFrame:
    """Memberships clipped to their mandate, handover days to the newer one, days without any labelled ``gap_label``.

    ``memberships`` have closed days ``first, last`` (last null = open);
    ``mandates`` have ``m_from, m_last``. Equal records count once.
    """
    one = memberships.select(*keys, label, "first", "last").distinct()
    starts = one.select(*keys, F.col("first").alias("__s"), F.col(label).alias("__l"), F.col("last").alias("__e"))
    cond = one["last"] == starts["__s"]
    for k in keys:
        cond = cond & (one[k] == starts[k])
    cond = cond & ~((one[label] == starts["__l"]) & (one["first"] == starts["__s"]) & one["last"].eqNullSafe(starts["__e"]))
    handed = one.join(starts, cond, "left_semi").withColumn("__hand", F.lit(True))
    rest = one.join(starts, cond, "left_anti").withColumn("__hand", F.lit(False))
    until = F.when(F.col("__hand"), F.col("last")).otherwise(F.date_add("last", 1))
    m_until = F.date_add("m_last", 1)
    clipped = (
        handed.unionByName(rest)
        .join(mandates, keys)
        .withColumn("valid_from", F.greatest("first", "m_from"))
        .withColumn("valid_until", F.least(until, m_until))
        .filter("valid_until is null or valid_from < valid_until")
    )
    w = Window.partitionBy(*keys).orderBy("valid_from")
    far = F.lit(FAR).cast("date")
    before = F.coalesce(F.max(F.coalesce("valid_until", far)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("m_from"))
    gaps = clipped.withColumn("__b", before).filter(F.col("__b") < F.col("valid_from")).select(*keys, F.lit(gap_label).alias(label), F.col("__b").alias("valid_from"), F.col("valid_from").alias("valid_until"))
    ends = clipped.groupBy(*keys).agg(F.max(F.coalesce("valid_until", far)).alias("__b"))
    tail = mandates.join(ends, keys, "left").withColumn("valid_from", F.coalesce("__b", "m_from")).withColumn("valid_until", m_until)
    tail = tail.filter((F.col("valid_from") < F.coalesce("valid_until", far))).select(*keys, F.lit(gap_label).alias(label), "valid_from", "valid_until")
    rows = clipped.select(*keys, label, "valid_from", "valid_until").unionByName(gaps).unionByName(tail)
    return coalesce_intervals(rows, keys, label)


def hand_over(rows: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Each interval that starts on the last day of another of the same key takes that day from one leaver; leavers in id order.

    ``rows`` are last stretches of mandates with first days: the n-th leaver of
    a day meets the n-th starter, if there is one.
    """
    last_day = F.date_sub("valid_until", 1)
    leavers = rows.filter(F.col("valid_until").isNotNull() & (last_day != F.col("valid_from"))).withColumn("__d", last_day)
    leavers = leavers.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys, "__d").orderBy(ident)))
    starters = rows.groupBy(*keys, F.col("valid_from").alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    moved = leavers.join(starters, [*keys, "__d"]).filter("__rn <= __n").select(ident, *keys, "valid_from", F.col("__d").alias("__new"))
    out = rows.join(moved, [ident, *keys, "valid_from"], "left")
    return out.withColumn("valid_until", F.coalesce("__new", "valid_until")).drop("__new")


def sweep(intervals: DataFrame, keys: list[str], start: str = "valid_from", end: str = "valid_until") -> DataFrame:
    """``(keys, n, valid_from, valid_until)``: how many intervals cover each stretch, run-length compressed, empty stretches left out."""
    both = F.explode(F.array(F.struct(F.col(start).alias("d"), F.lit(1).alias("s")), F.struct(F.col(end).alias("d"), F.lit(-1).alias("s"))))
    each = intervals.select(*keys, both.alias("e")).select(*keys, "e.d", "e.s").filter("s = 1 or d is not null")
    steps = each.groupBy(*keys, "d").agg(F.sum("s").alias("s")).filter("s <> 0")
    w = Window.partitionBy(*keys).orderBy("d")
    level = steps.withColumn("n", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("valid_until", F.lead("d").over(w))
    checked = level.withColumn("n", F.when(F.col("n") < 0, F.raise_error(F.lit("an interval ends before it starts")).cast("bigint")).otherwise(F.col("n")))
    return checked.filter("n > 0").select(*keys, "n", F.col("d").alias("valid_from"), "valid_until")


def peaks(levels: DataFrame, keys: list[str]) -> DataFrame:
    """The highest level of each key and the first day it is reached."""
    return levels.groupBy(*keys).agg(F.max("n").alias("peak"), F.max_by("valid_from", F.struct(F.col("n"), (-F.unix_date("valid_from")).alias("d"))).alias("first_day"))


def next_interval(intervals: DataFrame, keys: list[str], today: Column) -> DataFrame:
    """State against ``today``: the running interval, else the next one, else none."""
    run = covers(today, F.col("valid_from"), F.col("valid_until"))
    return intervals.groupBy(*keys).agg(F.bool_or(run).alias("r"), F.min(F.when(F.col("valid_from") > today, F.col("valid_from"))).alias("next_from")).select(
        *keys, F.when(F.col("r"), "running").when(F.col("next_from").isNotNull(), "next").otherwise("none").alias("state"), "next_from"
    )
