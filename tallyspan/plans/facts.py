"""Period facts: metrics observed per period, judged against strictly earlier periods, gated and ranked."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.operators import periods, plurality, quality
from tallyspan.plans import bindings as B
from tallyspan.plans.aggregates import COVERS, STATES
from tallyspan.plans.registry import query
from tallyspan.session import materialize
from tallyspan.tables import table

WEEK_SPEC = periods.MetricSpec("closest_margin", direction="min", min_history=2, tie_rank=1)


@query("""with d as (select strftime(ts, '%Y-%m-%d') as id, strftime(ts, '%G-W%V') as period, count(*) filter (event_type = 'purchase') as p, count(*) filter (event_type = 'view') as v from events group by 1, 2),
c as (select period, id, abs(p - v) / (p + v)::double as m from d where p + v > 0), w as (select period, count(*) as days from d group by 1),
o as (select period, case when days = 7 then (select min(m) from c where c.period = w.period) end as value, (select id from c where c.period = w.period order by m, id limit 1) as cited from w),
b as (select a.period, count(b.value) as n, count(*) filter (a.value < b.value) as k from o a left join o b on b.period < a.period group by 1),
f as (select o.period, value, cited, n as base_n, case when n >= 2 then 'term' else 'all' end as base_kind, case when value is not null and n > 0 then k / n::double end as percentile from o join b on o.period = b.period),
g as (select *, case when value is null then 'no_observation' when base_n < 2 or percentile is null then 'not_comparable' when percentile < 0.5 then 'below_floor' end as withheld from f)
select period, round(value, 9) as value, cited, base_kind, base_n, round(percentile, 9) as percentile, withheld, case when withheld is null then 1::bigint end as rank from g""")
def facts_event_weeks(spark, d):
    e = table(spark, d, "events").withColumn("period", S.iso_week("ts"))
    days = e.groupBy("period", F.date_format("ts", "yyyy-MM-dd").alias("id")).agg(F.count_if(F.col("event_type") == "purchase").alias("p"), F.count_if(F.col("event_type") == "view").alias("v"))
    candidates = days.select("period", "id", S.margin("p", "v").alias("value"))
    weeks = days.groupBy("period").agg((F.count(F.lit(1)) == 7).alias("complete"))
    weeks = weeks.withColumn("period_no", F.col("period")).withColumn("term", F.substring("period", 1, 4))
    out = periods.compute_facts({"closest_margin": candidates}, [WEEK_SPEC], weeks)
    return out.select("period", F.round("value", 9).alias("value"), "cited", "base_kind", F.col("base_n").cast("bigint").alias("base_n"), F.round("percentile", 9).alias("percentile"), "withheld", F.col("rank").cast("bigint").alias("rank"))


SPECS = [
    periods.MetricSpec("largest_order", min_history=6, tie_rank=1),
    periods.MetricSpec("closest_margin", direction="min", min_history=8, tie_rank=2),
    periods.MetricSpec("busiest_customer", aggregation="grouped_extreme", min_history=6, tie_rank=3, min_value=4),
    periods.MetricSpec("first_orders", aggregation="count", min_history=12, tie_rank=4),
    periods.MetricSpec("longest_shipping", min_history=6, tie_rank=5),
    periods.MetricSpec("most_parts", min_history=6, tie_rank=6, requires_topic=True),
    periods.MetricSpec("most_deviators", min_history=6, tie_rank=7, min_value=3),
    periods.MetricSpec("most_discussed", aggregation="grouped_extreme", min_history=6, tie_rank=8),
]

#: The lead part of an order: a promoted one first, then the lowest key; parts of size 1 to 9 have no title.
LEAD = """leads as (select l_orderkey, min_by(title, (case when p_type like 'PROMO%' then 0 else 1 end, p_partkey)) as topic
 from (select l_orderkey, p_partkey, p_type, case when p_size >= 10 then trim(p_name) end as title from lineitem join part on l_partkey = p_partkey) where coalesce(title, '') <> '' group by 1)"""
#: The brand of an order that is about one brand only; promoted parts count only where nothing else is there.
SINGLE = """own as (select distinct l_orderkey, p_brand, p_type like 'PROMO%' as minor from lineitem join part on l_partkey = p_partkey),
heard as (select l_orderkey, p_brand from own where not minor union select l_orderkey, p_brand from own where l_orderkey not in (select l_orderkey from own where not minor)),
single as (select l_orderkey, min(p_brand) as brand from heard group by 1 having count(*) = 1)"""
VOTES = f"""per_vote as (select vote, bool_and(state = 'complete') as ok, cast(sum(n_deviators) as bigint) as n from groups group by vote),
voted as (select vote, strftime(max(l_shipdate), '%Y-%m') as period from latest group by vote),
counted as (select voted.period, cover.vote, case when ok and covers then n end as n from cover join per_vote on cover.vote = per_vote.vote join voted on cover.vote = voted.vote)"""

MONTH_FACTS = STATES + ", " + COVERS + ", " + VOTES + ", " + LEAD + ", " + SINGLE + """,
o as (select *, strftime(o_orderdate, '%Y-%m') as period from orders),
m as (select period, cast(left(period, 4) as bigint) as term, count(distinct o_orderdate) >= 28 as complete from o group by 1),
days as (select period, o_orderdate, count(*) filter (o_orderstatus = 'F') as f, count(*) filter (o_orderstatus = 'O') as p from o group by 1, 2),
obs as (
 select 'largest_order' as metric_id, 'max' as direction, 6 as least, 1 as tie_rank, null::double as min_value, false as needs, period, max(round(o_totalprice * 100)) as value, null as topic from o group by period
 union all select 'closest_margin', 'min', 8, 2, null, false, period, min(abs(f - p) / (f + p)::double), null from days where f + p > 0 group by period
 union all select 'busiest_customer', 'max', 6, 3, 4, false, period, max(n), null from (select period, o_custkey, count(*) as n from o group by 1, 2) group by period
 union all select 'first_orders', 'max', 12, 4, null, false, m.period, (select count(*) from (select o_custkey, min_by(period, (o_orderdate, o_orderkey)) as period from o group by 1) x where x.period = m.period), null from m
 union all select 'longest_shipping', 'max', 6, 5, null, false, period, max(date_diff('day', o_orderdate, l_shipdate)), null from o join lineitem on o_orderkey = l_orderkey group by period
 union all select 'most_parts', 'max', 6, 6, null, true, period, max(n), nullif(max_by(coalesce(topic, ''), (n, -o_orderkey)), '') from (select period, o_orderkey, count(*) as n from o join lineitem on o_orderkey = l_orderkey group by 1, 2) x left join leads on x.o_orderkey = leads.l_orderkey group by period
 union all select 'most_deviators', 'max', 6, 7, 3, false, period, max(n), null from counted where n is not null group by period
 union all select 'most_discussed', 'max', 6, 8, null, false, period, max(n), null from (select period, brand, count(*) as n from o join single on o_orderkey = single.l_orderkey join lineitem on lineitem.l_orderkey = o_orderkey group by 1, 2) group by period),
k as (select distinct metric_id, direction, least, tie_rank, min_value, needs from obs),
v as (select k.*, m.period, m.term, obs.topic, case when complete then value end as value from k cross join m left join obs on obs.period = m.period and obs.metric_id = k.metric_id),
b as (select a.metric_id, a.period, count(b.value) as n_all, count(b.value) filter (b.term = a.term) as n_term,
 count(*) filter (case when a.direction = 'max' then a.value > b.value else a.value < b.value end) as k_all,
 count(*) filter (b.term = a.term and case when a.direction = 'max' then a.value > b.value else a.value < b.value end) as k_term
 from v a left join v b on a.metric_id = b.metric_id and b.period < a.period group by 1, 2),
f as (select v.*, n_term >= least as own, case when n_term >= least then n_term else n_all end as base_n, case when n_term >= least then k_term else k_all end as k from v join b on v.metric_id = b.metric_id and v.period = b.period),
g as (select *, case when value is not null and base_n > 0 then k / base_n::double end as percentile from f)"""
REASON = """case when value is null then 'no_observation' when base_n < least or percentile is null then 'not_comparable' when min_value is not null and value < min_value then 'below_min_value'
 when needs and topic is null then 'no_topic' when percentile < {floor} then 'below_floor' end"""


def order_grain(spark, d):
    """One narrow row for each order: its period, lines, longest shipping, lead title and only brand, from one pass over the lines."""
    o = table(spark, d, "orders")
    part = table(spark, d, "part").select("p_partkey", "p_brand", F.when((F.col("p_size") >= 10) & (F.trim("p_name") != ""), F.trim("p_name")).alias("title"), F.col("p_type").startswith("PROMO").alias("minor"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate").join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    place = F.struct(F.when(F.col("minor"), 0).otherwise(1).alias("order_no"), F.col("p_partkey").alias("p_partkey"))
    own = F.when(~F.col("minor"), F.col("p_brand"))
    per = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("l_shipdate").alias("shipped"), F.min_by("title", F.when(F.col("title").isNotNull(), place)).alias("topic"),
        F.min(own).alias("__own_a"), F.max(own).alias("__own_z"), F.min("p_brand").alias("__all_a"), F.max("p_brand").alias("__all_z"),
    )
    only = F.when(F.col("__own_a").isNotNull(), F.when(F.col("__own_a") == F.col("__own_z"), F.col("__own_a"))).when(F.col("__all_a") == F.col("__all_z"), F.col("__all_a"))
    per = per.select("l_orderkey", "n_lines", "shipped", "topic", only.alias("brand"))
    joined = o.join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return materialize(
        joined.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("period"), "n_lines", F.datediff("shipped", "o_orderdate").alias("days"), "topic", "brand"),
        "order-grain",
    )


def month_facts(spark, d, floor: float = 0.5):
    o = order_grain(spark, d)
    months = o.groupBy("period").agg((F.count_distinct("o_orderdate") >= 28).alias("complete"))
    months = materialize(months.withColumn("period_no", F.col("period")).withColumn("term", F.substring("period", 1, 4).cast("bigint")), "months")
    days = o.groupBy("period", F.date_format("o_orderdate", "yyyy-MM-dd").alias("id")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("p"))
    first = o.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey", "period")).alias("x")).select("x.period", F.col("x.o_orderkey").alias("o_orderkey"))
    key = F.col("o_orderkey").cast("string").alias("id")
    tally = materialize(plurality.tally_of(B.latest(spark, d), "vote", plurality.MEASURES, F.min("member").alias("pos"), F.max("l_shipdate").alias("shipped")), "tally")
    vote = F.col("vote")
    own = {m: F.col(f"m_{m}") for m in plurality.MEASURES}
    counts = tally.filter(~((vote % 11 == 0) & (F.col("grp") == "G2"))).select("vote", "grp", *[(c + F.when(vote % 7 == 0, 1).otherwise(0) if m == "yes" else c).alias(m) for m, c in own.items()], "pos")
    totals = tally.groupBy("vote").agg(*[F.sum(c).alias(m) for m, c in own.items()], F.date_format(F.max("shipped"), "yyyy-MM").alias("period"))
    voted = totals.select("vote", "period")
    cover = plurality.covers_total(counts, totals.withColumn("yes", F.when(vote % 13 != 0, F.col("yes"))).drop("period"), "vote")
    deviators = plurality.deviator_count(plurality.tallied_deviators(tally.drop("pos", "shipped"), counts, "vote", ("G4",)), cover, "vote")
    candidates = {
        "largest_order": o.select("period", key, F.round(F.col("o_totalprice") * 100).alias("value")),
        "closest_margin": days.select("period", "id", S.margin("f", "p").alias("value")),
        "busiest_customer": o.select("period", F.col("o_custkey").cast("string").alias("group_id"), F.lit(1).alias("value"), key, F.round(F.col("o_totalprice") * 100).alias("tie_value")),
        "first_orders": first.select("period", key, F.lit(1).alias("value")),
        "longest_shipping": o.select("period", key, F.col("days").alias("value")),
        "most_parts": o.select("period", key, F.col("n_lines").alias("value"), "topic"),
        "most_deviators": deviators.join(voted, "vote").select("period", F.col("vote").cast("string").alias("id"), F.col("n_deviators").alias("value")),
        "most_discussed": o.filter("brand is not null").select("period", F.col("brand").alias("group_id"), F.col("n_lines").alias("value"), key),
    }
    return periods.compute_facts(candidates, SPECS, months, floor)


@query("""with o as (select strftime(o_orderdate, '%Y-%m') as period, o_custkey, count(*) as n, sum(round(o_totalprice * 100)) as cents from orders group by 1, 2)
select period, max(n)::double as value, cast(min_by(o_custkey, (-n, -cents, o_custkey)) as varchar) as cited from o group by 1""")
def m7_busiest_by_value(spark, d):
    """Who ordered most often in a month; of equals the one that ordered for more, then the lowest key."""
    rows = order_rows(spark, d)
    return periods.observe(rows, SPECS[2], rows.select("period").distinct()).select("period", "value", "cited")


def order_rows(spark, d):
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_custkey").cast("string").alias("group_id"), F.lit(1).alias("value"), F.round(F.col("o_totalprice") * 100).alias("tie_value"))
    return o.withColumn("id", F.col("group_id"))


SITTING_SPEC = periods.MetricSpec("longest_sitting", min_history=2, tie_rank=1)


@query("""with d as (select strftime(ts, '%Y-%m-%d') as id, strftime(ts, '%G-W%V') as period, min(ts) as a, max(event_id) as k, count(*) as n from events group by 1, 2),
c as (select period, id, case when k % 7 > 0 then (k * 37 % 1440 - (date_part('hour', a) * 60 + date_part('minute', a)) + 1440) % 1440 end as m from d),
o as (select period, case when count(*) = 7 then max(m) end as value, min_by(id, (-m, id)) filter (m is not null) as cited from c group by 1),
b as (select a.period, count(b.value) as n, count(*) filter (a.value > b.value) as k from o a left join o b on b.period < a.period group by 1),
f as (select o.period, value, cited, n, case when value is not null and n > 0 then k / n::double end as percentile from o join b on o.period = b.period),
g as (select *, case when value is null then 'no_observation' when n < 2 or percentile is null then 'not_comparable' when percentile < 0.5 then 'below_floor' end as withheld from f)
select period, cast(value as double) as value, cited, n as base_n, round(percentile, 9) as percentile, withheld from g""")
def m5_longest_sitting(spark, d):
    """The longest day of a week, from clock times that may wrap past midnight; days without an end are no observation."""
    e = table(spark, d, "events").withColumn("period", S.iso_week("ts"))
    days = e.groupBy("period", F.date_format("ts", "yyyy-MM-dd").alias("id")).agg(F.min("ts").alias("a"), F.max("event_id").alias("k"))
    end = F.pmod(F.col("k") * 37, F.lit(1440))
    clock = F.when(F.col("k") % 7 > 0, F.concat(F.floor(end / 60).cast("string"), F.lit(":"), F.lpad((end % 60).cast("string"), 2, "0")))
    candidates = days.select("period", "id", S.clock_minutes(F.date_format("a", "H:mm"), clock).alias("value"))
    weeks = days.groupBy("period").agg((F.count(F.lit(1)) == 7).alias("complete")).withColumn("period_no", F.col("period")).withColumn("term", F.substring("period", 1, 4))
    out = periods.compute_facts({"longest_sitting": candidates}, [SITTING_SPEC], weeks)
    return out.select("period", "value", "cited", F.col("base_n").cast("bigint").alias("base_n"), F.round("percentile", 9).alias("percentile"), "withheld")


@query(f"""with {MONTH_FACTS}, h as (select *, {REASON.format(floor=0.5)} as withheld from g)
select metric_id, period, round(value, 9) as value, case when own then 'term' else 'all' end as base_kind, base_n, round(percentile, 9) as percentile, withheld,
case when withheld is null then row_number() over (partition by period, withheld is null order by percentile desc, tie_rank) end as rank from h""")
def facts_order_months(spark, d):
    out = month_facts(spark, d)
    return out.select("metric_id", "period", F.round("value", 9).alias("value"), "base_kind", F.col("base_n").cast("bigint").alias("base_n"), F.round("percentile", 9).alias("percentile"), "withheld", F.col("rank").cast("bigint").alias("rank"))


@query(f"""with {MONTH_FACTS}, fl as (select unnest([0.25, 0.5, 0.75])::double as floor), h as (select fl.floor, metric_id, {REASON.format(floor="fl.floor")} as withheld from g, fl)
select floor, metric_id, count(*) filter (withheld is null) as posted, count(*) filter (withheld = 'below_floor') as below_floor, count(*) as n from h group by 1, 2""")
def x19_floor_replay(spark, d):
    floors = spark.createDataFrame([(0.25,), (0.5,), (0.75,)], "floor double")
    rows = month_facts(spark, d).drop("withheld", "rank").crossJoin(F.broadcast(floors))  # three rows
    marked = rows.withColumn("withheld", periods.withheld_reason(F.col("floor"), "topic"))
    return marked.groupBy("floor", "metric_id").agg(F.count_if(F.col("withheld").isNull()).alias("posted"), F.count_if(F.col("withheld") == "below_floor").alias("below_floor"), F.count(F.lit(1)).alias("n"))


@query("""with o as (select *, strftime(o_orderdate, '%Y-%m') as period from orders), top as (select period, max(o_totalprice) as v from o group by 1)
select o.period, o_orderkey, row_number() over (partition by o.period order by o_orderkey) as receipt from o join top on o.period = top.period and o_totalprice = v""")
def c14_receipts(spark, d):
    o = table(spark, d, "orders").withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    top = o.groupBy("period").agg(F.max("o_totalprice").alias("o_totalprice"))
    return quality.receipts(top, o, ["period", "o_totalprice"], F.col("o_orderkey")).select("period", "o_orderkey", F.col("receipt").cast("bigint").alias("receipt"))


@query(f"""with {MONTH_FACTS} select metric_id, min(period) filter (value is not null) as first_period, max(period) filter (value is not null) as last_period, count(value) as n_observed,
'seit ' || coalesce(min(period) filter (value is not null), '?') || ': ' || count(value) || ' Monate' as wording from g group by 1""")
def x17_baseline_wording(spark, d):
    g = month_facts(spark, d).groupBy("metric_id").agg(F.min(F.when(F.col("value").isNotNull(), F.col("period"))).alias("first_period"), F.max(F.when(F.col("value").isNotNull(), F.col("period"))).alias("last_period"), F.count("value").alias("n_observed"))
    return g.withColumn("wording", F.concat(F.lit("seit "), F.coalesce("first_period", F.lit("?")), F.lit(": "), F.col("n_observed").cast("string"), F.lit(" Monate")))
