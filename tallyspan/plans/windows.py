"""Windows and histories: first events, strict-prior baselines, intervals, sweeps, turns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.operators import histories, intervals, periods, ranking
from tallyspan.plans import bindings as B
from tallyspan.plans.registry import query
from tallyspan.tables import table

MONTHS = """months as (select strftime(o_orderdate, '%Y-%m') as month, year(o_orderdate) as term, max(round(o_totalprice * 100))::bigint as v, count(*) as n from orders group by 1, 2),
hist as (select *, n >= 3 as ok from months)"""
PRIOR = f"""{MONTHS}, same as (select a.month, count(*) as n, count(*) filter (a.v > b.v) as k from hist a join hist b on b.month < a.month and b.ok and b.term = a.term group by 1),
allp as (select a.month, count(*) as n, count(*) filter (a.v > b.v) as k from hist a join hist b on b.month < a.month and b.ok group by 1),
base as (select h.*, coalesce(s.n, 0) >= 6 as own, case when coalesce(s.n, 0) >= 6 then s.n else coalesce(p.n, 0) end as base_n, case when coalesce(s.n, 0) >= 6 then s.k else p.k end as beaten
 from hist h left join same s on h.month = s.month left join allp p on h.month = p.month)"""


def _months(spark, d):
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.year("o_orderdate").alias("term")).agg(
        F.max(F.round(F.col("o_totalprice") * 100)).cast("bigint").alias("v"), F.count(F.lit(1)).alias("n")
    )


def _baselines(spark, d):
    usable = F.col("n") >= 3
    return periods.strict_prior(_months(spark, d).withColumn("all", F.lit(0)), ["all"], "month", "v", "term", usable, F.lit("max"), F.lit(6))


@query("""with f as (select o_custkey, o_orderkey, o_orderdate, o_orderstatus from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1)
select o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from f where o_orderstatus <> 'P'""")
def w1_first_event(spark, d):
    first = ranking.first_rows(table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.filter("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(f"""with {PRIOR} select month, v, case when own then 'term' else 'all' end as base_kind, base_n, ok and base_n >= 6 as eligible from base""")
def w2_strict_prior_baseline(spark, d):
    return _baselines(spark, d).select("month", "v", "base_kind", F.col("base_n").cast("bigint").alias("base_n"), "eligible")


@query(f"""with {PRIOR} select month, round(case when ok and base_n > 0 then beaten / base_n::double end, 9) as percentile, cast(floor(case when ok and base_n > 0 then beaten / base_n::double end * 100 + 1e-9) as int) as percent from base""")
def w3_percentile(spark, d):
    out = _baselines(spark, d)
    return out.select("month", F.round("percentile", 9).alias("percentile"), S.floor_percent("percentile").alias("percent"))


@query("""with s as (select distinct o_orderkey as unit, strftime(o_orderdate, '%G-W%V') as period from orders where o_orderkey % 9 <> 0), e as (select distinct l_orderkey as unit, strftime(o_orderdate, '%G-W%V') as period from lineitem join orders on l_orderkey = o_orderkey)
select coalesce(s.period, e.period) as period, count(s.unit) as n_stored, count(e.unit) as n_expected, count(*) filter (s.unit is null) as n_missing, count(*) filter (e.unit is null) as n_stale from s full join e on s.unit = e.unit and s.period = e.period group by 1""")
def w6_periods_of_union(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit"), S.iso_week("o_orderdate").alias("period"))
    have = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit"))
    return periods.periods_of(o.filter("unit % 9 <> 0"), o.join(have, "unit", "left_semi"))


@query("""with c as (select strftime(o_orderdate, '%Y-%m') as period, o_custkey as grp, count(*) as n, cast(sum(round(o_totalprice * 100)) as bigint) as cents from orders group by 1, 2)
select period, n as value, cents as denominator, cast(grp as varchar) as cited from c qualify row_number() over (partition by period order by n desc, grp) = 1""")
def w7_grouped_extreme(spark, d):
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_custkey").alias("group_id"), F.lit(1).alias("value"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("denominator"))
    spec = periods.MetricSpec("busiest", aggregation="grouped_extreme")
    out = periods.observe(o, spec, o.select("period").distinct())
    return out.select("period", F.col("value").cast("bigint").alias("value"), "denominator", F.col("cited").cast("string").alias("cited"))


@query("""with w as (select distinct user_id, strftime(ts, '%G-W%V') as week from events where event_type = 'purchase'), l as (select max(week) as week from w)
select user_id, count(*) filter (week < (select week from l)) as earlier_weeks from w group by 1 having count(*) filter (week = (select week from l)) > 0 and count(*) filter (week < (select week from l)) > 0""")
def w8_returning(spark, d):
    w = table(spark, d, "events").filter("event_type = 'purchase'").select("user_id", S.iso_week("ts").alias("week")).distinct()
    return histories.returning(w, "user_id", "week").select("user_id", F.col("n_earlier").alias("earlier_weeks"))


@query("""with recursive w as (select distinct user_id, strftime(ts, '%G-W%V') as week from events where event_type = 'purchase'), l as (select max(week) as week from w),
back as (select user_id, count(*) filter (week < (select week from l)) as earlier from w group by 1 having count(*) filter (week = (select week from l)) > 0 and count(*) filter (week < (select week from l)) > 0),
tw as (select a.user_id as src, list(distinct b.user_id) as dst from events a join events b on b.event_id = a.event_id + 1 and a.user_id <> b.user_id group by 1),
r as (select user_id, earlier, row_number() over (order by earlier desc, user_id) as i, coalesce(dst, []) as dst from back left join tw on src = user_id),
g(i, dropped, kept) as (select 0::bigint, []::bigint[], []::bigint[] union all
 select g.i + 1, case when list_contains(dropped, user_id) then dropped else dropped || dst end, case when list_contains(dropped, user_id) then kept else kept || [user_id] end from g join r on r.i = g.i + 1)
select user_id, earlier as earlier_weeks from back where user_id in (select unnest(kept) from (select kept from g order by i desc limit 1))""")
def w8_twin_suppression(spark, d):
    """Returning users; one who follows a kept user before them in the log counts as that user's twin."""
    e = table(spark, d, "events")
    w = e.filter("event_type = 'purchase'").select("user_id", S.iso_week("ts").alias("week")).distinct()
    back = histories.returning(w, "user_id", "week").withColumn("rank", -F.col("n_earlier"))
    after = e.select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("dst"))
    twins = e.select("event_id", F.col("user_id").alias("src")).join(after, "event_id").filter("src <> dst")
    return histories.suppress_twins(back, "user_id", ["rank", "user_id"], twins).select("user_id", F.col("n_earlier").alias("earlier_weeks"))


@query("""with m as (select distinct strftime(o_orderdate, '%Y-%m') as month from orders where o_orderstatus = 'F'), k as (select month from m order by month desc limit 12)
select month, count(*) as n from (select strftime(o_orderdate, '%Y-%m') as month from orders) x where month in (select month from k) group by 1""")
def w9_last_periods(spark, d):
    o = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    last = histories.last_periods(o.filter("o_orderstatus = 'F'"), "month", 12)
    return o.join(last, "month", "left_semi").groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("""with w as (select strftime(ts, '%G-W%V') as week, isodow(ts) as day, count(*) as n from events where not (weekofyear(ts) = 5 and isodow(ts) > 2) group by 1, 2),
k as (select week, count(*) as days, sum(n) as n from w group by 1), p as (select *, lag(week) over (order by week) as pw, lag(days) over (order by week) as pd, lag(n) over (order by week) as pn from k),
s as (select p.week, sum(a.n) as n, sum(b.n) as pn from p join w a on a.week = p.week join w b on b.week = p.pw and b.day = a.day group by 1)
select p.week, case when pw is null then 'none' when days = pd then 'total' when s.week is not null then 'weekdays' else 'none' end as basis, cast(case when days = pd then p.n - p.pn else s.n - s.pn end as bigint) as delta from p left join s on p.week = s.week""")
def w10_week_comparison(spark, d):
    e = table(spark, d, "events").select(S.iso_week("ts").alias("week"), F.weekofyear("ts").alias("no"), (F.weekday("ts") + 1).alias("day")).filter("not (no = 5 and day > 2)")
    return histories.week_comparison(e.groupBy("week", "day").agg(F.count(F.lit(1)).alias("n")), "week", "day", "n")


@query("""with c as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as month, pos, id from (select o_orderkey, o_orderdate, unnest([1, 2]) as pos, unnest([o_custkey, 100000 + o_custkey % 97]) as id from orders)),
f as (select a.o_orderkey, a.pos, b.month from c a join c b on a.id = b.id and b.month < a.month)
select o_orderkey, min(pos) as pos, (select min(month) from f g where g.o_orderkey = f.o_orderkey and g.pos = min(f.pos)) as month from f group by 1""")
def w11_earliest_trace(spark, d):
    o = table(spark, d, "orders")
    c = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.posexplode(F.array("o_custkey", 100000 + F.col("o_custkey") % 97)).alias("p", "id")).withColumn("pos", F.col("p") + 1)
    return histories.earliest_trace(c, "o_orderkey", "pos", "id", "month")


@query("""select l_orderkey, l_linenumber, l_partkey, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_extendedprice) as occurrence from lineitem""")
def w12_occurrence(spark, d):
    return ranking.occurrence(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", F.col("occurrence").cast("bigint").alias("occurrence"))


@query("""with t as (select conv_id, turn, role, lag(role) over w as before, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as asked from conversations window w as (partition by conv_id order by turn)),
k as (select *, case when role = 'system' then 'procedure' when role = 'user' and before = 'user' then 'follow_up' when role = 'user' then 'question' when before = 'user' then 'answer' when asked is not null then 'resumption' else 'statement' end as kind from t)
select conv_id, turn, kind, case when kind in ('answer', 'resumption') then asked end as parent, cast(sum(case when kind = 'question' then 1 else 0 end) over (partition by conv_id order by turn) as bigint) as exchange from k""")
def w13_turn_kinds(spark, d):
    return histories.turn_kinds(table(spark, d, "conversations"), "conv_id", "turn", "role")


@query(f"""with {B.VALIDITY}, m as (select *, case when lag(valid_until) over w is not distinct from valid_from and lag(label) over w is not distinct from label then 0 else 1 end as fresh from validity window w as (partition by o_custkey order by valid_from)),
i as (select *, sum(fresh) over (partition by o_custkey order by valid_from) as island from m)
select o_custkey, label, cast(min(valid_from) as varchar) as valid_from, cast(nullif(max(coalesce(valid_until, date '9999-12-31')), date '9999-12-31') as varchar) as valid_until from i group by o_custkey, label, island""")
def w14_coalesce_intervals(spark, d):
    out = intervals.coalesce_intervals(B.validity(spark, d), ["o_custkey"], "label")
    return out.select("o_custkey", "label", B.text_day("valid_from"), B.text_day("valid_until"))


@query(f"""with {B.EPISODES}, mandate as (select c_custkey as o_custkey, date '1995-06-01' as m_from, date '2000-12-31' as m_last from customer),
mem as (select distinct o_custkey, 'held' as label, start as first, stop as last from episodes where stop > start),
d as (select m.o_custkey, unnest(generate_series(m_from::timestamp, m_last::timestamp, interval 1 day))::date as day from mandate m),
l as (select d.o_custkey, d.day, case when exists (select 1 from mem where mem.o_custkey = d.o_custkey and first <= day and day <= last) then 'held' else 'free' end as label from d),
g as (select *, case when lag(label) over (partition by o_custkey order by day) is not distinct from label then 0 else 1 end as fresh from l),
i as (select *, sum(fresh) over (partition by o_custkey order by day) as island from g)
select o_custkey, label, cast(min(day) as varchar) as valid_from, cast(max(day) + 1 as varchar) as valid_until from i group by o_custkey, label, island""")
def w14_fill_stretches(spark, d):
    e = B.episodes(spark, d).filter("stop > start").select("o_custkey", F.lit("held").alias("label"), F.col("start").alias("first"), F.col("stop").alias("last"))
    flat = histories.union_of_spans(e, ["o_custkey"], "label", "first", "last")
    m = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("1995-06-01").cast("date").alias("m_from"), F.lit("2000-12-31").cast("date").alias("m_last"))
    out = intervals.fill_stretches(flat, m, ["o_custkey"], "label", "free")
    return out.select("o_custkey", "label", B.text_day("valid_from"), B.text_day("valid_until"))


@query(f"""with {B.EPISODES}, r as (select o_orderkey, o_orderpriority, start as valid_from, stop + 1 as valid_until from episodes where stop > start),
lv as (select *, valid_until - 1 as d, row_number() over (partition by o_orderpriority, valid_until order by o_orderkey) as rn from r where valid_until - 1 <> valid_from),
st as (select o_orderpriority, valid_from as d, count(*) as n from r group by 1, 2)
select r.o_orderkey, cast(r.valid_from as varchar) as valid_from, cast(coalesce(x.d, r.valid_until) as varchar) as valid_until from r left join (select lv.o_orderkey, lv.d from lv join st on lv.o_orderpriority = st.o_orderpriority and lv.d = st.d where rn <= n) x on r.o_orderkey = x.o_orderkey""")
def w15_hand_over(spark, d):
    r = B.episodes(spark, d).filter("stop > start").select("o_orderkey", "o_orderpriority", F.col("start").alias("valid_from"), F.date_add("stop", 1).alias("valid_until"))
    return intervals.hand_over(r, ["o_orderpriority"], "o_orderkey").select("o_orderkey", B.text_day("valid_from"), B.text_day("valid_until"))


SWEEP = f"""{B.EPISODES}, ev as (select o_orderpriority, start as d, 1 as s from episodes where stop > start union all select o_orderpriority, stop, -1 from episodes where stop > start),
st as (select o_orderpriority, d, sum(s) as s from ev group by 1, 2 having sum(s) <> 0),
lv as (select o_orderpriority, d, cast(sum(s) over (partition by o_orderpriority order by d) as bigint) as n, lead(d) over (partition by o_orderpriority order by d) as u from st)"""


@query(f"with {SWEEP} select o_orderpriority, n, cast(d as varchar) as valid_from, cast(u as varchar) as valid_until from lv where n > 0")
def w16_sweep_line(spark, d):
    e = B.episodes(spark, d).filter("stop > start").select("o_orderpriority", F.col("start").alias("valid_from"), F.col("stop").alias("valid_until"))
    return intervals.sweep(e, ["o_orderpriority"]).select("o_orderpriority", "n", B.text_day("valid_from"), B.text_day("valid_until"))


@query(f"with {SWEEP} select o_orderpriority, max(n) as peak, cast(min(d) filter (n = (select max(n) from lv x where x.o_orderpriority = lv.o_orderpriority)) as varchar) as first_day from lv group by 1")
def w17_peaks(spark, d):
    e = B.episodes(spark, d).filter("stop > start").select("o_orderpriority", F.col("start").alias("valid_from"), F.col("stop").alias("valid_until"))
    return intervals.peaks(intervals.sweep(e, ["o_orderpriority"]), ["o_orderpriority"]).select("o_orderpriority", "peak", B.text_day("first_day"))


@query(f"with {B.EPISODES} select strftime(start, '%G-W%V') as week, cast(min(start) as varchar) as first, cast(max(stop) as varchar) as last, count(*) as n from episodes group by 1")
def w18_week_merge(spark, d):
    g = B.episodes(spark, d).groupBy(S.iso_week("start").alias("week")).agg(F.min("start").alias("first"), F.max("stop").alias("last"), F.count(F.lit(1)).alias("n"))
    return g.select("week", B.text_day("first"), B.text_day("last"), "n")


@query(f"""with {B.EPISODES} select o_custkey, case when bool_or(start <= date '2001-06-01' and date '2001-06-01' < stop) then 'running' when max(start) > date '2001-06-01' then 'next' else 'none' end as state,
cast(min(start) filter (start > date '2001-06-01') as varchar) as next_from from episodes group by 1""")
def w19_next_interval(spark, d):
    e = B.episodes(spark, d).select("o_custkey", F.col("start").alias("valid_from"), F.col("stop").alias("valid_until"))
    return intervals.next_interval(e, ["o_custkey"], F.lit("2001-06-01").cast("date")).select("o_custkey", "state", B.text_day("next_from"))


@query("""with m as (select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders group by 1) select month, n, n - lag(n) over (order by month) as delta from m""")
def w10_deltas(spark, d):
    m = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return m.withColumn("delta", F.col("n") - F.lag("n").over(Window.orderBy("month")))
