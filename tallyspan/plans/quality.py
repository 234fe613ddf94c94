"""Completeness, quarantine, invariants and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.operators import diffs, intervals, plurality
from tallyspan.operators import quality as Q
from tallyspan.plans import bindings as B
from tallyspan.plans.aggregates import STATES
from tallyspan.plans.registry import query
from tallyspan.sources import sinks
from tallyspan.tables import table


@query("""select o_orderkey, case when o_orderstatus = 'P' then 'pending' when o_totalprice < 1500 then 'too_small' when n is null then 'no_lines' when n > 8 then 'too_many_lines' when o_orderpriority like '4%' then 'unspecified' end as reason
from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on o_orderkey = l_orderkey""")
def c1_ordered_reasons(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    x = table(spark, d, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    reason = Q.first_reason((F.col("o_orderstatus") == "P", "pending"), (F.col("o_totalprice") < 1500, "too_small"), (F.col("n").isNull(), "no_lines"), (F.col("n") > 8, "too_many_lines"), (F.col("o_orderpriority").startswith("4"), "unspecified"))
    return x.select("o_orderkey", reason.alias("reason"))


GAPS = """e as (select o_orderkey as k, strftime(o_orderdate, '%Y-%m') as period, o_orderdate as stamp from orders),
s as (select l_orderkey as k, o_orderdate + interval 1 day * (case when l_orderkey % 50 = 0 then 1 else 0 end) as stamp, case when max(l_discount) > 0.098 then 'deep_discount' end as reason from lineitem join orders on l_orderkey = o_orderkey group by l_orderkey, o_orderdate),
g as (select period, e.k, case when s.k is not null and e.stamp is distinct from s.stamp then 'changed' when s.k is null then 'not_stored' else reason end as gap from e left join s on e.k = s.k)"""


def _gaps(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_orderdate").alias("stamp"))
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_discount").alias("deep"))
    moved = F.col("stamp") + F.make_dt_interval(F.when(F.col("k") % 50 == 0, 1).otherwise(0))
    stored = li.join(o, "k").select("k", moved.alias("stamp"), F.when(F.col("deep") > 0.098, "deep_discount").alias("reason"))
    return Q.period_gaps(o, stored, "k", "period", "stamp", "reason")


@query(f"with {GAPS} select * from g")
def c2_period_gaps(spark, d):
    return _gaps(spark, d)


@query(f"with {GAPS} select period, count(*) as n, count(gap) as n_gaps, count(gap) = 0 and period <> '2001-08' as complete from g group by 1")
def c3_period_complete(spark, d):
    return Q.period_complete(_gaps(spark, d), "period", F.col("period") == "2001-08")


@query("""with b as (select least((select min(o_orderdate) from orders where o_orderstatus = 'F'), (select min(l_shipdate) from lineitem)) as lo) select o_orderkey from orders, b where o_orderdate >= lo + interval 30 day""")
def c4_judged_range(spark, d):
    o = table(spark, d, "orders")
    lo = o.filter("o_orderstatus = 'F'").agg(F.min("o_orderdate").alias("a")).crossJoin(table(spark, d, "lineitem").agg(F.min("l_shipdate").alias("b"))).select(F.least("a", "b").alias("lo"))
    return o.crossJoin(F.broadcast(lo)).filter(F.col("o_orderdate") >= F.col("lo") + F.expr("interval 30 day")).select("o_orderkey")


@query("""select l_orderkey, case when bool_and(l_linestatus = 'F') and not bool_or(l_discount > 0.0999) then 'complete' when sum((l_returnflag = 'R')::int) > 0 then 'partial' else 'failed' end as state from lineitem group by 1""")
def c6_acquisition_state(spark, d):
    x = table(spark, d, "lineitem")
    marked = x.select("l_orderkey", (F.col("l_linestatus") == "F").alias("ended"), (F.col("l_discount") > 0.0999).alias("failed"), (F.col("l_returnflag") == "R").cast("int").alias("found"))
    return Q.acquisition_state(marked, ["l_orderkey"], "ended", "failed", "found")


@query("""with st as (select l_orderkey as k, count(*) as n from lineitem where l_linenumber = 1 group by 1), src as (select distinct o_orderkey as k from orders where o_orderkey % 100 <> 5)
select coalesce(src.k, st.k) as k, case when src.k is null then 'no_source' when n is null then 'no_status' else 'several' end as problem from src full join st on src.k = st.k where src.k is null or n is null or n > 1""")
def c7_conservation(spark, d):
    src = table(spark, d, "orders").filter("o_orderkey % 100 <> 5").select(F.col("o_orderkey").alias("k"))
    st = table(spark, d, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("k"))
    return Q.conservation(src, st, "k")


@query("""select coalesce(case when value < 1 then 'tiny' when try_cast(json_extract_string(props, '$.k') as bigint) > 95 then 'out_of_range' end, 'clean') as state, count(*) as n from events group by 1""")
def c8_quarantine(spark, d):
    reason = F.when(F.col("value") < 1, "tiny").when(F.get_json_object("props", "$.k").try_cast("bigint") > 95, "out_of_range")
    clean, held = Q.split_valid(table(spark, d, "events"), reason)
    return clean.select(F.lit("clean").alias("state")).unionByName(held.select(F.col("reason").alias("state"))).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {STATES}, named as (select l.vote, l.grp, cast(sum(case when ("leading" = 'yes' and stance = 'no') or ("leading" = 'no' and stance = 'yes') then 1 else 0 end) as bigint) as n
 from latest l join groups g on l.vote = g.vote and l.grp = g.grp where state = 'complete' group by 1, 2)
select 'deviator_sum' as invariant, (select count(*) from groups join named on groups.vote = named.vote and groups.grp = named.grp where state = 'complete' and n <> n_deviators) as violations
union all select 'null_key', (select count(*) from orders where o_orderkey is null) union all select 'orphan_lines', (select count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)) union all select 'repeated_lines', (select count(*) from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1))""")
def c9_invariants(spark, d):
    latest = B.latest(spark, d)
    groups = plurality.deviators(latest, B.counts(spark, d, latest), "vote", ("G4",))
    flags = plurality.member_flags(latest, groups, "vote").groupBy("vote", "grp").agg(F.sum("deviates").alias("n"))
    off = groups.filter("state = 'complete'").join(flags, ["vote", "grp"]).filter("n <> n_deviators").agg(F.lit("deviator_sum").alias("invariant"), F.count(F.lit(1)).alias("violations"))
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    nulls = o.filter("o_orderkey is null").agg(F.lit("null_key").alias("invariant"), F.count(F.lit(1)).alias("violations"))
    orphans = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.lit("orphan_lines").alias("invariant"), F.count(F.lit(1)).alias("violations"))
    repeated = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.lit("repeated_lines").alias("invariant"), F.count(F.lit(1)).alias("violations"))
    return off.unionByName(nulls).unionByName(orphans).unionByName(repeated)


@query(f"""with {B.EPISODES}, p as (select unnest(generate_series(timestamp '1996-01-01', timestamp '2000-12-01', interval 3 month))::date as day),
a as (select day, o_orderpriority, count(*) as n from p join episodes on start <= day and day < stop group by 1, 2), b as (select day, o_orderpriority, count(*) as n from p join (select * from episodes where o_orderkey % 200 <> 1) e on start <= day and day < stop group by 1, 2)
select cast(a.day as varchar) as day, a.o_orderpriority, a.n as counted, b.n as reported, case when a.n = b.n then 'same' when a.n - b.n = 1 then 'off_by_one' when b.n is null then 'unreported' else 'differs' end as cause from a left join b on a.day = b.day and a.o_orderpriority = b.o_orderpriority""")
def c10_cross_check(spark, d):
    p = spark.range(1).select(F.explode(F.sequence(F.lit("1996-01-01").cast("date"), F.lit("2000-12-01").cast("date"), F.expr("interval 3 month"))).alias("day"))
    e = B.episodes(spark, d).filter("start < stop").select("o_orderkey", "o_orderpriority", F.col("start").alias("valid_from"), F.col("stop").alias("valid_until"))
    per = lambda x, n: intervals.bucket_as_of_join(p, x, "day", 90).groupBy("day", "o_orderpriority").agg(F.count(F.lit(1)).alias(n))
    both = per(e, "counted").join(per(e.filter("o_orderkey % 200 <> 1"), "reported"), ["day", "o_orderpriority"], "left")
    gap = F.col("counted") - F.col("reported")
    cause = F.when(gap == 0, "same").when(gap == 1, "off_by_one").when(F.col("reported").isNull(), "unreported").otherwise("differs")
    return both.select(B.text_day("day"), "o_orderpriority", "counted", "reported", cause.alias("cause"))


@query("""with b as (select distinct o_custkey from orders where o_orderstatus = 'F' and o_totalprice > 400000), n as (select distinct o_custkey from orders where o_orderstatus = 'P' and o_totalprice > 400000)
select count(*) as newly_withheld, count(*) <= 5 as passes from n where o_custkey not in (select o_custkey from b)""")
def c11_release_gate(spark, d):
    o = table(spark, d, "orders").filter("o_totalprice > 400000")
    return Q.release_gate(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'"), "o_custkey", 5)


@query("""with p as (select distinct l_orderkey, l_linenumber % 3 as slot from lineitem), r as (select distinct o_orderkey, 1 as slot from orders) select coalesce(l_orderkey, o_orderkey) as k, coalesce(p.slot, r.slot) as slot, case when l_orderkey is null then 'missing' else 'unexpected' end as change
from p full join r on l_orderkey = o_orderkey and p.slot = r.slot where l_orderkey is null or o_orderkey is null""")
def c12_placement(spark, d):
    p = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") % 3).alias("slot")).distinct()
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("slot")).distinct()
    out = diffs.diff(p, r, ["k", "slot"], [])
    return out.select("k", "slot", F.when(F.col("change") == "added", "missing").otherwise("unexpected").alias("change"))


@query("""select d.doc_id, case when l.doc_id is null then 'missing' else 'stale' end as state from documents d left join labels l on d.doc_id = l.doc_id where l.doc_id is null or l.quality = 0""")
def c15_fetch_plan(spark, d):
    x = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality", F.lit(1).alias("have")), "doc_id", "left")
    state = F.when(F.col("have").isNull(), "missing").when(F.col("quality") == 0, "stale")
    return x.select("doc_id", state.alias("state")).filter("state is not null")


@query("""with r as (select o_custkey as k, o_orderkey as pos, case when o_orderstatus = 'P' then null else o_orderpriority end as label, cast(o_orderdate as date) as day, o_totalprice > 400000 as big from orders)
select k, (select label from r x where x.k = r.k and label is not null order by pos desc limit 1) as label, cast(min(day) as varchar) as day, bool_or(big) as big from r group by 1""")
def k1_upsert_merge(spark, d):
    r = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("at"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("label"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") > 400000).alias("big"))
    out = sinks.merge_rows(r, ["k"], {"label": "newest", "day": "least", "big": "any"}, "at")
    return out.select("k", "label", B.text_day("day"), "big")


@query("""with new as (select l_orderkey as k, l_linenumber as n, count(*) as c from lineitem where l_orderkey % 3 = 0 and l_linenumber < 5 group by all), old as (select l_orderkey as k, l_linenumber as n, count(*) as c from lineitem group by all)
select * from old where k not in (select k from new) union all select * from new""")
def k2_replace_by_unit(spark, d):
    old = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    return sinks.replace_units(old, old.filter("k % 3 = 0 and n < 5"), "k")


@query("""with m as (select unnest(generate_series(date_trunc('month', (select min(o_orderdate) from orders)), (select max(o_orderdate) from orders), interval 1 month)) as a)
select strftime(a, '%Y-%m-%d') as first_day, strftime(a + interval 1 month - interval 1 day, '%Y-%m-%d') as last_day, (select count(*) from orders where date_trunc('month', o_orderdate) = a) as n from m""")
def s3_month_chunks(spark, d):
    from tallyspan.sources import landing

    o = table(spark, d, "orders")
    chunks = landing.month_chunks(o.agg(F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")))
    n = o.groupBy(F.trunc("o_orderdate", "month").alias("first_day")).agg(F.count(F.lit(1)).alias("n"))
    return chunks.join(n, "first_day", "left").select(B.text_day("first_day"), B.text_day("last_day"), F.coalesce("n", F.lit(0)).alias("n"))


@query("""with r as (select user_id, event_id, case event_type when 'view' then 2 when 'click' then 1 else 3 end as chunk from events), f as (select * from r qualify row_number() over (partition by event_id order by chunk) = 1)
select user_id, array_to_string(list(event_id order by chunk, event_id), ',') as ids from f where chunk < 3 group by 1""")
def s4_staged_chunks(spark, d):
    from tallyspan.sources import landing

    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "view", 2).when(F.col("event_type") == "click", 1).otherwise(3).alias("chunk")).filter("chunk < 3")
    return landing.grouped_chunks(e, "event_id", ["chunk", "event_id"], "user_id").select("user_id", F.array_join("items", ",").alias("ids"))


@query("""select user_id, event_id from events where date_diff('day', cast(ts as date), date '2024-02-20') <= 30 and weekofyear(ts) < (select max(weekofyear(ts)) from events)""")
def s17_cache_filter(spark, d):
    from tallyspan.sources import landing

    e = table(spark, d, "events").withColumn("term", F.weekofyear("ts"))
    return landing.usable_cache(e, "ts", F.lit("2024-02-20").cast("date"), 30, "term").select("user_id", "event_id")
