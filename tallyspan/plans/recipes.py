"""The published recipes on the star schema, and the streaming extension."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyspan.operators.recipes import Recipe, run
from tallyspan.plans import bindings as B
from tallyspan.plans.registry import ORACLES, QUERIES, query
from tallyspan.session import run_dir
from tallyspan.streaming import weekly
from tallyspan.tables import table

#: The same text runs on either engine.
RECIPES = [
    Recipe(
        "r1_most_orders",
        """select o_custkey, cast(year(o_orderdate) as bigint) as term, count(*) as n, cast(sum(round(o_totalprice * 100)) as bigint) as cents, min(c_name) as name
from orders join customer on o_custkey = c_custkey group by o_custkey, year(o_orderdate) order by term desc, n desc, cents desc, o_custkey limit 5""",
        ("orders", "customer"),
        ("o_custkey", "term", "n", "cents", "name"),
    ),
    Recipe(
        "r2_text_share",
        """with g as (select source, lang, cast(sum(n_chars) as bigint) as chars, count(*) as n from documents group by source, lang),
t as (select source, sum(chars) as total from g group by source)
select g.source, g.lang, n, chars, case when g.lang is not null then round(100 * chars / cast(total as double), 1) end as share from g join t on g.source = t.source""",
        ("documents",),
        ("source", "lang", "n", "chars", "share"),
    ),
    Recipe(
        "r4_closest_votes",
        """with v as (select l_partkey as vote, cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as yes, cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as no, max(l_shipdate) as day from lineitem group by l_partkey)
select vote, yes, no, abs(yes - no) as gap from v where yes is not null and no is not null order by gap, day desc, vote limit 20""",
        ("lineitem",),
        ("vote", "yes", "no", "gap"),
    ),
    Recipe(
        "r5_busiest_parts",
        """select l_partkey, count(distinct l_orderkey) as orders, count(distinct l_shipdate) as days, min(l_orderkey) as first_order from lineitem group by l_partkey order by orders desc, days desc, l_partkey limit 20""",
        ("lineitem",),
        ("l_partkey", "orders", "days", "first_order"),
    ),
    Recipe(
        "r6_votes_per_committee",
        """select p_brand as committee, cast(year(l_shipdate) as bigint) as term, count(distinct l_orderkey) as votes from lineitem join part on l_partkey = p_partkey where p_type like 'S%' group by p_brand, year(l_shipdate)""",
        ("lineitem", "part"),
        ("committee", "term", "votes"),
    ),
]

for _r in RECIPES:
    QUERIES[_r.recipe_id] = lambda spark, d, r=_r: run(spark, d, r)
    ORACLES[_r.recipe_id] = _r.sql


@query(f"""with {B.EPISODES}, p as (select unnest(generate_series(timestamp '1996-01-01', timestamp '2000-12-01', interval 1 month))::date as day),
c as (select day, o_orderpriority, count(*) as seats from p join episodes on start <= day and day < stop group by 1, 2), t as (select day, sum(seats) as total from c group by 1)
select year(c.day) as term, o_orderpriority, round(100 * sum(seats) / sum(total)::double, 1) as mean_share from c join t on c.day = t.day group by 1, 2""")
def r2_mean_seat_share(spark, d):
    from tallyspan.operators import intervals

    p = spark.range(1).select(F.explode(F.sequence(F.lit("1996-01-01").cast("date"), F.lit("2000-12-01").cast("date"), F.expr("interval 1 month"))).alias("day"))
    e = B.episodes(spark, d).filter("start < stop").select("o_orderpriority", F.col("start").alias("valid_from"), F.col("stop").alias("valid_until"))
    c = intervals.bucket_as_of_join(p, e, "day", 31).groupBy("day", "o_orderpriority").agg(F.count(F.lit(1)).alias("seats"))
    t = c.groupBy("day").agg(F.sum("seats").alias("total"))
    return c.join(t, "day").groupBy(F.year("day").cast("bigint").alias("term"), "o_orderpriority").agg(F.round(100 * F.sum("seats") / F.sum("total"), 1).alias("mean_share"))


@query("""with m as (select l_partkey as vote, l_suppkey as member, l_returnflag as stance, year(l_shipdate) as term from lineitem qualify row_number() over (partition by l_partkey, l_suppkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_extendedprice desc) = 1),
c as (select vote, count(*) filter (stance = 'A') as yes, count(*) filter (stance = 'R') as no from m group by 1)
select member, term, count(*) as deviations from m join c on m.vote = c.vote where (yes > no and stance = 'R') or (no > yes and stance = 'A') group by 1, 2""")
def r3_deviations(spark, d):
    from tallyspan.operators import plurality

    m = plurality.latest_members(table(spark, d, "lineitem").select(F.col("l_partkey").alias("vote"), F.col("l_suppkey").alias("member"), F.col("l_returnflag").alias("stance"), "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"), "vote", "member", ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"])
    c = m.groupBy("vote").agg(F.count_if(F.col("stance") == "A").alias("yes"), F.count_if(F.col("stance") == "R").alias("no"))
    against = ((F.col("yes") > F.col("no")) & (F.col("stance") == "R")) | ((F.col("no") > F.col("yes")) & (F.col("stance") == "A"))
    return m.join(c, "vote").filter(against).groupBy("member", F.year("l_shipdate").cast("bigint").alias("term")).agg(F.count(F.lit(1)).alias("deviations"))


@query("""select strftime(date_trunc('week', ts), '%Y-%m-%d') as week_start, event_type, count(*) as n, cast(sum(round(value * 100)) as bigint) as cents from events group by 1, 2""")
def stream_event_weeks(spark, d):
    schema = table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    at = f"{run_dir(spark)}/stream-{uuid.uuid4().hex}"
    weekly.run_available(weekly.weekly_counts(events, "ts", ["event_type"], "cents"), f"{at}/out", f"{at}/checkpoint")
    out = weekly.newest_versions(spark, f"{at}/out", ["event_type"])
    return out.select(F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "event_type", "n", F.col("total").alias("cents"))


@query("""with g as (select user_id, ts, event_id, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval 6 hours then 0 else 1 end as fresh from events), s as (select user_id, sum(fresh) over (partition by user_id order by ts, event_id) as k from g)
select user_id, count(distinct k) as sessions, count(*) as n from s group by 1""")
def session_windows(spark, d):
    s = weekly.user_sessions(table(spark, d, "events"), "ts", "user_id")
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n"))
