"""Joins: owners, as-of and overlap joins, evidence-ranked links, full comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.operators import intervals, linking, plurality
from tallyspan.plans import bindings as B
from tallyspan.plans.registry import query
from tallyspan.tables import table


@query("""with f as (select l_partkey, l_orderkey from lineitem join orders on l_orderkey = o_orderkey qualify row_number() over (partition by l_partkey order by o_orderdate, o_orderkey) = 1)
select p_partkey, coalesce(case when p_partkey % 3 = 0 then p_size end, l_orderkey) as owner from part left join f on p_partkey = l_partkey""")
def j1_own_or_first_owner(spark, d):
    links = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    first = linking.first_owner(links, "l_partkey", "l_orderkey", [F.col("o_orderdate"), F.col("o_orderkey")])
    p = table(spark, d, "part")
    own = F.when(F.col("p_partkey") % 3 == 0, F.col("p_size"))
    return p.join(first, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", F.coalesce(own, "l_orderkey").alias("owner"))


@query("""select l_suppkey, concat(l_orderkey % 30, '/', l_partkey) as number from lineitem qualify row_number() over (partition by l_suppkey order by l_orderkey % 30, l_partkey) = 1""")
def j1b_first_by_number(spark, d):
    number = F.concat((F.col("l_orderkey") % 30).cast("string"), F.lit("/"), F.col("l_partkey").cast("string"))
    li = table(spark, d, "lineitem").select("l_suppkey", number.alias("number"))
    return linking.first_owner(li, "l_suppkey", "number", [S.number_sort_key("number")])


@query("""select n_name, year(o_orderdate) as year, c_mktsegment, count(*) as n, cast(sum(l_quantity) as bigint) as quantity, count(r_name) as with_region
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by all""")
def j3_star_join(spark, d):
    li, o, c = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "customer")
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    x = x.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return x.groupBy("n_name", F.year("o_orderdate").cast("bigint").alias("year"), "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"), F.count("r_name").alias("with_region")
    )


@query("select distinct l_suppkey as s_suppkey, o_custkey as c_custkey from lineitem join orders on l_orderkey = o_orderkey")
def j4_fan_out_distinct(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("s_suppkey"), F.col("o_custkey").alias("c_custkey")).distinct()


@query("""with k as (select event_id, props, unnest(json_keys(props)) as name from events) select event_id, name, cast(json_extract_string(props, '$.' || name) as bigint) as amount from k""")
def j5_lateral_unnest(spark, d):
    e = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    return e.select("event_id", F.explode("m").alias("name", "amount"))


@query(f"""with {B.VALIDITY}, facts as (select l_orderkey, l_linenumber, l_partkey, o_custkey, cast(l_shipdate as date) as day from lineitem join orders on l_orderkey = o_orderkey)
select l_orderkey, l_linenumber, l_partkey, label, cast(valid_from as varchar) as valid_from from facts join validity v on facts.o_custkey = v.o_custkey and valid_from <= day and (valid_until is null or day < valid_until)""")
def j6_as_of_join(spark, d):
    facts = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", F.col("l_shipdate").cast("date").alias("day"))
    out = intervals.as_of_join(facts, B.validity(spark, d), ["o_custkey"], "day")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "label", B.text_day("valid_from"))


@query(f"""with {B.EPISODES}, points as (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-01', interval 1 month))::date as day)
select cast(day as varchar) as day, count(*) as n, count(distinct o_custkey) as customers from points join episodes on start <= day and day < stop group by 1""")
def j6_as_of_without_key(spark, d):
    points = spark.range(1).select(F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2001-12-01").cast("date"), F.expr("interval 1 month"))).alias("day"))
    spans = B.episodes(spark, d).select("o_custkey", F.col("start").alias("valid_from"), F.col("stop").alias("valid_until")).filter("valid_from < valid_until")
    hit = intervals.bucket_as_of_join(points, spans, "day", 31)
    return hit.groupBy(B.text_day("day")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("""with h as (select o_custkey as k, o_orderpriority as label, cast(o_orderdate as date) as a, cast(o_orderdate as date) + 200 as b from orders),
f as (select l_orderkey, l_linenumber, l_partkey, o_custkey as k, cast(l_shipdate as date) as day, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice) as id from lineitem join orders on l_orderkey = o_orderkey),
one as (select id, min(label) as label from f join h on f.k = h.k and a <= day and day < b group by 1 having count(distinct label) = 1)
select f.l_orderkey, f.l_linenumber, f.l_partkey, label from f left join one on f.id = one.id""")
def j7_proved_label(spark, d):
    o = table(spark, d, "orders")
    h = o.select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("label"), F.col("o_orderdate").cast("date").alias("valid_from"), F.date_add(F.col("o_orderdate").cast("date"), 200).alias("valid_until"))
    f = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("k"), F.col("l_shipdate").cast("date").alias("day"))
    return intervals.proved_label(f, h, "k", "day", "label").select("l_orderkey", "l_linenumber", "l_partkey", "label")


@query(f"""with {B.EPISODES} select a.o_custkey, count(*) as n from episodes a join episodes b on a.o_custkey = b.o_custkey and a.start <= b.stop and b.start <= a.stop and a.o_orderkey < b.o_orderkey group by 1""")
def j8_overlap_join(spark, d):
    e = B.episodes(spark, d).withColumnRenamed("stop", "end")
    pairs = intervals.overlap_pairs(e, e, ["o_custkey"], "o_orderkey", "o_orderkey")
    return pairs.filter("left_id < right_id").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("""with l as (select o_custkey, o_orderkey, o_orderstatus, o_orderpriority, list(distinct l_partkey) as parts, list(distinct l_suppkey) as supps from orders join lineitem on o_orderkey = l_orderkey group by all),
h as (select v.o_custkey, v.o_orderkey as vote, i.o_orderkey as item, case when list_has_any(i.parts, v.parts) then 'part' when list_has_any(i.supps, v.supps) then 'supplier' end as basis, i.o_orderpriority = v.o_orderpriority as same
 from l v join l i on v.o_custkey = i.o_custkey and v.o_orderstatus = 'F' and i.o_orderstatus = 'O'),
best as (select o_custkey, vote, item, basis from h where basis is not null),
one as (select o_custkey, vote, min(item) as item from h where same and vote not in (select vote from best) group by 1, 2 having count(*) = 1)
select * from best union all select o_custkey, vote, item, 'title' from one""")
def j9_evidence_links(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    sets = li.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"), F.collect_set("l_suppkey").alias("supps"))
    x = o.join(sets, F.col("o_orderkey") == F.col("l_orderkey"))
    items = x.filter("o_orderstatus = 'O'").withColumnRenamed("o_orderkey", "item")
    votes = x.filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "vote")
    evidence = [("part", "parts", "parts"), ("supplier", "supps", "supps")]
    return linking.ranked_links(items, votes, "item", "vote", "o_custkey", evidence, ("o_orderpriority", "o_orderpriority"))


@query("""with l as (select o_custkey, o_orderkey, o_orderstatus, list(distinct p_type) as t from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey group by all)
select a.o_custkey, a.o_orderkey as l, min(b.o_orderkey) as r from l a join l b on a.o_custkey = b.o_custkey and a.o_orderstatus = 'F' and b.o_orderstatus = 'O' and list_has_all(b.t, a.t) group by 1, 2 having count(*) = 1""")
def j10_subset_links(spark, d):
    x = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    x = x.groupBy("o_custkey", "o_orderkey", "o_orderstatus").agg(F.collect_set("p_type").alias("t"))
    return linking.subset_links(x.filter("o_orderstatus = 'F'"), x.filter("o_orderstatus = 'O'"), "o_orderkey", "o_orderkey", "o_custkey", "t")


@query(f"""with {B.COUNTS}, p as (select vote, p_brand, yes, no, abstain from totals join part on vote = p_partkey)
select a.p_brand, a.vote as l, min(b.vote) as r from p a join p b on a.p_brand = b.p_brand and a.vote % 2 = 0 and b.vote % 2 = 1 and coalesce(abs(a.yes - b.yes) <= 0, true) and coalesce(abs(a.no - b.no) <= 0, true) and coalesce(abs(a.abstain - b.abstain) <= 0, true)
group by 1, 2 having count(*) = 1""")
def j11_tally_links(spark, d):
    p = B.totals(spark, d).join(table(spark, d, "part"), F.col("vote") == F.col("p_partkey")).select("vote", "p_brand", "yes", "no", "abstain")
    return linking.tally_links(p.filter("vote % 2 = 0"), p.filter("vote % 2 = 1"), "vote", "vote", "p_brand", ["yes", "no", "abstain"])


@query("select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def j12_semi_join(spark, d):
    r = table(spark, d, "lineitem").filter("l_returnflag = 'R'")
    return table(spark, d, "orders").join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def j13_anti_join(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("""with a as (select c_nationkey as k, count(*) as n from customer where c_acctbal < 0 group by 1), b as (select s_nationkey as k, count(*) as n from supplier group by 1)
select coalesce(a.k, b.k) as k, a.n as left_n, b.n as right_n, case when a.k is null then 'right' when b.k is null then 'left' when a.n = b.n then 'same' else 'differs' end as presence from a full join b on a.k = b.k""")
def j14_full_outer_compare(spark, d):
    a = table(spark, d, "customer").filter("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("left_n"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("right_n"))
    state = F.when(F.col("left_n").isNull(), "right").when(F.col("right_n").isNull(), "left").when(F.col("left_n") == F.col("right_n"), "same").otherwise("differs")
    return a.join(b, "k", "full_outer").select("k", "left_n", "right_n", state.alias("presence"))


@query("""select event_id from events e where weekofyear(ts) = 2 and exists (select 1 from events x where weekofyear(x.ts) = 3 and isodow(x.ts) = isodow(e.ts) and x.user_id = e.user_id)""")
def j16_same_weekday(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.weekofyear("ts").alias("w"), F.weekday("ts").alias("day"))
    return e.filter("w = 2").join(e.filter("w = 3"), ["user_id", "day"], "left_semi").select("event_id")


@query(f"with {B.MEMBERS} select vote, member, stance, grp from latest")
def j17_last_row_per_identity(spark, d):
    return plurality.latest_members(B.members(spark, d), "vote", "member", B.LINE_ORDER).select("vote", "member", "stance", "grp")


@query("""with a as (select c_custkey, c_nationkey, lower(c_mktsegment) as seg from customer), r as (select s_nationkey, lower(substr(s_name, 1, 8)) as seg, s_suppkey from supplier)
select c_custkey, case when (select count(distinct s_suppkey) from r where s_nationkey = c_nationkey) = 1 then (select min(s_suppkey) from r where s_nationkey = c_nationkey) end as s_suppkey from a""")
def s8_unique_match(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return linking.unique_match(c, s, ["nation"], "s_suppkey").select("c_custkey", "s_suppkey")


@query("""with n1 as (select c_custkey, min(s_suppkey) as v from customer join supplier on c_nationkey = s_nationkey and floor(c_acctbal / 500) = floor(s_acctbal / 500) group by 1 having count(distinct s_suppkey) = 1),
n2 as (select o_custkey as c_custkey, min(l_suppkey) as v from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'F' group by 1 having count(distinct l_suppkey) = 1)
select c.c_custkey, coalesce(n1.v, n2.v) as s_suppkey, case when n1.v is not null then 'nation' when n2.v is not null then 'order' end as source from customer c left join n1 on c.c_custkey = n1.c_custkey left join n2 on c.c_custkey = n2.c_custkey""")
def s18_lookup_cascade(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    near = linking.extremes(s, [F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 500).alias("band")], "s_suppkey")
    same = (F.col("c_nationkey") == F.col("nation")) & (F.floor(F.col("c_acctbal") / 500) == F.col("band"))
    n1 = c.join(near, same).select("c_custkey", "s_suppkey")
    li = table(spark, d, "lineitem")
    n2 = table(spark, d, "orders").filter("o_orderstatus = 'F'").join(li, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c_custkey"), F.col("l_suppkey").alias("s_suppkey"))
    return linking.cascade(c.select("c_custkey"), "c_custkey", [("nation", n1), ("order", n2)], "s_suppkey")
