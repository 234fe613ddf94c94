"""Set operations, comparisons of versions, top-k, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.operators import diffs, ranking
from tallyspan.plans.registry import query
from tallyspan.tables import table

OLD = "(select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders where o_orderkey % 20 <> 3)"
NEW = "(select o_orderkey, o_custkey, case when o_orderkey % 17 = 5 then 'X' else o_orderstatus end as o_orderstatus, case when o_orderkey % 41 = 7 then null else o_orderpriority end as o_orderpriority from orders where o_orderkey % 20 <> 11)"


def _versions(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = o.filter("o_orderkey % 20 <> 11").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 17 == 5, "X").otherwise(F.col("o_orderstatus")))
    return o.filter("o_orderkey % 20 <> 3"), new.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 41 != 7, F.col("o_orderpriority")))


@query("select c_nationkey as nation, c_mktsegment as label from customer union select s_nationkey, 'SUPPLIER' from supplier")
def u1_union_distinct(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    return c.union(table(spark, d, "supplier").select("s_nationkey", F.lit("SUPPLIER"))).distinct()


@query("select o_custkey as k, 'order' as kind from orders union all select c_custkey, 'customer' from customer")
def u2_union_all(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit("order").alias("kind"))
    return o.unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind")))


@query("""with a as (select distinct user_id % 977 as k from events where event_type = 'view'), b as (select distinct o_custkey % 1409 as k from orders where o_orderstatus = 'P')
select case when a.k is null then 'only_right' when b.k is null then 'only_left' else 'both' end as side, count(*) as n from a full join b on a.k = b.k group by 1""")
def u3_id_sets(spark, d):
    a = table(spark, d, "events").filter("event_type = 'view'").select((F.col("user_id") % 977).alias("k")).distinct().withColumn("l", F.lit(1))
    b = table(spark, d, "orders").filter("o_orderstatus = 'P'").select((F.col("o_custkey") % 1409).alias("k")).distinct().withColumn("r", F.lit(1))
    side = F.when(F.col("l").isNull(), "only_right").when(F.col("r").isNull(), "only_left").otherwise("both")
    return a.join(b, "k", "full_outer").groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select a.o_orderkey from {OLD} a where exists (select 1 from {NEW} b where a.o_orderkey = b.o_orderkey)")
def u4_cohort(spark, d):
    old, new = _versions(spark, d)
    return old.join(new, "o_orderkey", "left_semi").select("o_orderkey")


@query(f"""select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed' else 'changed' end as change,
a.o_orderstatus as old_o_orderstatus, b.o_orderstatus as new_o_orderstatus, a.o_orderpriority as old_o_orderpriority, b.o_orderpriority as new_o_orderpriority from {OLD} a full join {NEW} b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.o_orderstatus is distinct from b.o_orderstatus or a.o_orderpriority is distinct from b.o_orderpriority""")
def u5_snapshot_diff(spark, d):
    old, new = _versions(spark, d)
    return diffs.diff(old, new, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query(f"""with a as (select 'status:' || coalesce(o_orderstatus, '?') as k, count(*) as n from {OLD} group by 1 union all select 'priority:' || coalesce(o_orderpriority, '?'), count(*) from {OLD} group by 1 union all select 'rows', count(*) from {OLD}),
b as (select 'status:' || coalesce(o_orderstatus, '?') as k, count(*) as n from {NEW} group by 1 union all select 'priority:' || coalesce(o_orderpriority, '?'), count(*) from {NEW} group by 1 union all select 'rows', count(*) from {NEW})
select coalesce(a.k, b.k) as measure, a.n as old_n, b.n as new_n, coalesce(b.n, 0) - coalesce(a.n, 0) as delta from a full join b on a.k = b.k""")
def u6_store_comparison(spark, d):
    old, new = _versions(spark, d)
    return diffs.compare_counts(old, new, {"status": "o_orderstatus", "priority": "o_orderpriority"})


@query("""with e as (select s_suppkey as k from supplier where s_suppkey % 10 <> 3), s as (select distinct l_suppkey as k from lineitem where l_suppkey % 6 <> 1)
select k, 'missing' as state from e where k not in (select k from s) union all select k, 'stale' from s where k not in (select k from e)""")
def u8_missing_and_stale(spark, d):
    e = table(spark, d, "supplier").filter("s_suppkey % 10 <> 3").select(F.col("s_suppkey").alias("k"))
    s = table(spark, d, "lineitem").filter("l_suppkey % 6 <> 1").select(F.col("l_suppkey").alias("k"))
    return diffs.missing_and_stale(e, s, "k")


@query("""with a as (select o_custkey as k, count(*) as n from orders where o_orderstatus = 'F' group by 1), b as (select o_custkey as k, count(*) as n from orders where o_orderstatus = 'O' group by 1)
select case when a.k is null then case when b.n > 2 then 'right_many' else 'right_few' end when b.k is null then case when a.n > 2 then 'left_many' else 'left_few' end when a.n = b.n then 'equal' when abs(a.n - b.n) = 1 then 'near' else 'differs' end as class, count(*) as n
from a full join b on a.k = b.k group by 1""")
def u9_one_sided_classes(spark, d):
    per = lambda s, n: table(spark, d, "orders").filter(F.col("o_orderstatus") == s).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(n))
    x = per("F", "a").join(per("O", "b"), "o_custkey", "full_outer")
    one = F.when(F.col("a").isNull(), F.when(F.col("b") > 2, "right_many").otherwise("right_few")).when(F.col("b").isNull(), F.when(F.col("a") > 2, "left_many").otherwise("left_few"))
    return x.groupBy(one.when(F.col("a") == F.col("b"), "equal").when(F.abs(F.col("a") - F.col("b")) == 1, "near").otherwise("differs").alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1 order by n desc, p_partkey limit 5")
def t1_top_five(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    return g.join(table(spark, d, "part").select("p_partkey"), "p_partkey").orderBy(F.desc("n"), "p_partkey").limit(5)


@query("""with c as (select p_brand, l_partkey, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1, 2), r as (select *, row_number() over (partition by p_brand order by n desc, l_partkey) as position from c),
k as (select p_brand, min(n) filter (position <= 5) as cut from r group by 1), s as (select r.p_brand, cut, count(*) filter (n >= cut) as at_least, count(*) filter (n > cut) as above from r join k on r.p_brand = k.p_brand group by 1, 2)
select r.p_brand, l_partkey, n, cast(position as int) as position from r join s on r.p_brand = s.p_brand where case when at_least <= 8 then n >= cut when above > 0 then n > cut else position <= 5 end""")
def t2_top_with_ties(spark, d):
    g = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_with_ties(g, "n", [F.col("l_partkey")], ["p_brand"])


@query("""with c as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) select o_custkey, count(*) filter (rn > 3) as more from c group by 1""")
def t3_remaining_counts(spark, d):
    o = table(spark, d, "orders")
    top = ranking.first_rows(o, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    shown = top.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("shown"))
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).join(shown, "o_custkey").select("o_custkey", (F.col("n") - F.col("shown")).alias("more"))


@query("""with a as (select l_suppkey, count(*) filter (l_returnflag = 'A') as old, count(*) filter (l_returnflag = 'R') as new from lineitem group by 1), m as (select *, new - old as delta from a where new <> old)
select l_suppkey, old, new, delta, greatest((select count(*) from m) - 10, 0) as n_more from m order by abs(delta) desc, l_suppkey limit 10""")
def t4_largest_changes(spark, d):
    per = lambda f: table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == f).alias("n"))
    return diffs.largest_changes(per("A"), per("R"), "l_suppkey", "n", 10)


@query("""with x as (select doc_id, quality from documents left join labels using (doc_id)) select doc_id, quality from x""")
def t5_nulls_last(spark, d):
    x = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return x.select("doc_id", "quality").orderBy(F.col("quality").asc_nulls_last(), "doc_id")


@query("""with s as (select o_orderkey, o_orderpriority, count(*) over (partition by o_orderpriority) as n, row_number() over (partition by o_orderpriority order by md5('7:' || o_orderkey), o_orderkey) as rn from orders)
select o_orderkey, o_orderpriority from s where rn <= greatest(ceil(0.16 * n), 10)""")
def t7_stratified_sample(spark, d):
    return ranking.stratified_sample(table(spark, d, "orders"), "o_orderkey", "o_orderpriority", 0.16, 10, 7).select("o_orderkey", "o_orderpriority")


@query("""select event_id, user_id, event_type from events qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1""")
def x13_first_seen(spark, d):
    return ranking.first_rows(table(spark, d, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type")


@query("""with u as (select user_id, min(event_id) as event_id, count(*) as n, case when user_id % 11 = 0 then 'unusable' else 'catalog' end as kind from events group by user_id) select kind, count(*) as units, cast(sum(n) as bigint) as n from u group by 1""")
def x16_catalog(spark, d):
    u = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return u.groupBy(F.when(F.col("user_id") % 11 == 0, "unusable").otherwise("catalog").alias("kind")).agg(F.count(F.lit(1)).alias("units"), F.sum("n").alias("n"))


@query("""select l_orderkey, array_to_string(list(l_linenumber || ':' || l_partkey order by l_linenumber, l_partkey), ' ') as lines, min_by(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) as supplier from lineitem group by 1""")
def x20_ordered_nested(spark, d):
    item = F.struct("l_linenumber", "l_partkey")
    lines = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.concat(x["l_linenumber"].cast("string"), F.lit(":"), x["l_partkey"].cast("string")))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(lines, " ").alias("lines"), F.min_by("l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("supplier"))


@query("""with s as (select p_partkey as k, 1 as src, p_partkey as pos, case when p_size % 4 <> 0 then p_brand end as link from part where p_partkey % 3 <> 0 union all select l_partkey, 2, min(l_orderkey), min(l_returnflag) from lineitem group by l_partkey)
select k, min(src) as source, coalesce(min(case when src = 1 then link end), min(case when src = 2 then link end)) as link from s group by 1""")
def x21_primary_source_wins(spark, d):
    a = table(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("k"), F.lit(1).alias("src"), F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).alias("link"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.lit(2).alias("src"), F.min("l_returnflag").alias("link"))
    both = a.unionByName(b)
    return both.groupBy("k").agg(F.min("src").alias("source"), F.coalesce(F.min(F.when(F.col("src") == 1, F.col("link"))), F.min(F.when(F.col("src") == 2, F.col("link")))).alias("link"))


@query("""select o_orderkey, case when o_orderpriority ilike '%urgent%' then 'urgent_n' when o_orderpriority ilike '%low%' then 'low_n' else 'other_n' end as release_column from orders""")
def x22_release_columns(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.first_match("o_orderpriority", [("(?i)urgent", "urgent_n"), ("(?i)low", "low_n")], "other_n").alias("release_column"))
