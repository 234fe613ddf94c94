"""Entity resolution on customers and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.operators import identity
from tallyspan.operators.graph import connected_components
from tallyspan.plans.registry import query
from tallyspan.tables import table

RECORDS = """rec as (select c_custkey as r, 'n' || c_nationkey || ':' || cast(floor(c_acctbal / 25) as bigint) as k1, case when c_custkey % 4 = 0 then 's' || c_mktsegment || ':' || cast(floor(c_acctbal / 3) as bigint) end as k2 from customer),
keys as (select r, k1 as k from rec union all select r, k2 from rec where k2 is not null),
edge as (select k.r as a, m.r as b from keys k join (select k, min(r) as r from keys group by 1) m on k.k = m.k),
both_ as (select a, b from edge union select b, a from edge)"""


def _records(spark, d):
    c = table(spark, d, "customer")
    k1 = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(":"), F.floor(F.col("c_acctbal") / 25).cast("string"))
    k2 = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("s"), F.col("c_mktsegment"), F.lit(":"), F.floor(F.col("c_acctbal") / 3).cast("string")))
    return c.select(F.col("c_custkey").alias("r"), k1.alias("k1"), k2.alias("k2"), "c_nationkey", "c_mktsegment")


@query("""select c_custkey, case when c_custkey % 5 = 0 then 'trusted:' || c_custkey when c_mktsegment = 'BUILDING' then 'segment:' || c_nationkey else 'name:' || c_name end as k from customer""")
def g1_identity_key(spark, d):
    c = table(spark, d, "customer").withColumn("t", F.when(F.col("c_custkey") % 5 == 0, F.col("c_custkey"))).withColumn("s", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey")))
    return c.select("c_custkey", identity.identity_key(("trusted", "t"), ("segment", "s"), ("name", "c_name")).alias("k"))


@query(f"""with recursive {RECORDS}, reach(r, e) as (select r, r from rec union select reach.r, both_.b from reach join both_ on both_.a = reach.e) select r, min(e) as entity from reach group by 1""")
def g2_shared_keys(spark, d):
    rec = _records(spark, d)
    return identity.resolve(rec.select("r"), "r", identity.shared_key_edges(rec, "r", ["k1", "k2"])).select("r", "entity")


@query(f"""with recursive {RECORDS}, reach(r, e) as (select r, r from rec union select reach.r, both_.b from reach join both_ on both_.a = reach.e), ent as (select r, min(e) as entity from reach group by 1)
select entity from ent join customer on r = c_custkey group by 1 having count(distinct c_nationkey) > 1 or count(distinct c_mktsegment) > 1""")
def g7_conflicts(spark, d):
    rec = _records(spark, d)
    ent = identity.resolve(rec, "r", identity.shared_key_edges(rec, "r", ["k1", "k2"]))
    return identity.conflicting(ent, ["c_nationkey", "c_mktsegment"])


@query("""with e as (select s_suppkey as entity, 'b' || s_nationkey || ':' || cast(floor(s_acctbal / 500) as bigint) as bucket, 'speaker' as kind, s_nationkey % 3 as x from supplier union all select 1000000 + c_custkey, 'b' || c_nationkey || ':' || cast(floor(c_acctbal / 500) as bigint), 'roster', case when c_custkey % 2 = 0 then null else c_custkey % 3 end from customer),
one as (select bucket, kind, min(entity) as entity, max(x) as x from e group by 1, 2 having count(distinct entity) = 1),
p as (select a.entity as src, b.entity as dst from one a join one b on a.bucket = b.bucket and a.kind = 'speaker' and b.kind = 'roster' where coalesce(a.x = b.x, true))
select src, dst from p where src in (select src from p group by 1 having count(*) = 1) and dst in (select dst from p group by 1 having count(*) = 1)""")
def g5_bucket_partners(spark, d):
    bucket = lambda n, b: F.concat(F.lit("b"), F.col(n).cast("string"), F.lit(":"), F.floor(F.col(b) / 500).cast("string")).alias("bucket")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("entity"), bucket("s_nationkey", "s_acctbal"), F.lit("speaker").alias("kind"), (F.col("s_nationkey") % 3).cast("bigint").alias("x"))
    c = table(spark, d, "customer").select((F.col("c_custkey") + 1000000).alias("entity"), bucket("c_nationkey", "c_acctbal"), F.lit("roster").alias("kind"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_custkey") % 3).alias("x"))
    return identity.bucket_partners(s.unionByName(c), "bucket", "kind", ("speaker", "roster"), ["x"])


@query("""with l as (select o_custkey as entity, o_custkey % 400 as bucket, o_orderpriority as event from orders), a as (select 1000000 + l_suppkey as entity, l_suppkey * 4 as bucket, case when l_quantity > 49 then '1-URGENT' else 'none' end as event from lineitem),
one as (select bucket, min(entity) as dst from a group by 1 having count(distinct entity) = 1), p as (select distinct l.entity as src, dst from l join one on l.bucket = one.bucket)
select src, dst from p where not exists (select 1 from l join a on l.event = a.event where l.entity = p.src and a.entity = p.dst)""")
def g6_attach_unless_shared_event(spark, d):
    l = table(spark, d, "orders").select(F.col("o_custkey").alias("entity"), (F.col("o_custkey") % 400).alias("bucket"), F.col("o_orderpriority").alias("event"))  # noqa: E741
    a = table(spark, d, "lineitem").select((F.col("l_suppkey") + 1000000).alias("entity"), (F.col("l_suppkey") * 4).alias("bucket"), F.when(F.col("l_quantity") > 49, "1-URGENT").otherwise("none").alias("event"))
    return identity.attach(l, a, "bucket", "event")


@query("""with e as (select s_suppkey as person, s_nationkey as entity, 100 - s_suppkey % 97 as ordinal from supplier), b as (select entity, person from e qualify row_number() over (partition by entity order by ordinal, person) = 1)
select e.person, b.person as survivor from e join b on e.entity = b.entity""")
def g8_survivors(spark, d):
    e = table(spark, d, "supplier").select(F.col("s_suppkey").alias("person"), F.col("s_nationkey").alias("entity"), (100 - F.col("s_suppkey") % 97).alias("ordinal"))
    return identity.survivors(e, "ordinal", "person")


@query("""with recursive al as (select c_custkey as src, c_custkey - 1 - c_custkey % 3 as dst from customer where c_custkey % 7 <> 0 and c_custkey > 10), walk(src, z) as (select src, dst from al union select walk.src, al.dst from walk join al on walk.z = al.src)
select src, z as target from walk where z not in (select src from al)""")
def g8_alias_closure(spark, d):
    al = table(spark, d, "customer").filter("c_custkey % 7 <> 0 and c_custkey > 10").select(F.col("c_custkey").alias("src"), (F.col("c_custkey") - 1 - F.col("c_custkey") % 3).alias("dst"))
    return identity.close_aliases(al, "src", "dst")


@query("""with s as (select s_suppkey, s_nationkey || ':' || cast(round(s_acctbal / 1000) as bigint) as k from supplier), c as (select c_custkey, c_nationkey || ':' || cast(round(c_acctbal / 1000) as bigint) as k from customer),
a as (select k, min(s_suppkey) as l from s group by 1 having count(*) = 1), b as (select k, min(c_custkey) as r from c group by 1 having count(*) = 1) select l, r from a join b on a.k = b.k""")
def g9_unique_unique_join(spark, d):
    key = lambda n, b: F.concat(F.col(n).cast("string"), F.lit(":"), F.round(F.col(b) / 1000).cast("bigint").cast("string")).alias("k")
    s = table(spark, d, "supplier").select("s_suppkey", key("s_nationkey", "s_acctbal"))
    c = table(spark, d, "customer").select("c_custkey", key("c_nationkey", "c_acctbal"))
    return identity.unique_pairs(s, c, "k", "s_suppkey", "c_custkey")


@query("""select s_suppkey, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower('Dr. ' || s_name || ', von ' || (s_nationkey % 5)), '[\\s#,.]+'), lambda x: x <> '' and x not in ('dr', 'von')))), ' ') as k from supplier""")
def g10_name_key(spark, d):
    name = F.concat(F.lit("Dr. "), F.col("s_name"), F.lit(", von "), (F.col("s_nationkey") % 5).cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", identity.name_key(name, ["dr", "von"]).alias("k"))


@query("""with r as (select p_brand as ident, p_name as n, string_split(p_name, ' ') as w from part) select distinct a.ident from r a join r b on a.ident = b.ident and not list_has_any(a.w, b.w)""")
def g11_ambiguous_ids(spark, d):
    p = table(spark, d, "part").select("p_brand", F.split("p_name", " ").alias("w"))
    return identity.ambiguous_ids(p, "p_brand", "w").withColumnRenamed("p_brand", "ident")


@query("""with m as (select o_custkey as r, case when o_custkey % 10 = 0 then o_custkey - 10 else o_custkey end as person from orders) select o_orderkey, coalesce(ov.person, m.person) as person from orders o join (select distinct r, person from m) m on o.o_custkey = m.r
left join (select c_custkey as r, 0 as person from customer where c_custkey % 100 = 20) ov on o.o_custkey = ov.r""")
def g13_overlay(spark, d):
    o = table(spark, d, "orders")
    m = o.select(F.col("o_custkey").alias("r"), F.when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") - 10).otherwise(F.col("o_custkey")).alias("person")).distinct()
    ov = table(spark, d, "customer").filter("c_custkey % 100 = 20").select(F.col("c_custkey").alias("r"), F.lit(0).alias("person"))
    return identity.overlay(o.withColumnRenamed("o_custkey", "r"), m, ov, "r", "person").select("o_orderkey", "person")


@query("""with p as (select o_orderkey as occ, o_custkey as now, case when o_orderkey % 5 <> 0 then case when o_orderkey % 13 = 0 then o_custkey + 1 else o_custkey end end as before from orders)
select occ, case when before is null then now when before = now then before when o.o_orderstatus = 'P' then before else now end as bound, case when before is null then 'new' when before = now then 'stays' when o.o_orderstatus = 'P' then 'kept' else 'moves' end as rule from p join orders o on occ = o_orderkey""")
def x9_occurrence_binding(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("occ"), F.col("o_custkey").alias("now"), (F.col("o_orderstatus") == "P").alias("pinned"))
    before = table(spark, d, "orders").filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("occ"), (F.col("o_custkey") + F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0)).alias("before"))
    return identity.bind_occurrences(o, before, "occ", "now", "before", "pinned")


@query("""with recursive e as (select event_id as a, event_id - 1 - event_id % 4 as b from events where event_id % 9 <> 0 and event_id > 5), walk(a, z) as (select a, b from e union select walk.a, e.b from walk join e on walk.z = e.a),
top as (select a, min(z) as component from walk group by 1) select component, count(*) + 1 as n from top group by 1""")
def g2_component_sizes(spark, d):
    e = table(spark, d, "events").filter("event_id % 9 <> 0 and event_id > 5").select(F.col("event_id").alias("src"), (F.col("event_id") - 1 - F.col("event_id") % 4).alias("dst"))
    return connected_components(e).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


@query("""select n_nationkey, lower(n_name) as folded from nation""")
def f23_folded_names(spark, d):
    return table(spark, d, "nation").select("n_nationkey", S.fold("n_name").alias("folded"))
