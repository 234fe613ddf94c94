"""Evidence, features, differing groups and pages, canonical persons, sheets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.functions import texts as T
from tallyspan.operators import choices, graph, linking
from tallyspan.plans.registry import query
from tallyspan.session import run_dir
from tallyspan.sources import landing, sinks
from tallyspan.tables import table

_EVIDENCE = """e as (select l_orderkey as unit, case l_suppkey % 4 when 0 then 'own_text' when 1 then 'position' when 2 then 'announcement' else 'rumour' end as source, case l_partkey % 3 when 0 then 'reject' when 1 then 'accept' end as rec from lineitem),
g as (select unit, source, case source when 'own_text' then 1 when 'position' then 2 else 3 end as p, min(rec) as a, max(rec) as z from e where rec is not null and source <> 'rumour' group by all),
b as (select * from g qualify row_number() over (partition by unit order by p) = 1)"""


def _evidence(spark, d):
    li = table(spark, d, "lineitem")
    of = lambda c, n, *names: F.element_at(F.array(*map(F.lit, names)), (F.col(c) % n + 1).cast("int"))
    rows = li.select(F.col("l_orderkey").alias("unit"), of("l_suppkey", 4, "own_text", "position", "announcement", "rumour").alias("source"), of("l_partkey", 3, "reject", "accept", None).alias("rec"))
    return choices.preferred_evidence(rows, "unit", "source", "rec", ["own_text", "position", "announcement"])


@query(f"with {_EVIDENCE} select unit, case when a = z then a end as rec, source, case when a = z then 'settled' else 'conflict' end as state from b")
def f16_preferred_evidence(spark, d):
    return _evidence(spark, d)


@query(f"""with {_EVIDENCE}, s as (select o_orderkey, case o_orderstatus when 'F' then 'yes' when 'O' then 'no' else 'abstain' end as stance from orders)
select o_orderkey, stance, case when a = 'accept' and z = 'accept' then stance when a = 'reject' and z = 'reject' then case stance when 'yes' then 'no' when 'no' then 'yes' else stance end end as effective from s left join b on unit = o_orderkey""")
def f16_effective_by_evidence(spark, d):
    """What a stance means for the matter, by the best evidence of what was recommended; unknown where that is in conflict."""
    stance = F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no").otherwise("abstain")
    o = table(spark, d, "orders").select("o_orderkey", stance.alias("stance"))
    return o.join(_evidence(spark, d), F.col("unit") == F.col("o_orderkey"), "left").select("o_orderkey", "stance", T.effective_stance("stance", "rec").alias("effective"))


@query("""with recursive f as (select p_partkey as k from part), n as (select p_partkey as k, case when p_partkey % 50 = 7 then -1 when p_partkey > 1 then p_partkey // 2 end as need from part),
off(k, r) as (select k, 0 from f where k % 31 = 0 union select k, 0 from n where need not in (select k from f) union select n.k, off.r + 1 from off join n on n.need = off.k where off.r < 60),
m as (select k, min(r) as r from off group by 1)
select f.k as p_partkey, case when f.k % 31 = 0 then 'vetoed' when m.k is not null then 'blocked' else 'runs' end as state, case when f.k % 31 = 0 then 0 else m.r end as round from f left join m on m.k = f.k""")
def c13_feature_states(spark, d):
    p = table(spark, d, "part").select("p_partkey")
    k = F.col("p_partkey")
    needs = p.select("p_partkey", F.when(k % 50 == 7, F.lit(-1)).when(k > 1, F.floor(k / 2)).cast("long").alias("need"))
    return choices.feature_states(p, needs, p.filter(k % 31 == 0), "p_partkey", "need")


@query("""select o_custkey, count(*) as old_n, count(*) filter (o_orderkey % 500 <> 9) as new_n from orders group by 1 having count(*) filter (o_orderkey % 400 = 3 or o_orderkey % 500 = 9) > 0""")
def u10_differing_groups(spark, d):
    """Customers whose orders differ between two versions, by digests of their orders."""
    o = table(spark, d, "orders").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 100).cast("long"))
    new = o.filter("o_orderkey % 500 <> 9").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 400 == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return choices.differing_groups(o, new, "o_custkey")


@query("""with r as (select l_orderkey, '{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey || '}' as j from lineitem where l_quantity >= 45),
h as (select l_orderkey, sha256(j) as h from r)
select l_orderkey, count(*) as n, cast(sum(cast('0x' || substr(h, 1, 12) as hugeint)) as varchar) || '-' || cast(sum(cast('0x' || substr(h, 13, 12) as hugeint)) as varchar) || '-' || cast(sum(cast('0x' || substr(h, 25, 12) as hugeint)) as varchar) as digest
from h where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F') group by 1""")
def x30_selected_overrides(spark, d):
    """The overrides of the units asked for, and a digest of each unit's list whatever its order."""
    listed = table(spark, d, "lineitem").filter("l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_partkey")
    asked = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return choices.group_digests(listed.join(asked, "l_orderkey", "left_semi"), ["l_orderkey"])


@query("""with a as (select o_custkey as person, o_orderkey as item, o_orderpriority as label, o_orderstatus as state from orders),
b as (select person, item, case when item % 9 = 1 then 'X' else label end as label, case when item % 12 = 1 then 'Y' else state end as state from a where item % 10 <> 4 union all select person, item + 100000000, label, state from a where item % 25 = 0)
select coalesce(a.person, b.person) as person, coalesce(a.item, b.item) as item, case when b.item is null then 'lost' when a.item is null then 'gained' else 'changed' end as change,
 case when a.item is not null and b.item is not null then concat_ws(',', case when a.label <> b.label then 'label' end, case when a.state <> b.state then 'state' end) end as fields
from a full outer join b on a.person = b.person and a.item = b.item where a.item is null or b.item is null or a.label <> b.label or a.state <> b.state""")
def u7_person_pages(spark, d):
    i = F.col("item")
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("item"), F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("state"))
    kept = a.filter(i % 10 != 4).withColumns({"label": F.when(i % 9 == 1, "X").otherwise(F.col("label")), "state": F.when(i % 12 == 1, "Y").otherwise(F.col("state"))})
    return choices.page_changes(a, kept.unionByName(a.filter(i % 25 == 0).withColumn("item", i + 100_000_000)), "person", "item", ["label", "state"])


@query("""with recursive r as (select c_custkey as k, c_nationkey || ':' || cast(floor(c_acctbal / 100) as bigint) as a, c_mktsegment || ':' || c_nationkey || ':' || cast(floor((c_acctbal + 50) / 100) as bigint) as b from customer),
e as (select x.k as s, y.k as t from r x join r y on x.a = y.a or x.b = y.b), reach(s, t) as (select k, k from r union select reach.s, e.t from reach join e on e.s = reach.t)
select s as record, min(t) as person from reach group by 1""")
def g12_canonical_map(spark, d):
    """Every record with its person, the lowest record that shared keys lead to; records that share none are their own."""
    c = table(spark, d, "customer")
    key = lambda *parts: F.concat_ws(":", *[p.cast("string") for p in parts])
    r = c.select(F.col("c_custkey").alias("record"), F.explode(F.array(key(F.lit("a"), F.col("c_nationkey"), F.floor(F.col("c_acctbal") / 100)), key(F.lit("b"), F.col("c_mktsegment"), F.col("c_nationkey"), F.floor((F.col("c_acctbal") + 50) / 100)))).alias("k"))
    low = r.groupBy("k").agg(F.min("record").alias("low"))
    comp = graph.connected_components(r.join(low, "k").select(F.col("record").alias("src"), F.col("low").alias("dst")))
    return c.select(F.col("c_custkey").alias("record")).join(comp.withColumnRenamed("node", "record"), "record", "left").select("record", F.coalesce("component", "record").alias("person"))


@query("""with lead as (select l_orderkey, min_by(trim(p_name), (l_linenumber, p_partkey)) as topic from lineitem join part on l_partkey = p_partkey where p_size >= 10 and trim(p_name) <> '' group by 1)
select l_orderkey, l_linenumber, l_partkey, o_orderdate::date::varchar as day, c_name, topic from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey left join lead using (l_orderkey)""")
def j2_items_with_lead(spark, d):
    """Lines with their order, customer and the order's lead title."""
    li, o, c, p = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "part"))
    named = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", F.when(F.col("p_size") >= 10, F.trim("p_name")).alias("topic"), "l_linenumber", "p_partkey")
    lead = linking.lead_positions(named, "l_orderkey", "topic", ["l_linenumber", "p_partkey"])
    rows = li.select("l_orderkey", "l_linenumber", "l_partkey").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return rows.join(lead, "l_orderkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "c_name", "topic")


@query("""with h as (select o_orderkey, 'Beratung: ' || case o_orderkey % 3 when 0 then 'Haushalt und Finanzen' when 1 then 'ZP 4' else '' end as heading, [case when o_custkey % 4 = 0 then 'Antrag' end, case when o_custkey % 5 < 3 then 'Zweites Gesetz gegen Steuerbetrug' end, ' '] as titles from orders)
select o_orderkey, case when o_orderkey % 3 = 0 then 'Haushalt und Finanzen' when titles[2] is not null then titles[2] when o_orderkey % 3 = 1 then 'ZP 4' else titles[1] end as topic,
 case when o_orderkey % 3 = 0 then 'heading' when titles[2] is not null then 'title' when o_orderkey % 3 = 1 then 'short_heading' when titles[1] is not null then 'short_title' else 'none' end as origin from h""")
def f7_topic_choice(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    heading = F.concat(F.lit("Beratung: "), F.when(k % 3 == 0, "Haushalt und Finanzen").when(k % 3 == 1, "ZP 4").otherwise(""))
    titles = F.array(F.when(c % 4 == 0, F.lit("Antrag")), F.when(c % 5 < 3, F.lit("Zweites Gesetz gegen Steuerbetrug")), F.lit(" "))
    got = table(spark, d, "orders").select("o_orderkey", choices.topic_choice(heading, titles, ["^Beratung:"]).alias("x"))
    return got.select("o_orderkey", "x.topic", "x.origin")


@query("""select c_custkey, case when c_custkey % 6 < 5 then c_name end as name, case when c_custkey % 6 in (0, 4) then c_mktsegment when c_custkey % 6 = 1 then 'G ' || c_nationkey end as grp from customer""")
def x11_announced_askers(spark, d):
    """Chairs' announcements written from customers, and the askers read from them."""
    k, name, seg = F.col("c_custkey") % 6, F.col("c_name"), F.col("c_mktsegment")
    say = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    text = (
        F.when(k == 0, say("Wir kommen zu Frage 3 der Abgeordneten Dr. ", name, " (", seg, "):"))
        .when(k == 1, say("Frage 4 des Kollegen ", name, ", G ", F.col("c_nationkey").cast("string"), ":"))
        .when(k == 2, say("Frage 12 der Kollegin Prof. Dr. ", name, ":"))
        .when(k == 3, say("Frage 1 des Abgeordneten Niemand (X): entfällt.\nFrage 2 des Abgeordneten ", name, " :"))
        .when(k == 4, say("Ich rufe auf die Frage 7 der Abgeordneten ", name, "  (", seg, ") : Bitte."))
        .otherwise(say("Wir kommen zur nächsten Frage von Ihnen, ", name))
    )
    got = table(spark, d, "customer").select("c_custkey", choices.announced_asker(text).alias("x"))
    return got.select("c_custkey", "x.name", "x.grp")


@query("""select s_suppkey, s_name, cast(s_nationkey as integer) as s_nationkey from supplier""")
def k7_review_sheet(spark, d):
    """A sheet for review, written with tabs and read again."""
    at = f"{run_dir(spark)}/sheet-{uuid.uuid4().hex}"
    sinks.review_sheet(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), at)
    return landing.read_csv_strict(spark, at, "s_suppkey long, s_name string, s_nationkey int", sep="\t")


@query("""select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderstatus desc, o_orderdate desc, case when o_orderkey % 3 > 0 then 0 else 1 end, o_orderkey) as position from orders""")
def t6_stable_order(spark, d):
    """Orders of a customer in one order of four keys: no two are equal."""
    o = table(spark, d, "orders")
    keys = [F.desc("o_orderstatus"), F.desc("o_orderdate"), F.when(F.col("o_orderkey") % 3 > 0, 0).otherwise(1), S.id_sort_key("o_orderkey")]
    return choices.ordered_output(o, ["o_custkey"], keys).select("o_custkey", "o_orderkey", F.col("position").cast("long").alias("position"))
