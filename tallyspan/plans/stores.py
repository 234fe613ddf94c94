"""Rows of the store: documents with their rank, resolved speakers, roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.operators import writers
from tallyspan.plans.registry import query
from tallyspan.tables import table

_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query("""with r as (select l_orderkey as item, l_partkey % 50 as doc, case when l_suppkey % 2 = 0 then 'xml' else 'api' end as source, case when l_suppkey % 3 > 0 then 'https://d.example.org/' || l_suppkey end as url,
 row_number() over (order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as o from lineitem),
g as (select item, doc, source, min(o) as first_, case when source = 'xml' then max_by(url, o) filter (url is not null) else min_by(url, o) filter (url is not null) end as url from r group by item, doc, source)
select item, doc, source, url, row_number() over (partition by item, source order by first_, doc) as rank from g""")
def x1_document_links(spark, d):
    li = table(spark, d, "lineitem")
    refs = li.select(
        F.col("l_orderkey").alias("item"), (F.col("l_partkey") % 50).alias("doc"), F.when(F.col("l_suppkey") % 2 == 0, "xml").otherwise("api").alias("source"),
        F.when(F.col("l_suppkey") % 3 > 0, F.concat(F.lit("https://d.example.org/"), F.col("l_suppkey").cast("string"))).alias("url"), *_ORDER,
    )
    return writers.document_links(refs, "item", "doc", "source", _ORDER, "url", ("xml",)).withColumn("rank", F.col("rank").cast("bigint"))


@query("""with u as (select o_orderkey as unit, o_orderstatus as status, o_orderpriority as prio, case when o_custkey % 5 > 0 then o_custkey end as trusted, case when o_custkey % 3 > 0 then o_custkey + 7 end as outer_no from orders),
f as (select l_orderkey as unit, max(l_returnflag) as prio from lineitem where l_quantity = 50 group by 1)
select u.unit, coalesce(f.prio, u.prio) as prio, case when coalesce(f.prio, u.prio) like '%-%' then split_part(coalesce(f.prio, u.prio), '-', 2) else 'corrected' end as speaker_group,
coalesce('trusted:' || trusted, 'outer:' || outer_no, 'name:' || coalesce(f.prio, u.prio)) as speaker_key from u left join f on u.unit = f.unit""")
def x2_resolved_speakers(spark, d):
    k = F.col("o_custkey")
    u = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit"), F.col("o_orderpriority").alias("prio"), F.when(k % 5 > 0, k).alias("trusted"), F.when(k % 3 > 0, k + 7).alias("outer_no"))
    fixes = table(spark, d, "lineitem").filter("l_quantity = 50").groupBy(F.col("l_orderkey").alias("unit")).agg(F.max("l_returnflag").alias("prio"))
    group = F.when(F.col("prio").contains("-"), F.split_part("prio", F.lit("-"), F.lit(2))).otherwise("corrected")
    got = writers.resolve_speakers(u, fixes, "unit", ["prio"], group, [("trusted", F.col("trusted")), ("outer", F.col("outer_no")), ("name", F.col("prio"))])
    return got.select("unit", "prio", "speaker_group", "speaker_key")


_SIDES = {"automobile": "government", "building": "council", "furniture": "government"}


@query("""with r as (select c_custkey as k, case when c_custkey % 3 = 0 then c_mktsegment end as a, case when c_custkey % 4 = 0 then ' ' || c_mktsegment || ' ' end as b,
 case when c_custkey % 6 = 0 then 'BUILDING' when c_custkey % 5 = 0 then c_mktsegment end as p, case when c_nationkey > 12 then 'G' || c_nationkey end as g from customer),
s as (select *, trim(coalesce(a, b)) as st, case when lower(p) in ('automobile', 'building', 'furniture') then p end as pr from r),
t as (select *, case lower(st) when 'automobile' then 'government' when 'furniture' then 'government' when 'building' then 'council' end as s1, case lower(pr) when 'automobile' then 'government' when 'furniture' then 'government' when 'building' then 'council' end as s2 from s)
select k, coalesce(s1 <> s2, false) as role_conflict, case when not coalesce(s1 <> s2, false) then coalesce(st, pr) end as role, case when coalesce(st, pr) is not null then 'official' when g is not null then 'member' end as speaker_class from t""")
def x11_effective_roles(spark, d):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    rows = table(spark, d, "customer").select(
        k.alias("k"), F.when(k % 3 == 0, seg).alias("a"), F.when(k % 4 == 0, F.concat(F.lit(" "), seg, F.lit(" "))).alias("b"),
        F.when(k % 6 == 0, "BUILDING").when(k % 5 == 0, seg).alias("p"), F.when(F.col("c_nationkey") > 12, F.concat(F.lit("G"), F.col("c_nationkey").cast("string"))).alias("g"),
    )
    return writers.effective_roles(rows, "a", "b", "p", "g", _SIDES).select("k", "role_conflict", "role", "speaker_class")


@query("""with r as (select l_partkey as position, row_number() over (order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_orderkey) as o, case when l_suppkey % 3 = 0 then 'T' || l_suppkey end as title,
 case when l_quantity > 25 then l_comment_ end as abstract, case when l_linenumber % 2 = 0 then l_orderkey end as item from (select *, 'A' || l_orderkey as l_comment_ from lineitem))
select position, min_by(title, o) filter (title is not null) as title, max_by(abstract, o) filter (abstract is not null) as abstract, (list(item order by o desc))[1] as item from r group by position""")
def x1_positions(spark, d):
    """Positions that come up again: the first title stays, the last abstract counts, the item is the newest sighting's."""
    li = table(spark, d, "lineitem")
    rows = li.select(
        F.col("l_partkey").alias("position"), *[c for c in _ORDER], "l_orderkey", F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("T"), F.col("l_suppkey").cast("string"))).alias("title"),
        F.when(F.col("l_quantity") > 25, F.concat(F.lit("A"), F.col("l_orderkey").cast("string"))).alias("abstract"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey")).alias("item"),
    )
    return writers.settled(rows, "position", [*_ORDER, "l_orderkey"], ("title",), ("abstract",), ("item",))


def _reports(spark, d):
    """A nested report for each customer: orders are items, their lines units; some have a number of their own, some an id."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    k = F.col("l_partkey")
    unit = F.struct(
        F.when(k % 5 == 0, F.col("l_linenumber") + 100).alias("sequence"), F.when(k % 3 == 0, F.concat(F.lit("R"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string"), F.lit("/"), k.cast("string"))).alias("given"),
        F.element_at(F.array(*map(F.lit, ("question", "answer", "interjection", "?"))), (k % 4 + 1).cast("int")).alias("kind"),
        F.when(k % 7 > 0, F.col("l_suppkey")).alias("number"), F.concat(F.lit(" S"), F.col("l_suppkey").cast("string")).alias("name"), F.concat(F.lit("G"), (F.col("l_suppkey") % 6).cast("string")).alias("grp"),
    )
    per = li.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct(*_ORDER, unit.alias("u")))), lambda x: x["u"]).alias("units"))
    items = o.join(per, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "units"))).alias("items"))
    return writers.spoken_units(items, "o_custkey", "items", "units", "sequence", "given")


_UNITS = """l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as pos from lineitem),
i as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as item_no from orders where o_orderkey in (select l_orderkey from lineitem)),
u as (select o_custkey, item_no, case when l_partkey % 5 = 0 then l_linenumber + 100 else pos end as sequence, case when l_partkey % 3 = 0 then 'R' || l_orderkey || '/' || l_suppkey || '/' || l_partkey end as given,
 ['question', 'answer', 'interjection', '?'][l_partkey % 4 + 1] as kind, case when l_partkey % 7 > 0 then l_suppkey end as number, 'S' || l_suppkey as name, 'G' || (l_suppkey % 6) as grp from i join l on l_orderkey = o_orderkey),
v as (select *, o_custkey || '#' || coalesce(given, 'item-' || item_no || '-' || sequence) as unit_id from u)"""


@query(f"with {_UNITS} select o_custkey, item_no, sequence, unit_id from v")
def x1_spoken_units(spark, d):
    return _reports(spark, d).select("o_custkey", "item_no", "sequence", "unit_id")


@query(f"""with {_UNITS} select unit_id, sequence, kind, kind = '?' as refused, 'no:' || number as speaker_key, name as speaker_name, case when number is not null and kind <> 'interjection' then grp end as speaker_group from v""")
def x1_contributions(spark, d):
    got = writers.contribution_speakers(_reports(spark, d), "kind", ("question", "answer", "interjection"), "number", "name", "grp", ("interjection",))
    return got.select("unit_id", "sequence", "kind", "refused", "speaker_key", "speaker_name", "speaker_group")


@query("""select l_suppkey as person, min_by(p, o) filter (p is not null) as place, max(l_orderkey) as last_seen from (select l_suppkey, l_orderkey, case when l_partkey % 4 = 0 then l_partkey end as p, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as o from lineitem) group by 1""")
def x1_sampled_people(spark, d):
    li = table(spark, d, "lineitem").withColumn("place", F.when(F.col("l_partkey") % 4 == 0, F.col("l_partkey"))).withColumn("seen", F.col("l_orderkey"))
    got = writers.settled(li, "l_suppkey", ["l_orderkey", *_ORDER], first=("place",), newest=("seen",))
    return got.select(F.col("l_suppkey").alias("person"), "place", F.col("seen").alias("last_seen"))


_TAGS = """t as (select l_orderkey, p_brand as tag, min(l_linenumber * 1000000 + l_suppkey) as o from lineitem join part on l_partkey = p_partkey where p_size > 10 group by 1, 2)"""


def _tags(spark, d):
    p = table(spark, d, "part").filter("p_size > 10")
    li = table(spark, d, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"))
    answers = li.select(F.col("l_orderkey").alias("o_orderkey"), F.col("p_brand").alias("tag"), "l_linenumber", "l_suppkey")
    owners = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return writers.ranked_answers(owners, answers, "o_orderkey", "tag", ["l_linenumber", "l_suppkey"], F.col("o_orderstatus") != "F")


@query(f"with {_TAGS} select l_orderkey as o_orderkey, tag, row_number() over (partition by l_orderkey order by o, tag) as rank from t where l_orderkey in (select o_orderkey from orders)")
def x3_ranked_tags(spark, d):
    return _tags(spark, d)[0]


@query(f"with {_TAGS}, n as (select l_orderkey, count(*) as n from t group by 1) select o_orderkey, case when n is not null then 'answered' when o_orderstatus <> 'F' then 'none' else 'not_asked' end as state, coalesce(n, 0) as n from orders left join n on l_orderkey = o_orderkey")
def x3_answer_states(spark, d):
    """Every owner has its state, those without a tag too."""
    return _tags(spark, d)[1]
