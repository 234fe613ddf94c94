"""Document trees, annexes and attachments to neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.operators import trees, units
from tallyspan.plans.registry import query
from tallyspan.session import materialize
from tallyspan.tables import table


def _tree(spark, d):
    """Conversations as XML documents: items with units, units between items, a table of contents."""
    t, c = F.col("turn"), F.col("conv_id")
    n = c + t
    say = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "")
    text = F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    unit = say('<unit id="u', t, '"><p>', text, "</p></unit>")
    part = (
        F.when(n % 3 == 0, say('<item id="i', t, '"', F.when(n % 2 == 0, say(' mark="m', t % 2, '"')).otherwise(""), ">", unit, "</item>"))
        .when(n % 3 == 1, unit)
        .otherwise(say('<item id="i', t, '"><group mark="g">', unit, "</group></item>"))
    )
    ref = lambda page: say('<ref rid="u', t, '" page="', page, '"/>')
    refs = F.concat(F.when(n % 7 != 0, ref(t + 1)).otherwise(""), F.when(n % 5 == 0, ref(t + 2)).otherwise(""), F.when((c * t) % 11 == 5, say('<ref rid="u', t, '" annex="1"/>')).otherwise(""))
    each = table(spark, d, "conversations").select("conv_id", "turn", part.alias("part"), refs.alias("refs"))
    g = each.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "part", "refs"))).alias("x"))
    of = lambda name: F.array_join(F.transform("x", lambda s: s[name]), "")
    docs = g.select("conv_id", F.concat(F.lit("<doc><toc>"), of("refs"), F.lit("</toc><body>"), of("part"), F.lit("</body></doc>")).alias("xml"))
    return trees.tree_nodes(docs, "conv_id", "xml")


@query("""with t as (select conv_id, turn, (conv_id + turn) % 3 as s, conv_id + turn as n, (conv_id * turn) % 11 = 5 as gone from conversations),
i as (select *, max(case when s <> 1 then turn end) over (partition by conv_id order by turn) as before from t),
p as (select *, n % 5 = 0 and n % 7 <> 0 as conflict, case when n % 5 = 0 and n % 7 <> 0 then null when n % 7 <> 0 then turn + 1 when n % 5 = 0 then turn + 2 end as page from i)
select conv_id, 'u' || turn as unit, 'i' || before as item, case when s <> 1 then 'inside' when before is not null then 'adopted' else 'none' end as place,
 case when s = 2 then 'g' when before is not null and (conv_id + before) % 3 = 0 and (conv_id + before) % 2 = 0 then 'm' || (before % 2) end as mark, cast(page as integer) as page,
 case when before is null then 'unplaced' when conflict then 'page_conflict' when page is null then 'no_page' else 'placed' end as state from p where not gone""")
def q1_tree_pass(spark, d):
    nodes = materialize(_tree(spark, d), "tree")
    tag, attr = F.col("tag"), lambda name: F.element_at("attrs", F.lit(name))
    excluded = nodes.filter((tag == "ref") & attr("annex").isNotNull()).select("conv_id", attr("rid").alias("unit"))
    refs = nodes.filter((tag == "ref") & attr("page").isNotNull()).select("conv_id", attr("rid").alias("unit"), attr("page").cast("int").alias("page"))
    return trees.placed_units(nodes, "conv_id", tag == "unit", tag == "item", attr("id"), attr("mark"), excluded, refs)


@query("""select conv_id, count(*) as n_texts, cast(sum(length(text)) as bigint) as n_chars from conversations group by 1""")
def q1_tree_texts(spark, d):
    """Texts written into trees and read from their paragraphs again."""
    got = _tree(spark, d).filter("tag = 'p'")
    return got.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("text")).alias("n_chars"))


@query("""with e as (select coalesce(user_id, -1) as unit, ts, event_id, event_type = 'signup' as h, case when event_type = 'click' then 'T' || (event_id % 4) end as ref, case when event_type = 'view' and event_id % 3 = 0 then event_id % 50 end as page, event_type from events),
c as (select *, sum(h::bigint) over (partition by unit order by ts, event_id) as context, last_value(page ignore nulls) over (partition by unit order by ts, event_id) as p from e),
l as (select *, list_distinct(list(ref) filter (ref is not null) over (partition by unit, context order by ts, event_id)) as refs from c),
i as (select coalesce(user_id, -1) as unit, 'T' || (event_id % 4) as item, count(*) as n from events where event_type = 'error' and event_id % 10 = 0 group by all)
select event_id, context, p as page, case when len(refs) = 1 and n = 1 then refs[1] end as item, case when coalesce(len(refs), 0) = 0 then 'unreferenced' when len(refs) = 1 and n = 1 then 'assigned' else 'ambiguous' end as state
from l left join i on i.unit = l.unit and i.item = refs[1] where event_type = 'purchase'""")
def x10_annex_submissions(spark, d):
    i, kind = F.col("event_id"), F.col("event_type")
    name = F.concat(F.lit("T"), (i % 4).cast("string"))
    e = table(spark, d, "events").withColumn("unit", F.coalesce("user_id", F.lit(-1)))
    items = e.filter((kind == "error") & (i % 10 == 0)).select("unit", name.alias("item"))
    got = trees.annex_places(e, "unit", ["ts", "event_id"], kind == "signup", F.when(kind == "click", name), F.when((kind == "view") & (i % 3 == 0), i % 50), kind == "purchase", items, "item")
    return got.select("event_id", "context", "page", "item", "state")


_ATTACH = """e as (select coalesce(user_id, -1) as unit, event_id, row_number() over (partition by coalesce(user_id, -1) order by ts, event_id) as rn, case when event_type in ('click', 'view') and event_id % 9 = 0 then 'both' when event_type = 'click' then 'back' when event_type = 'view' then 'ahead' else 'own' end as way from events),
ch(unit, rn, way, cur) as (
 select unit, rn, way, rn + if(way = 'back', -1, 1) from e where way in ('back', 'ahead')
 union all
 select ch.unit, ch.rn, ch.way, ch.cur + if(ch.way = 'back', -1, 1) from ch join e on e.unit = ch.unit and e.rn = ch.cur and e.way = ch.way),
en as (select unit, rn, if(way = 'back', min(cur), max(cur)) as cur from ch group by unit, rn, way),
fin as (select e.unit, e.rn, e.event_id, e.way, case when t.way = 'own' then t.event_id end as root from e left join en on en.unit = e.unit and en.rn = e.rn left join e t on t.unit = en.unit and t.rn = en.cur)"""


def _attached(spark, d):
    i, kind = F.col("event_id"), F.col("event_type")
    both = kind.isin("click", "view") & (i % 9 == 0)
    e = table(spark, d, "events").select(F.coalesce("user_id", F.lit(-1)).alias("unit"), "ts", "event_id", "event_type")
    return units.attached(e, "unit", ["ts", "event_id"], (kind == "click") | both, (kind == "view") | both)


@query(f"with recursive {_ATTACH} select event_id, coalesce(root, event_id) as root, case when root is not null then if(way = 'back', 'suffix', 'prefix') end as side, case when way = 'own' then 'own' when root is not null then 'attached' else 'refused' end as state from fin")
def q5_attached_turns(spark, d):
    return _attached(spark, d).select("event_id", F.col("root.event_id").alias("root"), "side", "state")


@query(f"with recursive {_ATTACH} select coalesce(root, event_id) as root, count(*) as n_rows, string_agg(event_id, ',' order by rn) as rows from fin group by 1")
def q5_merged_turns(spark, d):
    """Turns with what became their prefix and suffix, in order; every row stands in one of them."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id"))), lambda s: s["event_id"].cast("string"))
    return _attached(spark, d).groupBy(F.col("root.event_id").alias("root")).agg(F.count(F.lit(1)).alias("n_rows"), F.array_join(parts, ",").alias("rows"))
