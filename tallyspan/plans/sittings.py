"""Ordered records: nested speakers, headings and formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.operators import units
from tallyspan.plans.registry import query
from tallyspan.tables import table

#: A user's events as a unit: purchases name the next speaker, clicks are the chair's words, all others are text.
_ROWS = """rows_ as (select user_id as unit, ts, event_id, event_type = 'purchase' as m, event_type = 'click' as c, case when event_type = 'purchase' then event_id % 4 end as speaker,
case when event_type = 'purchase' then 'S' || (event_id % 4) end as name, case when event_type = 'click' then 'Das Wort hat S' || (event_id % 4) when event_id % 3 = 0 then 'Sehr geehrte Damen' else 'Nein' end as text,
user_id % 4 as owner, event_id % 7 = 0 as q from events where user_id is not null)"""
SPLIT = f"""{_ROWS},
s1 as (select *, coalesce(sum(m::int) over (partition by unit order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as s from rows_),
s2 as (select *, coalesce(contains(string_agg(case when c then text end, ' ') over (partition by unit, s), name), false) as granted,
 coalesce(starts_with(first_value(case when not m and not c then text end ignore nulls) over (partition by unit order by ts, event_id rows between 1 following and unbounded following), 'Sehr geehrte'), false) as greets from s1),
s3 as (select *, m and granted and not q and greets as fit from s2),
s4 as (select *, fit and coalesce(last_value(case when fit then speaker end ignore nulls) over (partition by unit order by ts, event_id rows between unbounded preceding and 1 preceding), owner) is distinct from speaker as fresh from s3),
s5 as (select *, sum(fresh::int) over (partition by unit order by ts, event_id) as no, coalesce(last_value(case when fresh then speaker end ignore nulls) over (partition by unit order by ts, event_id), owner) as holder,
 case when not m then null when fresh then 'split' when fit then 'same_speaker' when not granted then 'not_granted' when q then 'question' else 'no_salutation' end as ruling from s4)"""


def _split(spark, d):
    e, i = table(spark, d, "events").filter("user_id is not null"), F.col("event_id")
    m, c = F.col("event_type") == "purchase", F.col("event_type") == "click"
    said = F.when(c, F.concat(F.lit("Das Wort hat S"), (i % 4).cast("string"))).when(i % 3 == 0, "Sehr geehrte Damen").otherwise("Nein")
    rows = e.select(
        F.col("user_id").alias("unit"), "ts", "event_id", "event_type", F.when(m, i % 4).alias("speaker"), F.when(m, F.concat(F.lit("S"), (i % 4).cast("string"))).alias("name"),
        said.alias("text"), (F.col("user_id") % 4).alias("owner"),
    )
    return units.split_nested(rows, "unit", ["ts", "event_id"], m, c, "speaker", "name", "text", "owner", i % 7 == 0, "^Sehr geehrte")


@query(f"with {SPLIT} select unit || case when no = 0 then '' else ':' || no end as part, any_value(holder) as part_owner, count(*) as n_rows, min(event_id) as first_event from s5 group by unit, no")
def q2_nested_units(spark, d):
    got = _split(spark, d)
    return got.groupBy("part").agg(F.min("part_owner").alias("part_owner"), F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_event"))


@query(f"with {SPLIT} select ruling, count(*) as n, count(distinct unit) as n_units from s5 where m group by 1")
def q5_marker_rulings(spark, d):
    return _split(spark, d).filter("ruling is not null").groupBy("ruling").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("unit").alias("n_units"))


@query("""with l as (select o_custkey as scope, o_orderkey as item, o_orderdate, o_orderpriority as label, o_orderstatus as format, l_linenumber, l_partkey, p_name, split_part(p_type, ' ', 1) as kind
 from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey),
h as (select item, coalesce(string_agg(p_name, ' ' order by l_linenumber, l_partkey, p_name) filter (kind = 'STANDARD'), string_agg(p_name, ' ' order by l_linenumber, l_partkey, p_name) filter (kind = 'ECONOMY')) as heading from l group by 1),
i as (select o_custkey as scope, o_orderkey as item, o_orderdate, o_orderpriority as label, o_orderstatus as format, heading from orders left join h on item = o_orderkey)
select item, heading, case when heading is not null then format else coalesce(first_value(case when heading is not null then format end ignore nulls) over (partition by scope, label order by o_orderdate, item rows between unbounded preceding and 1 preceding), format) end as inherited from i""")
def q8_headings_and_formats(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.select(F.col("l_orderkey").alias("item"), "l_linenumber", "l_partkey", "p_name", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("kind"))
    heads = units.item_headings(lines, ["item"], ["l_linenumber", "l_partkey"], "kind", "p_name", "STANDARD", "ECONOMY")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("scope"), F.col("o_orderkey").alias("item"), "o_orderdate", F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("format"))
    return units.inherited_format(o.join(heads, "item", "left"), "scope", "label", ["o_orderdate", "item"], "heading", "format").select("item", "heading", "inherited")


@query(f"with {SPLIT} select (select count(*) from rows_) as n_source, count(*) as n_parts_rows, count(*) - count(distinct event_id) as n_repeated from s5")
def q9_parts_conserve_rows(spark, d):
    """Every source row stands in exactly one part."""
    got = _split(spark, d)
    n = table(spark, d, "events").filter("user_id is not null").agg(F.count(F.lit(1)).alias("n_source"))
    return n.crossJoin(got.agg(F.count(F.lit(1)).alias("n_parts_rows"), (F.count(F.lit(1)) - F.count_distinct("event_id")).alias("n_repeated")))  # one row each
