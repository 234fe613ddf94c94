"""Composed cases: repairs, corrections, replays, audits and exchanges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import texts as T
from tallyspan.operators import diffs, histories, identity, plurality, ranking
from tallyspan.plans import bindings as B
from tallyspan.plans.aggregates import STATES
from tallyspan.plans.registry import query
from tallyspan.plans.windows import w13_turn_kinds
from tallyspan.tables import table

_MERGED = STATES.replace("'G' || n_regionkey as grp", "case when n_regionkey < 2 then 'west' else 'G' || n_regionkey end as grp")


@query(f"with {_MERGED} select * from groups")
def x4_label_merge_repair(spark, d):
    merged = B.members(spark, d).withColumn("grp", F.when(F.col("grp").isin("G0", "G1"), "west").otherwise(F.col("grp")))
    latest = plurality.latest_members(merged, "vote", "member", B.LINE_ORDER)
    return plurality.deviators(latest, B.counts(spark, d, latest), "vote", ("G4",))


@query("""with v as (select l_partkey as vote, 0 as level, l_orderkey as at_order, l_linenumber as at_line from lineitem union all select o_orderkey % 2500, 1, o_orderkey, 0 from orders)
select vote, level, at_order, at_line from v qualify row_number() over (partition by vote order by level, at_order, at_line) = 1""")
def x5_vote_flattening(spark, d):
    items = table(spark, d, "lineitem").select(F.col("l_partkey").alias("vote"), F.lit(0).alias("level"), F.col("l_orderkey").alias("at_order"), F.col("l_linenumber").alias("at_line"))
    whole = table(spark, d, "orders").select((F.col("o_orderkey") % 2500).alias("vote"), F.lit(1).alias("level"), F.col("o_orderkey").alias("at_order"), F.lit(0).alias("at_line"))
    return ranking.first_rows(items.unionByName(whole), ["vote"], [F.col("level"), F.col("at_order"), F.col("at_line")])


@query(f"""with {B.COUNTS}, mv as (select vote, grp, stance, count(*) as n from latest where member % 10 = 3 and grp <> 'G0' group by 1, 2, 3),
f as (select mv.vote, coalesce(n <= case stance when 'yes' then yes when 'no' then no when 'abstain' then abstain else absent end, false) as fits from mv left join counts c on mv.vote = c.vote and mv.grp = c.grp)
select vote, bool_and(fits) as accepted from f group by 1""")
def x6_group_correction(spark, d):
    latest = B.latest(spark, d)
    moves = latest.filter("member % 10 = 3 and grp <> 'G0'").select("vote", F.col("grp").alias("from_grp"), F.lit("G0").alias("to_grp"), "stance")
    return plurality.absorbable(moves, B.counts(spark, d, latest), "vote")


@query("""select 'repeated_key' as name, (select count(*) from (select c_custkey from customer group by 1 having count(*) > 1)) as n union all select 'unknown_nation', (select count(*) from customer where c_nationkey not in (select n_nationkey from nation))
union all select 'negative_balance', (select count(*) from customer where c_acctbal < 0) union all select 'no_orders', (select count(*) from customer where c_custkey not in (select o_custkey from orders))""")
def x7_master_data_checks(spark, d):
    c = table(spark, d, "customer")
    n = F.count(F.lit(1)).alias("n")
    found = {
        "repeated_key": c.groupBy("c_custkey").agg(n).filter("n > 1"),
        "unknown_nation": c.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left_anti"),
        "negative_balance": c.filter("c_acctbal < 0"),
        "no_orders": c.join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti"),
    }
    out = None
    for name, rows in found.items():
        one = rows.agg(F.lit(name).alias("name"), n)
        out = one if out is None else out.unionByName(one)
    return out


@query("""select doc_id, case when (regexp_matches(text, 'MIT License')::int + regexp_matches(text, 'Apache License')::int + regexp_matches(text, 'General Public License')::int) = 1 and not regexp_matches(text, 'token = ')
then case when regexp_matches(text, 'MIT License') then 'mit' when regexp_matches(text, 'Apache License') then 'apache' else 'gpl' end end as outcome from documents""")
def x12_only_outcome(spark, d):
    words = {"mit": "MIT License", "apache": "Apache License", "gpl": "General Public License"}
    return table(spark, d, "documents").select("doc_id", T.only_outcome("text", words, "token = ").alias("outcome"))


@query("""with l as (select l_orderkey, l_returnflag, l_suppkey * 100000 + l_partkey as id, l_linenumber, l_extendedprice, l_shipdate, l_discount from lineitem),
a as (select l_orderkey, l_returnflag, id, row_number() over (partition by l_orderkey, l_returnflag order by l_linenumber, id, l_extendedprice) as n from l),
b as (select l_orderkey, l_returnflag, id, row_number() over (partition by l_orderkey, l_returnflag order by l_shipdate, id, l_extendedprice) as n from l where l_discount > 0.01)
select a.id as old_id, b.id as new_id from a full join b on a.l_orderkey = b.l_orderkey and a.l_returnflag = b.l_returnflag and a.n = b.n""")
def x14_replay_mapping(spark, d):
    li = table(spark, d, "lineitem").withColumn("id", F.col("l_suppkey") * 100000 + F.col("l_partkey"))
    return histories.replayed(li, li.filter("l_discount > 0.01"), ["l_orderkey", "l_returnflag"], ["l_linenumber", "id", "l_extendedprice"], ["l_shipdate", "id", "l_extendedprice"], "id", "id")


@query("""with a as (select l_orderkey, count(*) as n from lineitem group by 1), b as (select l_orderkey, count(*) as n from lineitem where l_suppkey <> 3 group by 1)
select a.l_orderkey, a.n as old_n, b.n as new_n, case when b.n is null then 'removed' else 'changed' end as change from a left join b on a.l_orderkey = b.l_orderkey where a.n is distinct from b.n""")
def x25_leave_one_out(spark, d):
    per = lambda x: x.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    li = table(spark, d, "lineitem")
    return diffs.diff(per(li), per(li.filter("l_suppkey <> 3")), ["l_orderkey"], ["n"])


@query("""with x as (select lang, case when l.doc_id is null then 'unresolved' when quality = 1 and toxic = 1 then 'm1' when quality = 1 then 'm1a' when toxic = 1 then 'm1b' else 'none' end as c from documents d left join labels l on d.doc_id = l.doc_id)
select lang, c as category, count(*) as n from x group by 1, 2""")
def x26_match_categories(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels").withColumn("have", F.lit(1)), "doc_id", "left")
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    c = F.when(F.col("have").isNull(), "unresolved").when(q & t, "m1").when(q, "m1a").when(t, "m1b").otherwise("none")
    return x.groupBy("lang", c.alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("""with a as (select o_custkey, year(o_orderdate) as term, count(*) as n from orders where o_orderstatus <> 'P' group by 1, 2), b as (select o_custkey, year(o_orderdate) as term, count(*) as n from orders where o_orderstatus <> 'F' group by 1, 2),
x as (select coalesce(a.o_custkey, b.o_custkey) as k, coalesce(a.term, b.term) as term, a.n as an, b.n as bn from a full join b on a.o_custkey = b.o_custkey and a.term = b.term)
select cast(term as bigint) as term, count(*) filter (an is not null and bn is not null) as both_sides, count(*) filter (bn is null) as only_left, count(*) filter (an is null) as only_right, count(*) filter (an <> bn) as differing from x where k % 25 <> 4 group by 1""")
def x27_comparison_rollup(spark, d):
    per = lambda s, n: table(spark, d, "orders").filter(F.col("o_orderstatus") != s).groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("term")).agg(F.count(F.lit(1)).alias(n))
    x = per("P", "an").join(per("F", "bn"), ["o_custkey", "term"], "full_outer")
    known = table(spark, d, "customer").filter("c_custkey % 25 = 4").select(F.col("c_custkey").alias("o_custkey"))
    return diffs.comparison_rollup(x.join(known, "o_custkey", "left_anti"), "term", "an", "bn")


@query("""select count(*) as n, sha256('[' || string_agg('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}', ',' order by n_name, n_regionkey) || ']') as digest from nation""")
def x30_override_digest(spark, d):
    rows = F.array_sort(F.collect_list(F.struct("n_name", "n_regionkey")))
    return table(spark, d, "nation").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.to_json(rows), 256).alias("digest"))


@query("""select o_custkey, count(*) as n_orders, string_agg(o_orderkey || '=' || lines, '; ' order by o_orderkey) as sheet from (select o_custkey, o_orderkey, count(*) as lines from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'F' group by 1, 2) group by 1""")
def x31_evidence_sheet(spark, d):
    x = table(spark, d, "orders").filter("o_orderstatus = 'F'").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "o_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "lines"))), lambda s: F.concat(s["o_orderkey"].cast("string"), F.lit("="), s["lines"].cast("string")))
    return x.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.array_join(parts, "; ").alias("sheet"))


@query("""with r as (select c_custkey as r, c_mktsegment || ':' || c_nationkey as p, case when c_custkey % 3 = 0 then c_custkey % 7 end as i from customer), g as (select p, min(r) as dst from r group by 1 having count(distinct i) <= 1)
select r as src, dst from r join g on r.p = g.p where r <> dst""")
def g3_presented_identity(spark, d):
    r = table(spark, d, "customer").select(F.col("c_custkey").alias("r"), F.concat_ws(":", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("p"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 7).alias("i"))
    return identity.presented_edges(r, "r", "p", ["i"])


@query("""with r as (select c_custkey as r, cast(floor(c_acctbal / 50) as bigint) as weak, c_mktsegment as name from customer), g as (select weak, name, min(r) as dst from r group by 1, 2) select r as src, dst from r join g on r.weak = g.weak and r.name = g.name where r <> dst""")
def g4_corroborated_weak_id(spark, d):
    r = table(spark, d, "customer").select(F.col("c_custkey").alias("r"), F.floor(F.col("c_acctbal") / 50).alias("weak"), F.col("c_mktsegment").alias("name"))
    return identity.corroborated_edges(r, "r", "weak", "name")


_TURNS = """t as (select conv_id, turn, role, text, lag(role) over (partition by conv_id order by turn) as before from conversations),
k as (select *, role = 'user' and before is distinct from 'user' as q from t), e as (select *, cast(sum(case when q then 1 else 0 end) over (partition by conv_id order by turn) as bigint) as exchange from k)"""


@query(f"""with {_TURNS} select conv_id, exchange, count(*) as n_turns, count(*) filter (role not in ('user', 'system') and before = 'user') as n_answers, cast(sum(length(text)) as bigint) as n_chars from e group by 1, 2""")
def q3_segments(spark, d):
    return histories.segments(w13_turn_kinds(spark, d), table(spark, d, "conversations"), "conv_id", "turn", "text")


@query(f"""with {_TURNS}, bad as (select conv_id from t where role = 'user' and before = 'user' group by 1) select conv_id, count(*) as n, 'accepted' as state from t where conv_id not in (select conv_id from bad) group by 1
union all select conv_id, count(*), 'quarantined' from t where role = 'user' and before = 'user' group by 1""")
def q6_commit_on_finish(spark, d):
    kinds = w13_turn_kinds(spark, d)
    good, held = histories.commit_on_finish(kinds, "conv_id", F.col("kind") == "follow_up")
    accepted = good.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("state", F.lit("accepted"))
    return accepted.unionByName(held.select("conv_id", F.col("n_refused").alias("n"), F.lit("quarantined").alias("state")))


@query("""select conv_id, turn, (select min(b.turn) from conversations b where b.conv_id = a.conv_id and b.role = 'assistant' and b.turn > a.turn) as reply from conversations a where role = 'user'""")
def q7_first_reply(spark, d):
    return histories.first_reply(table(spark, d, "conversations"), "conv_id", "turn", "role", "user", "assistant")


@query("""with h as (select sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') as h from nation)
select count(*) as n, cast(sum(cast('0x' || substr(h, 1, 12) as hugeint)) as varchar) || '-' || cast(sum(cast('0x' || substr(h, 13, 12) as hugeint)) as varchar) || '-' || cast(sum(cast('0x' || substr(h, 25, 12) as hugeint)) as varchar) as digest from h""")
def u10_table_digest(spark, d):
    return diffs.digest(table(spark, d, "nation"))


@query("""select o_orderkey, case when o_orderkey % 4 = 0 then o_custkey end as trusted from orders""")
def x8_trusted_id(spark, d):
    match = F.when(F.col("o_orderkey") % 4 == 0, "ext_id").otherwise("name")
    return table(spark, d, "orders").select("o_orderkey", F.when(match == "ext_id", F.col("o_custkey")).alias("trusted"))
