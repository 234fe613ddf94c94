"""Aggregations: pluralities, deviations, folds and guarded statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.operators import diffs, identity, plurality, quality, ranking
from tallyspan.plans import bindings as B
from tallyspan.plans.registry import query
from tallyspan.tables import TABLES, table

_SAME = " and ".join(f"coalesce(m_{m}, 0) = coalesce({m}, 0)" for m in plurality.MEASURES)
_TALLY = ", ".join(f"count(*) filter (stance = '{m}') as m_{m}" for m in plurality.MEASURES)
STATES = f"""{B.COUNTS},
tally as (select vote, grp, {_TALLY}, count(*) as m_all from latest group by vote, grp),
joined as (select coalesce(c.vote, t.vote) as vote, coalesce(c.grp, t.grp) as grp, c.vote is not null as listed, yes, no, abstain, absent, m_yes, m_no, m_abstain, m_absent, coalesce(m_all, 0) as m_all
 from (select * from counts where grp <> 'G4') c full join (select * from tally where grp <> 'G4') t on c.vote = t.vote and c.grp = t.grp),
states as (select *, case when not listed then 'unlisted' when {_SAME} and m_all = coalesce(yes, 0) + coalesce(no, 0) + coalesce(abstain, 0) + coalesce(absent, 0) then 'complete'
 when m_all = 0 then 'no_members' else 'partial' end as state, case when listed then {B.LEADING} end as lead_ from joined where vote in (select vote from counts)),
groups as (select vote, grp, state, lead_ as "leading", case when state = 'complete' then case lead_ when 'yes' then coalesce(m_no, 0) when 'no' then coalesce(m_yes, 0) else 0 end end as n_deviators from states)"""
COVERS = """sums as (select vote, sum(yes) as s_yes, sum(no) as s_no, sum(abstain) as s_abstain, sum(absent) as s_absent from counts group by vote),
cover as (select t.vote, coalesce(yes = s_yes and no = s_no and abstain = s_abstain and absent = s_absent and not (yes = 0 and no = 0 and abstain = 0 and absent = 0), false) as covers from totals t left join sums s on t.vote = s.vote)"""


@query(f"with {B.COUNTS} select vote, grp, {B.LEADING} as leading from counts")
def a1_plurality(spark, d):
    return B.counts(spark, d).select("vote", "grp", plurality.leading().alias("leading"))


@query(f"""with {B.COUNTS} select vote, case grp when 'G0' then 'west' when 'G1' then 'west' when 'G3' then 'unknown' else grp end as grp, cast(sum(yes) as bigint) as yes, cast(sum(no) as bigint) as no,
cast(sum(abstain) as bigint) as abstain, cast(sum(absent) as bigint) as absent, min(pos) as pos from counts group by 1, 2""")
def a2_merge_groups(spark, d):
    name = F.when(F.col("grp").isin("G0", "G1"), "west").when(F.col("grp") != "G3", F.col("grp"))
    return plurality.merge_groups(B.counts(spark, d), "vote", name)


@query(f"""with {B.COUNTS}, moved as (select vote from counts where grp = 'G0' and yes > 0 and vote % 5 = 0),
base as (select vote, grp, yes, no, abstain, absent from counts union all select vote, 'G1', 0, 0, 0, 0 from moved where vote not in (select vote from counts where grp = 'G1')),
after as (select vote, grp, yes + case when vote in (select vote from moved) then case grp when 'G0' then -1 when 'G1' then 1 else 0 end else 0 end as yes, no, abstain, absent from base)
select * from after where not (yes + no + abstain + absent = 0 and grp = 'G0' and vote in (select vote from moved))""")
def a3_refiled_counts(spark, d):
    counts = B.counts(spark, d)
    moves = counts.filter((F.col("grp") == "G0") & (F.col("yes") > 0) & (F.col("vote") % 5 == 0)).select(
        "vote", F.lit("G0").alias("from_grp"), F.lit("G1").alias("to_grp"), F.lit("yes").alias("stance")
    )
    return plurality.refile(counts, moves, "vote")


@query(f"with {B.COUNTS}, {COVERS} select * from cover")
def a4_groups_cover_total(spark, d):
    latest = B.latest(spark, d)
    return plurality.covers_total(B.counts(spark, d, latest), B.totals(spark, d, latest), "vote")


@query(f"with {STATES} select * from groups")
def a5_deviators(spark, d):
    latest = B.latest(spark, d)
    return plurality.deviators(latest, B.counts(spark, d, latest), "vote", ("G4",))


@query(f"""with {STATES}, {COVERS}, per as (select vote, bool_and(state = 'complete') as ok, cast(sum(n_deviators) as bigint) as n from groups group by vote)
select cover.vote, case when ok and covers then n end as n_deviators from cover left join per on cover.vote = per.vote""")
def a6_vote_deviators(spark, d):
    latest = B.latest(spark, d)
    counts = B.counts(spark, d, latest)
    groups = plurality.deviators(latest, counts, "vote", ("G4",))
    return plurality.deviator_count(groups, plurality.covers_total(counts, B.totals(spark, d, latest), "vote"), "vote")


@query(f"""with {STATES} select l.vote, l.member, case when state = 'complete' then case when ("leading" = 'yes' and stance = 'no') or ("leading" = 'no' and stance = 'yes') then 1 else 0 end end as deviates
from latest l left join groups g on l.vote = g.vote and l.grp = g.grp""")
def a7_member_flags(spark, d):
    latest = B.latest(spark, d)
    groups = plurality.deviators(latest, B.counts(spark, d, latest), "vote", ("G4",))
    return plurality.member_flags(latest, groups, "vote").select("vote", "member", "deviates")


@query("select l_orderkey, cast(sum(l_quantity) as bigint) as quantity, count(*) as n from lineitem group by 1 having sum(l_quantity) > 100")
def a8_grouped_having(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("n"))
    return g.filter("quantity > 100")


@query("""select l_orderkey, count(distinct case when l_returnflag = 'R' then l_partkey end) as n_parts,
case when count(distinct case when l_returnflag = 'R' then l_partkey end) = 1 then min(case when l_returnflag = 'R' then l_partkey end) end as only_part from lineitem group by 1""")
def a9_single_member(spark, d):
    part = F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct(part).alias("n_parts"), F.min(part).alias("p"))
    return g.select("l_orderkey", "n_parts", F.when(F.col("n_parts") == 1, F.col("p")).alias("only_part"))


@query("""select l_suppkey, l_orderkey, l_partkey, cast(l_quantity as bigint) as quantity from lineitem
qualify row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) = 1""")
def a10_columns_of_first_row(spark, d):
    best = F.min_by(F.struct("l_orderkey", "l_partkey", "l_quantity"), F.struct(*B.LINE_ORDER)).alias("b")
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(best).select("l_suppkey", "b.l_orderkey", "b.l_partkey", F.col("b.l_quantity").cast("bigint").alias("quantity"))


@query("""select c_custkey, any_value(c_name) as c_name, any_value(c_mktsegment) as c_mktsegment, count(o_orderkey) as n, cast(sum(round(o_totalprice * 100)) as bigint) as cents
from customer left join orders on c_custkey = o_custkey group by c_custkey""")
def a11_dependent_columns(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100)).cast("bigint").alias("cents"))
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left").select("c_custkey", "c_name", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n"), "cents")


@query("""with m as (select l_orderkey, l_returnflag, case when l_tax > 0 then cast(l_quantity as bigint) end as x from lineitem)
select l_orderkey, l_returnflag, cast(sum(x) as bigint) as total from m group by 1, 2 having count(x) = count(*)""")
def a12_fully_measured_sums(spark, d):
    rows = table(spark, d, "lineitem").withColumn("x", F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("bigint")))
    return ranking.measured_sum(rows, ["l_orderkey", "l_returnflag"], "x", "total")


@query(" union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in TABLES))
def a13_table_counts(spark, d):
    out = None
    for t in TABLES:
        one = table(spark, d, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out.select("name", "n")


@query("select source, lang, count(*) as n, count(*) filter (n_chars > 1000) as n_long from documents group by all")
def a14_boolean_sums(spark, d):
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") > 1000).alias("n_long"))


@query("""select strftime(l_shipdate, '%Y-%m') as month, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers, count(*) as n from lineitem group by 1""")
def a15_distinct_entities(spark, d):
    return table(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count(F.lit(1)).alias("n")
    )


@query("""select strftime(o_orderdate, '%G-W%V') as week, count(*) as n, count(distinct o_custkey) as customers, bool_and(o_orderstatus <> 'P') as complete,
cast(sum(case when o_orderstatus <> 'P' then round(o_totalprice * 100) end) as bigint) as cents, count(*) filter (o_orderpriority = '1-URGENT') as urgent from orders group by 1""")
def a16_week_stats(spark, d):
    from tallyspan.functions.scalars import iso_week

    done = F.col("o_orderstatus") != "P"
    return table(spark, d, "orders").groupBy(iso_week("o_orderdate").alias("week")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("o_custkey").alias("customers"),
        F.bool_and(done).alias("complete"),
        F.sum(F.when(done, F.round(F.col("o_totalprice") * 100))).cast("bigint").alias("cents"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )


@query("""with r as (select year(o_orderdate) as y, o_custkey % 40 as grp, 1 as v from orders where not (year(o_orderdate) = 1997 and o_custkey % 40 = 3)),
a as (select grp, sum(v) as n from r where y = 1997 group by 1), b as (select grp, sum(v) as n from r where y = 1996 group by 1),
x as (select coalesce(a.grp, b.grp) as grp, coalesce(a.n, 0)::double as a, coalesce(b.n, 0)::double as b from a full join b on a.grp = b.grp),
s as (select grp, round(100::double * a / (select sum(a) from x), 1) as share_now, round(100::double * b / (select sum(b) from x), 1) as share_before from x)
select grp, share_now, share_before, round(share_now - share_before, 1) as shift from s""")
def a17_share_shift(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"), (F.col("o_custkey") % 40).alias("grp"), F.lit(1).alias("v"))
    return ranking.share_shift(o.filter(~((F.col("y") == 1997) & (F.col("grp") == 3))), "y", "grp", "v", F.lit(1997), F.lit(1996))


@query("""with t as (select distinct year(o_orderdate) as y, l_orderkey, p_type from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
c as (select p_type, count(*) filter (y = 1997) as n, count(*) filter (y = 1996) as n_before from t group by 1)
select p_type, n, n - n_before as delta from c qualify row_number() over (order by n desc, p_type) <= 6""")
def a18_type_mix(spark, d):
    li, o, p = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "part")
    t = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.year("o_orderdate").alias("y"), "l_orderkey", "p_type").distinct()
    c = t.groupBy("p_type").agg(F.count_if(F.col("y") == 1997).alias("n"), F.count_if(F.col("y") == 1996).alias("b"))
    return c.select("p_type", "n", (F.col("n") - F.col("b")).alias("delta")).orderBy(F.desc("n"), "p_type").limit(6)


@query("""select conv_id, count(*) filter (role = 'user') as n_user, count(*) filter (role = 'assistant') as n_assistant, count(*) filter (role = 'system') as n_system
from conversations group by 1 having count(*) filter (role = 'user') <> count(*) filter (role = 'assistant')""")
def a19_kind_mismatch(spark, d):
    kinds = [F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("user", "assistant", "system")]
    return table(spark, d, "conversations").groupBy("conv_id").agg(*kinds).filter("n_user <> n_assistant")


@query("""with r as (select l_orderkey, l_linenumber as source_pos, p_brand as tag, p_size as tag_pos from lineitem join part on l_partkey = p_partkey),
per as (select l_orderkey, tag, min(tag_pos) filter (source_pos = 1) as lead, count(distinct source_pos) filter (source_pos > 1) as n from r group by 1, 2)
select l_orderkey, tag, row_number() over (partition by l_orderkey order by lead nulls last, n desc, tag) as rank from per qualify rank <= 3""")
def a20_ranked_tag_union(spark, d):
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    r = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", F.col("l_linenumber").alias("source_pos"), F.col("p_brand").alias("tag"), F.col("p_size").alias("tag_pos"))
    return ranking.tag_union(r.withColumn("order", F.col("tag")), "l_orderkey", "source_pos", "tag", "tag_pos", "order").withColumn("rank", F.col("rank").cast("bigint"))


@query("""select l_suppkey, count(*) as n, round(case when count(*) >= 3 and var_pop(l_quantity) > 0 and var_pop(l_discount) > 0 then corr(l_quantity, l_discount) end, 6) as r from lineitem group by 1""")
def a21_guarded_correlation(spark, d):
    out = ranking.guarded_correlation(table(spark, d, "lineitem"), "l_quantity", "l_discount", ["l_suppkey"])
    return out.withColumn("r", F.round("r", 6))


@query("""with m as (select p_brand, quantile_cont(p_size, 0.5) as median from part group by 1)
select part.p_brand, m.median, count(*) filter (p_size > median) as above, count(*) filter (p_size < median) as below from part join m on part.p_brand = m.p_brand group by 1, 2""")
def a21_median_split(spark, d):
    p = table(spark, d, "part")
    med = p.groupBy("p_brand").agg(F.percentile("p_size", 0.5).alias("median"))
    return p.join(med, "p_brand").groupBy("p_brand", "median").agg(F.count_if(F.col("p_size") > F.col("median")).alias("above"), F.count_if(F.col("p_size") < F.col("median")).alias("below"))


@query("""with x as (select c_nationkey, c_custkey, cast(sum(l_quantity) as bigint) as num, count(*) as den from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1, 2),
f as (select *, num / den::double as ratio from x where den >= 30), m as (select c_nationkey, quantile_cont(ratio, 0.5) as median from f group by 1)
select c_custkey, round(ratio, 6) as ratio, round(case when median = 0 then 1 else abs(ratio - median) / median end, 6) as deviation from f join m on f.c_nationkey = m.c_nationkey
where case when median = 0 then 1 else abs(ratio - median) / median end > 0.15""")
def a22_ratio_outliers(spark, d):
    li, o, c = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "customer")
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "c_custkey").agg(F.sum("l_quantity").cast("bigint").alias("num"), F.count(F.lit(1)).alias("den"))
    return ranking.ratio_outliers(x, "c_nationkey", "num", "den", 0.15, 30).select("c_custkey", F.round("ratio", 6).alias("ratio"), F.round("deviation", 6).alias("deviation"))


@query("""with x as (select source, count(*) as n, count(toxic) as known, coalesce(sum(toxic), 0) as hits from documents d left join labels l on d.doc_id = l.doc_id group by 1)
select source, n, n - known as unresolved, round(hits / n::double, 9) as low, round((hits + n - known) / n::double, 9) as high, case when n = known then round(hits / n::double, 9) end as share from x""")
def a23_share_bounds(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return ranking.share_bounds(x, ["source"], "toxic")


@query("""with f as (select l_suppkey, min([l_shipdate::varchar, lpad(l_orderkey::varchar, 12, '0'), l_linenumber::varchar]) as k from lineitem group by 1)
select l.l_suppkey, array_to_string(list_sort(list(distinct l_returnflag)), ',') as l_returnflag, array_to_string(list_sort(list(distinct l_linestatus)), ',') as l_linestatus, bool_or(l_discount > 0.09) as deep,
(select l_partkey from lineitem x where x.l_suppkey = l.l_suppkey order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice limit 1) as l_partkey from lineitem l group by 1""")
def a24_evidence_fold(spark, d):
    li = table(spark, d, "lineitem").withColumn("deep", F.col("l_discount") > 0.09)
    out = identity.fold_evidence(li, "l_suppkey", ["l_returnflag", "l_linestatus"], ["deep"], ["l_partkey"], B.LINE_ORDER)
    return out.select("l_suppkey", "l_returnflag", "l_linestatus", "deep", "l_partkey")


@query(r"""with u as (select regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host, url, case when url like 'https:%' then 0 else 1 end as r1, case when contains(url, '?') then 1 else 0 end as r2, length(url) as r3 from pages)
select host, url from u qualify row_number() over (partition by host order by r1, r2, r3, url) = 1""")
def a25_best_representation(spark, d):
    u = F.col("url")
    order = F.struct(F.when(u.startswith("https:"), 0).otherwise(1).alias("a"), F.contains(u, F.lit("?")).cast("int").alias("b"), F.length(u).alias("c"), u.alias("d"))
    return table(spark, d, "pages").groupBy(F.regexp_extract(u, "^[a-z]+://([^/?#]*)", 1).alias("host")).agg(F.min_by("url", order).alias("url"))


@query("""with e as (select o_custkey, sha256(array_to_string(list_sort(list(distinct o_orderkey::varchar)), ',')) as h from orders group by 1)
select count(*) as n_groups, cast(sum(cast('0x' || left(h, 14) as hugeint)) as varchar) as fingerprint from e""")
def a26_group_fingerprint(spark, d):
    return diffs.group_fingerprint(table(spark, d, "orders"), "o_custkey", F.col("o_orderkey").cast("string"))


@query("""with a as (select l_suppkey as k, count(*) as n from lineitem where l_returnflag <> 'R' group by 1), b as (select l_suppkey as k, count(*) as n from lineitem where l_returnflag <> 'A' group by 1)
select coalesce(a.k, b.k) as l_suppkey, a.n as old_n, b.n as new_n, case when a.k is null then 'added' when b.k is null then 'removed' else 'changed' end as change from a full join b on a.k = b.k where a.n is distinct from b.n""")
def a27_count_deltas(spark, d):
    per = lambda flag: table(spark, d, "lineitem").filter(F.col("l_returnflag") != flag).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return diffs.diff(per("R"), per("A"), ["l_suppkey"], ["n"])


@query("""select year(o_orderdate) as term, cast(min(o_orderdate)::date as varchar) as day, (select min(o_orderkey) from orders x where x.o_orderdate = min(o.o_orderdate)) as number from orders o group by 1""")
def a28_coverage_start(spark, d):
    first = F.min(F.struct(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("number"))).alias("m")
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("term")).agg(first).select("term", F.date_format("m.day", "yyyy-MM-dd").alias("day"), "m.number")


@query("""with c as (select o_custkey, o_orderpriority as p, count(*) as n, max((o_orderdate, o_orderkey)) as latest from orders group by 1, 2)
select o_custkey, p as priority, n from c qualify row_number() over (partition by o_custkey order by n desc, latest desc) = 1""")
def a29_most_frequent(spark, d):
    last = F.max(F.struct("o_orderdate", "o_orderkey"))
    return ranking.most_frequent(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", last).select("o_custkey", F.col("o_orderpriority").alias("priority"), "n")


@query("select strftime(o_orderdate, '%G-W%V') as week, min(year(o_orderdate + interval 3 day - interval 1 day * ((isodow(o_orderdate) - 1)))) as term from orders group by 1")
def a30_uniform_group(spark, d):
    from tallyspan.functions.scalars import iso_week

    rows = table(spark, d, "orders").select(iso_week("o_orderdate").alias("week"), F.year(F.date_add(F.date_trunc("week", "o_orderdate").cast("date"), 3)).cast("bigint").alias("term"))
    return quality.uniform(rows, "week", "term")
