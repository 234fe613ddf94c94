"""Wrapped texts: breaks inside words, operative parts with four states."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspan.operators import passages
from tallyspan.plans.registry import query
from tallyspan.tables import table


@query("""with t as (select p_partkey as k, lower(p_type) as a, split_part(p_name, ' ', 1) as b, split_part(p_name, ' ', 2) as c from part),
ev as (select 'word' as kind, a || b as token from t where k % 4 = 0 union all select 'word', a || '-' || c from t where k % 4 = 0 union all select 'word', 'und' from t where k % 4 = 0 union all select 'word', b from t where k % 4 = 0
 union all select 'word', c from t where k % 4 = 0 union all select 'after', 'und' from t where k % 4 = 0 union all select 'word', case when k % 12 = 1 then a || '-' || b else 'lang' end from t where k % 4 = 1
 union all select 'word', w from t, unnest(case k % 4 when 2 then ['das', 'ist'] when 3 then ['kurz', c, 'gut'] else ['ein'] end) u(w) where k % 4 > 0),
n as (select kind, token, count(*) as n from ev group by 1, 2),
br as (select k, case when k % 8 = 7 then c when k % 4 = 3 then b else a end as x, case when k % 8 = 7 then a when k % 4 = 3 then 'und' when k % 4 = 2 then c else b end as y from t where k % 4 > 0),
sc as (select br.*, coalesce(g.n, 0) as g, coalesce(h.n, 0) as h, coalesce(s.n, 0) as s from br left join n g on g.kind = 'word' and g.token = x || y left join n h on h.kind = 'word' and h.token = x || '-' || y left join n s on s.kind = 'after' and s.token = y),
ch as (select *, case when g > h and g > s then '' when h > g and h > s then '-' when s > g and s > h then '- ' end as j from sc)
select t.k as p_partkey, case when k % 4 = 0 then a || b || ' ' || a || '-' || c || ' und ' || b || '- und ' || c when j is null then null when k % 4 = 1 then 'ein ' || x || j || y || ' ' || case when k % 12 = 1 then a || '-' || b else 'lang' end
 when k % 4 = 2 then 'das ' || x || j || y || ' ist' else 'kurz ' || x || j || y || ' ' || c || ' gut' end as text, (k % 4 > 0 and j is null)::bigint as n_open from t left join ch using (k)""")
def f11_rejoined_lines(spark, d):
    """Words broken at line ends: glued, kept or left hanging as the other texts write them; open without evidence."""
    k = F.col("p_partkey")
    a, b, c = F.lower("p_type"), *(F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (1, 2))
    say = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    text = (
        F.when(k % 4 == 0, say(a, b, " ", a, "-", c, "\nund ", b, "- und ", c))
        .when(k % 4 == 1, say("ein ", a, "-\n", b, "\n", F.when(k % 12 == 1, say(a, "-", b)).otherwise("lang")))
        .when(k % 4 == 2, say("das ", a, "-  \n ", c, " ist"))
        .when(k % 8 == 7, say("kurz ", c, "-\n", a, " ", c, " gut"))
        .otherwise(say("kurz ", b, "-\nund ", c, " gut"))
    )
    texts = table(spark, d, "part").select("p_partkey", text.alias("t"))
    return passages.rejoined(texts, "p_partkey", "t", passages.evidence(texts, "t")).withColumn("n_open", F.col("n_open").cast("long"))


@query("""select p_partkey, lower(p_name) || ' ' || lower(replace(p_type, ' ', '')) || 'und ' || lower(p_name) as text from part""")
def f11_joined_lines(spark, d):
    """Part names and types broken over lines at a hyphen, joined again as the unbroken texts write them."""
    name, kind = F.lower("p_name"), F.concat(F.lower(F.replace("p_type", F.lit(" "))), F.lit("und"))
    part = table(spark, d, "part")
    known = passages.evidence(part.select(F.concat(name, F.lit(" "), kind).alias("t")), "t")
    broken = part.select("p_partkey", F.concat(name, F.lit(" "), F.substring(kind, 1, 4), F.lit("-\n"), F.substring(kind, 5, 200), F.lit("\n"), name).alias("t"))
    return passages.rejoined(broken, "p_partkey", "t", known).select("p_partkey", "text")


@query("""with l as (select l_orderkey as k, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as i, count(*) over (partition by l_orderkey) as n, l_partkey from lineitem),
m as (select k, i, n, l_partkey, case when k % 7 = 0 and n > 2 and i = 2 then 3 when k % 7 = 0 and n > 2 and i = 3 then 2 else i end as shown from l),
p as (select k, max(n) as n, string_agg(shown || '. die lieferung von ' || l_partkey || case when k % 7 = 4 and i = 1 then ', und zwar a) sofort, b) am 1. Januar,' else '' end || case when i = n then case when k % 7 = 3 then ' und' else '.' end else ';' end, ' ' order by i) as txt from m group by k)
select o_orderkey, case when o_orderkey % 7 = 2 then 'not_fetched' when o_orderkey % 7 = 1 or p.k is null then 'no_passage' when (o_orderkey % 7 = 0 and n > 2) or o_orderkey % 7 = 3 then 'uncertain' else 'extracted' end as state,
 case when o_orderkey % 7 in (4, 5, 6) or (o_orderkey % 7 = 0 and n <= 2) then txt end as passage from orders left join p on o_orderkey = p.k""")
def f12_passage_states(spark, d):
    """Motions written from orders, their demands from lines: some unordered, cut, without the anchor or not fetched."""
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey")
    k = F.col("l_orderkey")
    li = li.select("l_orderkey", F.row_number().over(w.orderBy("l_linenumber", "l_partkey", "l_suppkey")).alias("i"), F.count(F.lit(1)).over(w).alias("n"), "l_partkey")
    i, last = F.col("i"), F.col("i") == F.col("n")
    shown = F.when((k % 7 == 0) & (F.col("n") > 2) & (i == 2), 3).when((k % 7 == 0) & (F.col("n") > 2) & (i == 3), 2).otherwise(i)
    nested = F.when((k % 7 == 4) & (i == 1), ", und zwar\na) sofort,\nb) am\n1. Januar,").otherwise("")
    item = F.concat(shown.cast("string"), F.lit(". die "), F.when(k % 7 == 5, "lie-\nferung").otherwise("lieferung"), F.lit(" von\n"), F.col("l_partkey").cast("string"), nested, F.when(last, F.when(k % 7 == 3, " und").otherwise(".")).otherwise(";"))
    body = li.withColumn("x", item).groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]), "\n").alias("body"))
    o = table(spark, d, "orders").select("o_orderkey").join(body, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    anchor = F.when(F.col("o_orderkey") % 7 == 1, "Der Rat stellt fest:\n").otherwise("Der Rat fordert auf,\n")
    text = F.when(F.col("o_orderkey") % 7 != 2, F.concat(F.lit("Vorspann\n"), anchor, F.coalesce("body", F.lit("")), F.lit("\nBegründung\n1. weil")))
    return passages.passages(o.select("o_orderkey", text.alias("t")), "o_orderkey", "t", "Der Rat fordert auf,", "Begründung")
