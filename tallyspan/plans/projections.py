"""Projections, filters and scalar functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.plans.registry import query
from tallyspan.tables import table

NUMBER = "concat(l_orderkey % 30, case when l_linenumber = 7 then '-' else '/' end, l_partkey)"


def _numbers(spark, d):
    li = table(spark, d, "lineitem")
    sep = F.when(F.col("l_linenumber") == 7, "-").otherwise("/")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.concat((F.col("l_orderkey") % 30).cast("string"), sep, F.col("l_partkey").cast("string")).alias("number"))


@query("""select o_orderkey, case when o_orderstatus = 'P' then null else coalesce(nullif(case when o_custkey % 3 = 0 then '' else o_orderpriority end, ''), c_mktsegment) end as grp
from orders join customer on o_custkey = c_custkey""")
def p1_group_attribution(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    role = F.when(F.col("o_orderstatus") == "P", F.col("o_orderstatus"))
    label = F.when(F.col("o_custkey") % 3 == 0, "").otherwise(F.col("o_orderpriority"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", S.group_attribution(role, label, "c_mktsegment").alias("grp"))


@query(f"""with n as (select l_orderkey, l_linenumber, {NUMBER} as number from lineitem)
select case when regexp_full_match(number, '[0-9]+/[0-9]+') then 0 else 1 end as malformed, count(*) as n from n group by 1""")
def p2_malformed_numbers(spark, d):
    return _numbers(spark, d).groupBy(S.malformed_number("number").alias("malformed")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with n as (select distinct {NUMBER} as number from lineitem), k as (select number, regexp_full_match(number, '[0-9]+/[0-9]+') as ok from n)
select number, case when ok then 0 else 1 end as bad, case when ok then cast(split_part(number, '/', 1) as bigint) else 0 end as term, case when ok then cast(split_part(number, '/', 2) as bigint) else 0 end as no from k""")
def p3_number_order(spark, d):
    key = S.number_sort_key("number").alias("k")
    return _numbers(spark, d).select("number").distinct().select("number", key).orderBy("k").select("number", "k.bad", "k.term", F.col("k.number").alias("no"))


@query("""with ids as (select distinct cast(user_id as varchar) as id from events union select distinct event_type from events)
select id, case when regexp_full_match(id, '[0-9]+') then 0 else 1 end as kind, try_cast(id as bigint) as n from ids""")
def p4_id_order(spark, d):
    e = table(spark, d, "events")
    ids = e.select(F.col("user_id").cast("string").alias("id")).union(e.select("event_type")).distinct()
    return ids.select("id", S.id_sort_key("id").alias("k")).orderBy("k").select("id", "k.kind", F.col("k.n").cast("bigint").alias("n"))


@query("""with v as (select o_orderdate as day, count(*) filter (o_orderstatus = 'F') as yes, count(*) filter (o_orderstatus = 'O') as no from orders group by 1)
select strftime(day, '%Y-%m-%d') as day, yes, no, round(abs(yes - no) * 1.0 / (yes + no), 9) as margin from v where yes + no > 0""")
def p5_safe_margin(spark, d):
    v = table(spark, d, "orders").groupBy("o_orderdate").agg(F.count_if(F.col("o_orderstatus") == "F").alias("yes"), F.count_if(F.col("o_orderstatus") == "O").alias("no"))
    return v.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "yes", "no", F.round(S.margin("yes", "no"), 9).alias("margin")).filter("margin is not null")


@query("""with t as (select o_orderkey, concat(o_orderkey % 24, ':', lpad(cast(o_custkey % 60 as varchar), 2, '0')) as a,
case when o_custkey % 11 = 0 then 'late' else concat(o_custkey % 24, ':', lpad(cast(o_orderkey % 60 as varchar), 2, '0')) end as b from orders)
select o_orderkey, case when regexp_full_match(b, '.+:..') then (cast(split_part(b, ':', 1) as int) * 60 + cast(split_part(b, ':', 2) as int)
 - cast(split_part(a, ':', 1) as int) * 60 - cast(split_part(a, ':', 2) as int) + 1440) % 1440 end as minutes from t""")
def p6_clock_minutes(spark, d):
    o = table(spark, d, "orders")
    two = lambda c: F.lpad((F.col(c) % 60).cast("string"), 2, "0")
    a = F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":"), two("o_custkey"))
    b = F.when(F.col("o_custkey") % 11 == 0, "late").otherwise(F.concat((F.col("o_custkey") % 24).cast("string"), F.lit(":"), two("o_orderkey")))
    return o.select("o_orderkey", a.alias("a"), b.alias("b")).select("o_orderkey", S.clock_minutes("a", "b").cast("int").alias("minutes"))


@query("""select event_type, cast(sum(try_cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total, count(json_extract_string(props, '$.k')) as n from events group by 1""")
def p7_json_field(spark, d):
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(k.try_cast("bigint")).alias("total"), F.count(k).alias("n"))


@query(f"""with n as (select l_orderkey % 31 as term0, {NUMBER} as number from lineitem), t as (select number, case when term0 = 30 then null else term0 end as term from n)
select count(*) as n, count(*) filter (coalesce(try_cast(split_part(number, '/', 1) as int) in (term, term - 1), term is null)) as kept from t""")
def p8_plausible_numbers(spark, d):
    rows = _numbers(spark, d).withColumn("term", F.when(F.col("l_orderkey") % 31 != 30, F.col("l_orderkey") % 31))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(S.plausible_number("number", "term")).alias("kept"))


@query(r"""select page_id, coalesce(regexp_full_match(url, 'https://[^/@:?#]+(/[^?#]*)?') and lower(regexp_extract(url, '^https://([^/?#:]+)', 1)) in ('blog.tionsh.example.net', 'www.ththhe.example.com'), url is null) as allowed from pages""")
def p9_allowed_hosts(spark, d):
    return table(spark, d, "pages").select("page_id", S.allowed_host("url", ["blog.tionsh.example.net", "www.ththhe.example.com"]).alias("allowed"))


@query(r"""select regexp_extract(url, '^([a-z]+)://', 1) as scheme, regexp_matches(url, '^[a-z]+://[^/]*@') as has_user, contains(url, '?') as has_query, contains(url, '#') as has_fragment, count(*) as n from pages group by all""")
def p10_url_parts(spark, d):
    u = F.col("url")
    return (
        table(spark, d, "pages")
        .groupBy(F.regexp_extract(u, "^([a-z]+)://", 1).alias("scheme"), u.rlike("^[a-z]+://[^/]*@").alias("has_user"), F.contains(u, F.lit("?")).alias("has_query"), F.contains(u, F.lit("#")).alias("has_fragment"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("""with a as (select user_id, date_trunc('day', ts) as day, max(event_type) as t, max(value) as v from events group by 1, 2),
b as (select user_id, day, t, v, lag(t) over w as pt, lag(v) over w as pv, lag(day) over w as pd from a window w as (partition by user_id order by day))
select count(*) as n, count(*) filter (pd is not null and t is not distinct from pt) as same_type, count(*) filter (pt is distinct from t) as changed from b""")
def p12_null_safe_change(spark, d):
    from pyspark.sql import Window

    a = table(spark, d, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.max("event_type").alias("t"), F.max("value").alias("v"))
    w = Window.partitionBy("user_id").orderBy("day")
    b = a.withColumn("pt", F.lag("t").over(w)).withColumn("pd", F.lag("day").over(w))
    same = F.col("t").eqNullSafe(F.col("pt"))
    return b.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pd").isNotNull() & same).alias("same_type"), F.count_if(~same).alias("changed"))


@query("""select conv_id, turn, role, length(text) as n_chars from conversations where role <> 'system'""")
def p13_compact_turns(spark, d):
    return table(spark, d, "conversations").filter("role <> 'system'").select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars"))


@query("""select doc_id from documents where not (text ilike 'q:%' or contains(string_split(text, chr(10))[1], '?')) and lang = 'en'""")
def p14_format_filter(spark, d):
    asked = F.lower(F.substring("text", 1, 2)) == "q:"
    return table(spark, d, "documents").filter((F.col("lang") == "en") & ~(asked | F.contains(F.split("text", "\n", 2)[0], F.lit("?")))).select("doc_id")


@query("""select p_partkey from part where contains(lower(p_name || chr(10) || p_type), 'steel') and contains(lower(p_name || chr(10) || p_type), 'b')""")
def p15_search_words(spark, d):
    p = table(spark, d, "part")
    return p.filter(S.search_match(F.lit("Stéel  B"), "p_name", "p_type")).select("p_partkey")


@query("""select doc_id, trim(regexp_replace(text, '[\\s\\x{00A0}]+', ' ', 'g')) as t from documents where trim(regexp_replace(text, '[\\s\\x{00A0}]+', ' ', 'g')) <> ''""")
def f1_collapse(spark, d):
    return table(spark, d, "documents").select("doc_id", S.collapse("text").alias("t")).filter("t is not null")


@query("""with w as (select doc_id, list_transform(string_split(text, ' '), lambda w: case when length(w) > 1 and length(w) % 2 = 0 and left(w, length(w) // 2) = right(w, length(w) // 2) then left(w, length(w) // 2) else w end) as a from documents)
select doc_id, array_to_string(a, ' ') as t from w""")
def f3_undouble(spark, d):
    return table(spark, d, "documents").select("doc_id", S.undouble("text").alias("t"))


@query("""select case when p_type ilike '%steel%' then 'metal' when p_type ilike '%brass%' then 'alloy' when p_size > 40 then null else 'other' end as side, count(*) as n from part group by 1""")
def f4_rule_chain(spark, d):
    side = S.first_match(F.concat("p_type", F.lit(" "), F.when(F.col("p_size") > 40, "big").otherwise("")), [("(?i)steel", "metal"), ("(?i)brass", "alloy"), ("big$", "none")], "other")
    return table(spark, d, "part").groupBy(F.nullif(side, F.lit("none")).alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with n as (select distinct '0' || {NUMBER} as number, case when l_partkey % 2 = 0 then 'BT' else 'BR' end as issuer from lineitem)
select number, issuer, case when issuer = 'BT' and regexp_full_match(number, '[0-9]+/[0-9]+') then cast(split_part(number, '/', 1)::bigint as varchar) || '/' || cast(split_part(number, '/', 2)::bigint as varchar) else number end as canon from n""")
def f5_document_number(spark, d):
    rows = _numbers(spark, d).select(F.concat(F.lit("0"), "number").alias("number"), F.when(F.col("l_partkey") % 2 == 0, "BT").otherwise("BR").alias("issuer")).distinct()
    return rows.select("number", "issuer", S.canonical_document("number", "issuer").alias("canon"))


@query("""select s_suppkey, list_sort(list_distinct(string_split(lower(s_name), '#')))[1] as first_word, length(s_name) as n from supplier""")
def f10_name_words(spark, d):
    words = F.array_sort(F.array_distinct(F.split(F.lower("s_name"), "#")))
    return table(spark, d, "supplier").select("s_suppkey", words[0].alias("first_word"), F.length("s_name").cast("bigint").alias("n"))


@query("""select r_name, case when count(*) = 1 then min(n_name) else array_to_string(list(n_name order by n_name)[1:count(*) - 1], ', ') || ' und ' || max(n_name) end as nations
from nation join region on n_regionkey = r_regionkey group by 1""")
def f10_join_list(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = n.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("a"))
    return names.select("r_name", S.join_list("a").alias("nations"))


@query("""select strftime(cast(o_orderdate as timestamp), '%G-W%V') as week, count(*) as n from orders group by 1""")
def f20_iso_week(spark, d):
    return table(spark, d, "orders").groupBy(S.iso_week("o_orderdate").alias("week")).agg(F.count(F.lit(1)).alias("n"))


@query("""select n_nationkey, 'nation-v1-' || sha256('[1,"nation",["' || n_name || '","' || n_regionkey || '"]]') as k from nation""")
def f21_content_key(spark, d):
    return table(spark, d, "nation").select("n_nationkey", S.content_key("nation", "n_name", "n_regionkey").alias("k"))


@query("""with v as (select distinct (p_size % 3) || '.' || (p_partkey % 12) || '.' || p_size as v from part)
select max_by(v, [split_part(v, '.', 1)::int, split_part(v, '.', 2)::int, split_part(v, '.', 3)::int]) as newest, min_by(v, [split_part(v, '.', 1)::int, split_part(v, '.', 2)::int, split_part(v, '.', 3)::int]) as oldest from v""")
def f22_version_order(spark, d):
    v = F.concat_ws(".", (F.col("p_size") % 3).cast("string"), (F.col("p_partkey") % 12).cast("string"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select(v.alias("v")).agg(F.max_by("v", S.version_key("v")).alias("newest"), F.min_by("v", S.version_key("v")).alias("oldest"))


@query("""select n_name, replace(format('{:,}', cast(count(*) * 1234 as bigint)), ',', '.') as n from customer join nation on c_nationkey = n_nationkey group by 1""")
def f24_german_number(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy("n_name").agg((F.count(F.lit(1)) * 1234).alias("x")).select("n_name", S.german_number("x").alias("n"))


@query(r"""select doc_id, len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) as n_words, length(text) as n_chars from documents""")
def f25_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", S.word_count("text").cast("bigint").alias("n_words"), F.length("text").cast("bigint").alias("n_chars"))


@query("""with t as (select l_orderkey, sum((l_returnflag = 'A')::int) as a, sum((l_returnflag = 'N')::int) as n, sum((l_returnflag = 'X')::int) as x, sum((l_returnflag = 'Y')::int) as y from lineitem group by 1)
select count(a) as known, count(*) as n from (select case when a = 0 and n = 0 and x = 0 and y = 0 then null else a end as a from t)""")
def p_counts_or_null(spark, d):
    t = table(spark, d, "lineitem").groupBy("l_orderkey").agg(*[F.count_if(F.col("l_returnflag") == f).alias(f) for f in "ANXY"])
    a, *_ = S.counts_or_null(*"ANXY")
    return t.select(a.alias("a")).agg(F.count("a").alias("known"), F.count(F.lit(1)).alias("n"))
