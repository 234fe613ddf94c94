"""Text functions on documents, pages and conversations, always on whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.functions import texts as T
from tallyspan.operators import linking
from tallyspan.plans.registry import query
from tallyspan.tables import table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_KNOWN = ", ".join(f"'{s}'" for s in SEGMENTS)


@query(f"""with x as (select c_custkey, case c_custkey % 4 when 0 then c_mktsegment when 1 then c_mktsegment || c_mktsegment when 2 then c_mktsegment || 'BUILDING' else lower(c_mktsegment) end as t from customer)
select c_custkey, case when t in ({_KNOWN}) then t when length(t) % 2 = 0 and left(t, length(t) // 2) = right(t, length(t) // 2) and left(t, length(t) // 2) in ({_KNOWN}) then left(t, length(t) // 2)
 when exists (select 1 from (values {", ".join(f"('{s}')" for s in SEGMENTS)}) a(a), (values {", ".join(f"('{s}')" for s in SEGMENTS)}) b(b) where a || b = t) then null else t end as grp from x""")
def f2_canonical_group(spark, d):
    seg, k = F.col("c_mktsegment"), F.col("c_custkey") % 4
    t = F.when(k == 0, seg).when(k == 1, F.concat(seg, seg)).when(k == 2, F.concat(seg, F.lit("BUILDING"))).otherwise(F.lower(seg))
    return table(spark, d, "customer").select("c_custkey", t.alias("t")).select("c_custkey", T.canonical_group("t", SEGMENTS).alias("grp"))


_NORMAL = "trim(regexp_replace(lower({0}), '[^a-zäöüß0-9]+', ' ', 'g'))"


@query(f"""with x as (select a.p_partkey, {_NORMAL.format("a.p_name || ' ' || a.p_type")} as h, {_NORMAL.format("b.p_name || '/' || b.p_type")} as t from part a join part b on b.p_partkey = a.p_partkey + 1),
w as (select *, list_distinct(list_filter(string_split(t, ' '), lambda z: length(z) >= 5)) as tw, list_distinct(list_filter(string_split(h, ' '), lambda z: length(z) >= 5)) as hw from x)
select p_partkey, contains(h, t) or contains(t, h) or (len(tw) > 0 and len(list_intersect(tw, hw)) >= 0.65 * len(tw) - 1e-9) as alike from w""")
def f6_title_similarity(spark, d):
    p = table(spark, d, "part")
    h, t = F.concat_ws(" ", "p_name", "p_type").alias("h"), F.concat_ws("/", "p_name", "p_type").alias("t")
    a, b = p.select("p_partkey", h), p.select((F.col("p_partkey") - 1).alias("p_partkey"), t)
    return a.join(b, "p_partkey").select("p_partkey", S.titles_match(F.col("h"), F.col("t")).alias("alike"))


@query(r"""select page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '^(The|Und|Les) ', ''), '[.,]+$', ''), '\s+', ' ', 'g')), '') as heading from pages""")
def f7_heading(spark, d):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, d, "pages").select("page_id", T.strip_boilerplate(title, ["^(The|Und|Les) ", "[.,]+$"]).alias("heading"))


@query(rf"""with a as (select page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', '', 'g'), '(?is)<style\b.*?</style>', '', 'g') as t from pages),
b as (select page_id, regexp_replace(regexp_replace(t, '(?i)</?(?:{T.BLOCKS})(?:[ /][^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g') as t from a),
c as (select page_id, replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&middot;', '·'), '&copy;', '©'), '&amp;', '&') as t from b),
e as (select page_id, list_filter(list_transform(string_split(t, chr(10)), lambda p: trim(regexp_replace(p, '[ \t\r]+', ' ', 'g'))), lambda p: p <> '') as ps from c)
select page_id, len(ps) as n, cast(list_sum(list_transform(ps, lambda p: length(p))) as bigint) as n_chars, md5(array_to_string(ps, chr(10))) as digest from e""")
def f8_paragraphs(spark, d):
    p = table(spark, d, "pages").select("page_id", T.paragraphs("html").alias("ps"))
    chars = F.aggregate("ps", F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x))
    return p.select("page_id", F.size("ps").cast("bigint").alias("n"), chars.alias("n_chars"), F.md5(F.array_join("ps", "\n").cast("binary")).alias("digest"))


@query(r"""with t as (select doc_id, trim(text) as t from documents), h as (select *, regexp_extract(left(t, 300) || ' ', '(?s)^(.*[^\s.0-9A-ZÄÖÜ][.!?])\s', 1) as head from t)
select doc_id, case when length(t) <= 300 then t when head <> '' then head else regexp_replace(left(t, 299), '\s+\S*$', '') || '…' end as teaser from h""")
def f9_teaser(spark, d):
    return table(spark, d, "documents").select("doc_id", S.teaser("text").alias("teaser"))


@query("""select s_suppkey, case when regexp_matches(x, '[sßxz]$') then x || '’' else x || 's' end as genitive from (select s_suppkey, case when s_suppkey % 3 = 0 then 'Bus' when s_suppkey % 3 = 1 then 'Haus-' || s_suppkey else 'Anna' end as x from supplier)""")
def f10_genitive(spark, d):
    k = F.col("s_suppkey") % 3
    x = F.when(k == 0, "Bus").when(k == 1, F.concat(F.lit("Haus-"), F.col("s_suppkey").cast("string"))).otherwise("Anna")
    return table(spark, d, "supplier").select("s_suppkey", T.genitive(x).alias("genitive"))


@query(r"""with x as (select doc_id, text, len(regexp_extract_all(text, 'Licensed under')) as n, regexp_extract(text, '(?s)(?:Licensed under)(.*)$', 1) as body from documents)
select doc_id, case when n = 1 then trim(regexp_replace(regexp_replace(string_split(body, '.' || chr(10))[1], '([a-zäöüß])-\n([a-zäöüß])', '\1\2', 'g'), '\s+', ' ', 'g')) end as part from x""")
def f11_operative_part(spark, d):
    return table(spark, d, "documents").select("doc_id", T.operative_part("text", "Licensed under", r"\.\n").alias("part"))


@query("""select d.doc_id, coalesce(case when quality = 1 then lang end, case when toxic = 1 then 'flagged' end, case when n_chars > 3000 then source end) as topic,
case when quality = 1 and lang is not null then 'language' when toxic = 1 then 'flag' when n_chars > 3000 and source is not null then 'source' else 'untagged' end as origin from documents d left join labels l on d.doc_id = l.doc_id""")
def f13_topic_fallback(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    value, origin = T.ranked_fallback(
        ("language", F.when(F.col("quality") == 1, F.col("lang"))), ("flag", F.when(F.col("toxic") == 1, F.lit("flagged"))), ("source", F.when(F.col("n_chars") > 3000, F.col("source")))
    )
    return x.select("doc_id", value.alias("topic"), origin.alias("origin"))


@query("""with c as (select l_orderkey, count(distinct l_suppkey) as n from lineitem group by 1) select o_orderkey, case when n is null then 'none' when n <= 2 then 'narrow' else 'wide' end as context from orders left join c on o_orderkey = l_orderkey""")
def f14_narrow_context(spark, d):
    c = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("n"))
    x = table(spark, d, "orders").join(c, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return x.select("o_orderkey", F.when(F.col("n").isNull(), "none").when(F.col("n") <= 2, "narrow").otherwise("wide").alias("context"))


@query("""select doc_id, case when regexp_matches(text, '[Ll]icense') then 'license' when regexp_matches(text, 'token = ') then 'secret' when regexp_matches(text, '!!') then 'shouting' else 'plain' end as kind from documents""")
def f15_rule_kinds(spark, d):
    rules = [("[Ll]icense", "license"), ("token = ", "secret"), ("!!", "shouting")]
    return table(spark, d, "documents").select("doc_id", S.first_match("text", rules, "plain").alias("kind"))


@query("""with x as (select l_orderkey, l_linenumber, l_partkey, case l_returnflag when 'A' then 'yes' when 'R' then 'no' else 'abstain' end as stance, case when l_tax < 0.03 then 'reject' when l_tax < 0.06 then 'accept' end as r from lineitem)
select l_orderkey, l_linenumber, l_partkey, case when r = 'reject' then case stance when 'yes' then 'no' when 'no' then 'yes' else stance end when r = 'accept' then stance end as effective from x""")
def f16_inverted_recommendation(spark, d):
    li = table(spark, d, "lineitem")
    stance = F.when(F.col("l_returnflag") == "A", "yes").when(F.col("l_returnflag") == "R", "no").otherwise("abstain")
    rec = F.when(F.col("l_tax") < 0.03, "reject").when(F.col("l_tax") < 0.06, "accept")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", T.effective_stance(stance, rec).alias("effective"))


@query("""select p_partkey, case when contains(p_name, 'ring') then 'ring' when contains(p_type, 'SMALL') then 'small' when p_brand like '%7' then 'seven' end as class from part""")
def f17_first_field_hit(spark, d):
    cls = F.when(F.contains("p_name", F.lit("ring")), "ring").when(F.contains("p_type", F.lit("SMALL")), "small").when(F.col("p_brand").endswith("7"), "seven")
    return table(spark, d, "part").select("p_partkey", cls.alias("class"))


@query(r"""with x as (select doc_id, len(regexp_extract_all(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+')) as n from documents) select doc_id, case n when 0 then 'none' when 1 then 'unique' else 'several' end as located from x""")
def f18_tally_locator(spark, d):
    return table(spark, d, "documents").select("doc_id", T.located("text", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+").alias("located"))


@query(r"""select conv_id, turn, role = 'assistant' and regexp_matches(text, '[?]') as announces, len(regexp_extract_all(text, '[.!?](?:\s|$)')) as sentences from conversations""")
def f19_announcement(spark, d):
    t = table(spark, d, "conversations")
    return t.select("conv_id", "turn", ((F.col("role") == "assistant") & F.col("text").rlike("[?]")).alias("announces"), F.regexp_count("text", F.lit(r"[.!?](?:\s|$)")).cast("bigint").alias("sentences"))


@query("""with s as (select doc_id, string_split(text, chr(10)) as ls from documents), l as (select doc_id, unnest(range(1, len(ls) + 1)) as pos, unnest(ls) as line from s),
b as (select *, coalesce(sum(length(line)) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as before from l)
select doc_id, cast(floor(before / 900) as bigint) as chunk, count(*) as n_lines, cast(sum(length(line)) as bigint) as n_chars from b group by 1, 2""")
def x32_chunks(spark, d):
    return T.chunks(table(spark, d, "documents"), "doc_id", "text")


@query(r"""with h as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as target from pages), k as (select distinct '/' || n_name as target from nation union select '/the' union select '/and')
select target, count(*) as n, count(distinct page_id) as n_pages from h where target not in (select target from k) group by 1""")
def x23_link_audit(spark, d):
    h = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("target"))
    k = table(spark, d, "nation").select(F.concat(F.lit("/"), "n_name").alias("target")).union(spark.createDataFrame([("/the",), ("/and",)], "target string"))
    return h.join(k, "target", "left_anti").groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("n_pages"))


@query(r"""with w as (select item_id, list_distinct(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-zäöüß0-9]+', ' ', 'g')), ' '), lambda z: length(z) >= 5)) as ws from benchmark),
e as (select item_id, unnest(ws) as word from w), f as (select word, count(*) as n from e group by 1)
select a.item_id, min(b.item_id) as rival, count(distinct b.item_id) as rivals from e a join f on a.word = f.word and f.n between 2 and 3 join e b on b.word = a.word and b.item_id <> a.item_id group by 1""")
def j9_shared_rare_words(spark, d):
    ws = S.long_words(S.normal_title("text"))
    return linking.rare_token_rivals(table(spark, d, "benchmark").select("item_id", ws.alias("ws")), "item_id", "ws", 2, 3)


@query(r"""with h as (select page_id, url, regexp_extract(url, '/([a-z]{2})/', 1) as lang from pages), k as (select lang, count(*) as n from h group by 1) select h.page_id, case when h.lang = '' then 'none' when k.n > 20 then 'linked' else 'rare' end as state from h join k on h.lang = k.lang""")
def f12_passage_state(spark, d):
    h = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))
    k = h.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return h.join(k, "lang").select("page_id", F.when(F.col("lang") == "", "none").when(F.col("n") > 20, "linked").otherwise("rare").alias("state"))
