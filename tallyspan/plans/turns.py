"""Kinds of turns, announcements, listed pages and sheets, batch lists."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyspan.operators import linking, turns
from tallyspan.plans.registry import query
from tallyspan.session import run_dir
from tallyspan.sources import landing, markup, sinks
from tallyspan.tables import table


def _events(spark, d):
    i, kind = F.col("event_id"), F.col("event_type")
    event = (
        F.when(kind == "signup", F.when(i % 3 == 0, "questions_open").when(i % 3 == 1, "debate_open"))
        .when((kind == "view") & (i % 2 == 0), "announce")
        .when(kind.isin("click", "purchase"), "member")
        .when(kind == "error", "official")
    )
    return table(spark, d, "events").select(F.coalesce("user_id", F.lit(-1)).alias("unit"), "ts", "event_id", event.alias("event"), (i % 3).alias("speaker"))


@query("""with recursive e as (select coalesce(user_id, -1) as unit, event_id, event_id % 3 as s, row_number() over (partition by coalesce(user_id, -1) order by ts, event_id) as rn,
 case event_type when 'signup' then case event_id % 3 when 0 then 'q' when 1 then 'd' end when 'view' then case when event_id % 2 = 0 then 'a' end when 'error' then 'o' else 'm' end as ev from events),
st(unit, rn, event_id, phase, kind, main, speech, quest, parent) as (
 select unit, 0::bigint, null::bigint, 'debate', null::varchar, null::bigint, null::bigint, null::bigint, null::bigint from (select distinct unit from e)
 union all
 select e.unit, e.rn, e.event_id,
  case when ev = 'q' then 'reports' when ev = 'd' then 'debate' when ev = 'a' and phase in ('debate', 'intervened') then 'announced' when phase = 'reports' and ev = 'm' then 'asked' when phase = 'announced' and ev = 'm' then 'intervened'
   when phase = 'announced' and ev = 'o' then 'debate' when phase = 'intervened' and ev in ('m', 'o') then 'debate' else phase end,
  k.kind, case when k.kind in ('speech', 'reply') then s else main end, case when k.kind = 'speech' then e.event_id else speech end, case when k.kind = 'question' then e.event_id else quest end,
  case when k.kind in ('intervention', 'reply') then speech when k.kind = 'answer' then quest end
 from st join e on e.unit = st.unit and e.rn = st.rn + 1, lateral (select case when ev is null or ev not in ('m', 'o') then null when phase = 'reports' then if(ev = 'm', 'question', 'report') when phase = 'asked' then if(ev = 'm', 'question', 'answer')
   when phase = 'announced' and ev = 'm' then 'intervention' when phase = 'intervened' and main = s then 'reply' else 'speech' end as kind) k)
select unit, event_id, kind, parent from st where kind is not null""")
def w13_kinds_with_state(spark, d):
    return turns.classified(_events(spark, d), "unit", ["ts", "event_id"], "event", "speaker", "event_id")


_SAID = ["Zu einer Zwischenbemerkung hat {} das Wort.", "Es gibt eine Zwischenbemerkung. Bitte schön, {}.", "Eine Zwischenbemerkung lasse ich nicht zu. Das Wort hat {}.", "Die Zwischenbemerkung von {} wurde zurückgezogen. {} hat das Wort.", "Das Wort hat {}.", "Zwischenbemerkung? Das Wort zur Zwischenbemerkung hat Niemand."]


@query("""select c_custkey, c_custkey % 6 in (0, 1) as granted from customer""")
def f19_granted_interventions(spark, d):
    """Chairs' texts written for customers: who is granted an intervention, who isn't, who withdrew."""
    k = F.col("c_custkey")
    name = F.regexp_replace("c_name", r"[^A-Za-z]", "")
    text = F.lit(None).cast("string")
    for n, said in enumerate(_SAID):
        text = F.when(k % 6 == n, F.replace(F.lit(said), F.lit("{}"), name)).otherwise(text)
    found = turns.announces(text, "Zwischenbemerkung", r"hat .*das Wort|das Wort .*hat", "Bitte", r"nicht|keine", "zurückgezogen", name)
    return table(spark, d, "customer").select("c_custkey", found.alias("granted"))


@query("""select p_brand, count(*) as n, cast(sum(p_size) as bigint) as size from part where p_brand in (select p_brand from part where p_partkey % 10 = 3) group by 1""")
def s13_batch_list(spark, d):
    """A list for a batch, with blank and repeated entries, comments and other columns, selects what it names."""
    at = f"{run_dir(spark)}/batch-{uuid.uuid4().hex}"
    p = table(spark, d, "part")
    listed = p.filter("p_partkey % 10 = 3").select(F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("brand"), F.col("p_partkey").cast("string").alias("note"))
    odd = spark.createDataFrame([("", "blank"), ("# Brand#1", "comment"), (None, "none")], "brand string, note string")
    listed.unionByName(listed).unionByName(odd).write.option("header", True).option("sep", "\t").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(at)
    names = landing.read_batch(spark, at, "brand")
    got = p.join(names, F.col("p_brand") == F.col("brand"), "left_semi")
    return got.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("bigint").alias("size"))


_TITLE = "o_orderpriority || ' ' || cast(o_custkey % 4 as varchar)"


@query(f"""with v as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, {_TITLE} as title from orders), s as (select * from v where o_orderkey % 5 <> 1)
select v.o_orderkey, case when count(distinct s.o_orderkey) = 1 then 'https://h.example.org/' || min(s.o_orderkey) || '.xlsx' end as sheet from v left join s on s.day = v.day and s.title = v.title group by v.o_orderkey""")
def s8_linked_sheets(spark, d):
    """Pages of links written from orders; each order finds its sheet by day and by the letters and digits of its title, if it is the only one."""
    title = F.concat("o_orderpriority", F.lit(" "), (F.col("o_custkey") % 4).cast("string"))
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), title.alias("title"))
    link = F.concat(F.lit('<li><a class="x" href="https://h.example.org/'), F.col("o_orderkey").cast("string"), F.lit('.xlsx"><b>'), "day", F.lit("</b>: "), F.upper(F.replace("title", F.lit(" "), F.lit(" – "))), F.lit("!</a></li>"))
    pages = o.filter("o_orderkey % 5 <> 1").groupBy("day").agg(F.concat(F.lit('<ul><a href="/next">more</a>'), F.array_join(F.collect_list(link), "\n"), F.lit("</ul>")).alias("html"))
    sheets = markup.sheet_links(pages, "html", r"\.xlsx$")
    key = markup.letters_and_digits
    got = linking.unique_match(o.withColumn("key", key("title")), sheets.select("day", key("title").alias("key"), F.col("href").alias("sheet")), ["day", "key"], "sheet")
    return got.select("o_orderkey", "sheet")


@query("""select o_custkey as page, o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as day, count(*) as n_members, count(*) filter (l_returnflag = 'A') as n_yes from orders join lineitem on o_orderkey = l_orderkey group by 1, 2, 3""")
def s6_list_detail_members(spark, d):
    """List pages of customers, a detail page for each order with its lines as members; scanned and joined again."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    say = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    entry = say('<div class="vote-entry"><span class="date">', F.date_format("o_orderdate", "yyyy-MM-dd"), '</span> <a href="/detail?id=', F.col("o_orderkey"), '">Order</a></div>')
    lists = o.groupBy("o_custkey").agg(F.concat(F.lit("<body>"), F.array_join(F.collect_list(entry), "\n"), F.lit("</body>")).alias("html"))
    row = say('<tr class="member"><td>', F.col("l_suppkey"), "</td><td><i>", F.col("l_returnflag"), "</i></td></tr>")
    details = li.groupBy("l_orderkey").agg(F.concat(F.lit("<table><tr><th>who</th><th>how</th></tr>"), F.array_join(F.collect_list(row), ""), F.lit("</table>")).alias("html"))
    listed = lists.select(F.col("o_custkey").alias("page"), F.explode(markup.entries("html", "vote-entry")).alias("x"))
    listed = listed.select("page", F.regexp_extract("x", r"[?]id=(\d+)", 1).cast("long").alias("id"), F.regexp_extract("x", r'class="date">([^<]*)<', 1).alias("day"))
    members = details.select(F.col("l_orderkey").alias("id"), F.explode(markup.table_cells("html", "member")).alias("c"))
    counted = members.groupBy("id").agg(F.count(F.lit(1)).alias("n_members"), F.count_if(F.col("c")[1] == "A").alias("n_yes"))
    return listed.join(counted, "id").select("page", "id", "day", "n_members", "n_yes")


@query("""with m as (select strftime(o_orderdate, '%Y-%m') as period, count(*) as n from orders group by 1) select period, 'Orders & more: ' || n as title, 'https://h.example.org/' || period as link from m where period < (select max(period) from m)""")
def k5_rss_items(spark, d):
    """RSS items of finished months, read from their XML again; the running month has none."""
    m = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    last = m.agg(F.max("period").alias("last"))
    entries = m.join(F.broadcast(last)).select("period", F.concat(F.lit("Orders & more: "), F.col("n").cast("string")).alias("title"), F.concat(F.lit("https://h.example.org/"), "period").alias("link"), (F.col("period") < F.col("last")).alias("finished"))
    items = sinks.rss_items(entries, "period", "title", "link", "finished")
    read = items.select("period", F.from_xml("item", "title string, link string, guid string").alias("x"))
    return read.select("period", "x.title", "x.link")
