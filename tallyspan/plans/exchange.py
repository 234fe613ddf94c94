"""Round trips: tables written in a foreign form, scanned back by the sources, and checked against the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyspan.operators import choices, diffs, identity
from tallyspan.plans.registry import query
from tallyspan.session import run_dir
from tallyspan.sources import landing, markup, sinks
from tallyspan.tables import table


def _place(spark, label: str) -> str:
    """A fresh folder for what a query writes."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _xml_text(c):
    """Text as it may stand in XML: markup characters as references, control characters left out."""
    plain = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "")
    return F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("select count(distinct o_orderkey) as n from orders")
def s2_counted_list(spark, d):
    o = table(spark, d, "orders")
    return landing.counted(o, "o_orderkey", o.select("o_orderkey").distinct().count())


@query("""select 'Sitzung ' || strftime(day, '%Y-%m-%d') as summary, strftime(day, '%Y-%m-%d') as first_day, strftime(day + cast(span as integer), '%Y-%m-%d') as last_day,
case when strftime(day, '%G-W%V') = strftime(day + cast(span as integer), '%G-W%V') then strftime(day, '%G-W%V') end as week
from (select cast(o_orderdate as date) as day, count(*) % 4 as span from orders group by 1)""")
def s10_calendar_scan(spark, d):
    days = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg((F.count(F.lit(1)) % 4).cast("int").alias("span"))
    stamp = lambda c: F.date_format(c, "yyyyMMdd")
    event = F.concat(
        F.lit("BEGIN:VEVENT\r\nDTSTART;VALUE=DATE:"), stamp("day"), F.lit("\r\nDTEND;VALUE=DATE:"), stamp(F.date_add("day", F.col("span") + 1)),
        F.lit("\r\nSUMMARY:Sitz\r\n ung "), F.date_format("day", "yyyy-MM-dd"), F.lit("\r\nEND:VEVENT\r\n"),
    )
    at = _place(spark, "calendar")
    days.select(event.alias("value")).write.text(at)
    found = landing.calendar_events(spark, at, "^Sitzung")
    return found.select("summary", F.date_format("first_day", "yyyy-MM-dd").alias("first_day"), F.date_format("last_day", "yyyy-MM-dd").alias("last_day"), "week")


@query("select s_nationkey, count(*) as n, cast(sum(cast(round(s_acctbal * 100) as bigint)) as bigint) as cents, min(s_name) as first_name from supplier group by 1")
def s12_strict_csv_scan(spark, d):
    at = _place(spark, "csv")
    table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.option("header", True).csv(at)
    rows = landing.read_csv_strict(spark, at, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    return rows.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("s_acctbal") * 100).cast("bigint")).alias("cents"), F.min("s_name").alias("first_name"))


@query("select p_brand, count(*) as n, cast(sum(p_size) as bigint) as size from part group by 1")
def s13_tsv_batch_scan(spark, d):
    at = _place(spark, "tsv")
    table(spark, d, "part").select("p_partkey", "p_brand", "p_size").write.option("header", True).option("sep", "\t").csv(at)
    rows = landing.read_csv_strict(spark, at, "p_partkey long, p_brand string, p_size int", sep="\t")
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("bigint").alias("size"))


@query("""select n_nationkey, n_name, (select count(*) from supplier where s_nationkey = n_nationkey) as n_suppliers, (select min(s_suppkey) from supplier where s_nationkey = n_nationkey) as first_supplier, n_nationkey % 7 = 3 as corrupt
from nation where n_nationkey % 7 <> 3 union all select n_nationkey, null, null, null, true from nation where n_nationkey % 7 = 3""")
def s15_report_scan(spark, d):
    """Nested reports of at most a thousand keys, one file each; those that break off are kept apart."""
    s = table(spark, d, "supplier").groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 1000).alias("part")).agg(F.array_sort(F.collect_list(F.struct(F.col("s_suppkey").alias("id")))).alias("items"))
    n = table(spark, d, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    report = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), "items"))
    torn = F.when(F.col("n_nationkey") % 7 == 3, F.concat(F.lit('{"id": '), F.col("n_nationkey").cast("string"))).otherwise(report)
    at = _place(spark, "reports")
    k = F.concat(F.col("n_nationkey").cast("string"), F.lit("-"), F.coalesce("part", F.lit(0)).cast("string"))
    n.select(k.alias("k"), torn.alias("value")).repartition("k").write.partitionBy("k").text(at)
    good, corrupt = landing.read_reports(spark, f"{at}/*/*.txt", "id int, name string, items array<struct<id:long>>")
    items = F.transform("items", lambda x: x["id"])
    a = good.groupBy(F.col("id").alias("n_nationkey"), F.col("name").alias("n_name")).agg(F.sum(F.coalesce(F.size("items"), F.lit(0))).cast("bigint").alias("n_suppliers"), F.min(F.array_min(items)).alias("first_supplier"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("n_name", "string"), ("n_suppliers", "bigint"), ("first_supplier", "bigint"))]
    torn = corrupt.select(F.regexp_extract("content", "[0-9]+", 0).cast("int").alias("n_nationkey")).distinct()
    return a.withColumn("corrupt", F.lit(False)).unionByName(torn.select("n_nationkey", *none, F.lit(True).alias("corrupt")))


@query("""select case when c_nationkey % 5 = 0 then 'old_version' when c_nationkey % 5 = 1 then 'corrupt' else 'usable' end as state, count(distinct c_nationkey) as n_files, case when c_nationkey % 5 > 1 then count(*) end as n_items from customer group by c_nationkey % 5 = 0, c_nationkey % 5 = 1, c_nationkey % 5 > 1""")
def s16_cache_scan(spark, d):
    """Gzipped caches of at most a thousand keys: of the version asked for, of another, or unreadable."""
    part = F.floor(F.col("c_custkey") / 1000).alias("part")
    c = table(spark, d, "customer").groupBy("c_nationkey", part).agg(F.array_sort(F.collect_list("c_custkey")).alias("items"))
    cache = F.to_json(F.struct(F.when(F.col("c_nationkey") % 5 == 0, 1).otherwise(2).alias("version"), F.col("items").alias("items")))
    at = _place(spark, "caches")
    k = F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.col("part").cast("string"))
    c.select(k.alias("k"), F.when(F.col("c_nationkey") % 5 == 1, F.lit("{")).otherwise(cache).alias("value")).repartition("k").write.partitionBy("k").option("compression", "gzip").text(at)
    held = landing.read_caches(spark, f"{at}/*/*.gz", "items array<long>", version=2)
    nation = F.regexp_extract("file", r"/k=(\d+)-", 1)
    return held.groupBy("state").agg(F.count_distinct(nation).alias("n_files"), F.sum(F.when(F.col("state") == "usable", F.size("items"))).cast("bigint").alias("n_items"))


@query("""with t as (select conv_id, turn, role, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '[\\s\\x{00a0}\\x{1c}-\\x{1f}\\x{85}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) as w from conversations)
select cast(conv_id as varchar) as item, role as speaker, count(*) as n_paragraphs, cast(sum(length(w)) as bigint) as n_chars from t group by conv_id, role""")
def s5_ordered_units_scan(spark, d):
    """Conversations as ordered XML, an item each and a unit for each of its turns; scanned back to who said how much."""
    c = table(spark, d, "conversations").filter("conv_id is not null")
    said = F.concat(
        F.lit('<rede id="'), F.col("turn").cast("string"), F.lit('"><p klasse="redner"><redner id="'), F.col("role"), F.lit('"><name><nachname>'), F.col("role"),
        F.lit('</nachname></name></redner></p><p klasse="J">'), _xml_text(F.coalesce("text", F.lit(""))), F.lit("</p></rede>"),
    )
    items = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", said.alias("x")))), lambda x: x["x"]), "").alias("x"))
    body = F.concat(F.lit('<tagesordnungspunkt top-id="'), F.col("conv_id").cast("string"), F.lit('">'), F.col("x"), F.lit("</tagesordnungspunkt>"))
    part = F.pmod(F.xxhash64("conv_id"), F.lit(1 + items.count() // 100))  # about a hundred items a file
    files = items.groupBy(part.alias("k")).agg(F.concat(F.lit("<doc>"), F.array_join(F.collect_list(body), ""), F.lit("</doc>")).alias("value"))
    at = _place(spark, "sitting")
    files.repartition("k").write.partitionBy("k").option("lineSep", "\n").text(at)
    got = markup.speeches(markup.xml_units(spark, f"{at}/*/*.txt"))
    return got.groupBy("item", "speaker").agg(F.sum("n_paragraphs").alias("n_paragraphs"), F.sum("n_chars").cast("bigint").alias("n_chars"))


@query("select n_name, r_name, cast(n_nationkey as varchar) as no from nation join region on n_regionkey = r_regionkey")
def s6_member_table_scan(spark, d):
    """A list page of regions, each with a table of its nations; cells back to rows."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.concat(F.lit('<tr class="row">\n<td><b>'), F.col("n_name"), F.lit("</b> </td><td>\n"), F.col("n_nationkey").cast("string"), F.lit("</td></tr>"))
    pages = n.groupBy("r_name").agg(F.concat(F.lit('<table><tr class="head"><th>Name</th><th>No</th></tr>'), F.array_join(F.collect_list(row), "\n"), F.lit("</table>")).alias("html"))
    return pages.select("r_name", F.explode(markup.table_cells("html", "row")).alias("c")).select(F.col("c")[0].alias("n_name"), "r_name", F.col("c")[1].alias("no"))


@query("""with l as (select o_orderdate, row_number() over (order by o_orderdate desc, o_orderkey) as n from orders), t as (select cast(o_orderdate as date) as target from l where n = (select least(50, count(*)) from l)),
f as (select * from l where n <= 200) select count(*) filter (cast(o_orderdate as date) = target) as n_found, case when bool_or(cast(o_orderdate as date) < target) then 'passed' when count(*) < 200 then 'list_end' else 'budget' end as scan_end from f, t""")
def s7_bounded_scan(spark, d):
    listed = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    target = listed.orderBy(F.desc("day")).limit(50).agg(F.min("day").alias("t")).first()["t"]
    return markup.bounded_scan(listed, "day", F.lit(target), 200).select(F.col("n_found").cast("bigint").alias("n_found"), "scan_end")


@query("""with a as (select page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>', 1)) as href from pages where html is not null)
select page_id, count(*) as n_links, count(distinct href) as n_different, min(href) as first_link from a group by 1""")
def s9_link_scan(spark, d):
    links = table(spark, d, "pages").select("page_id", F.explode(markup.links("html")).alias("l"))
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"), F.count_distinct("l.href").alias("n_different"), F.min("l.href").alias("first_link"))


@query("select 1 as write_no, true as wrote, count(*) as n from nation union all select 2, false, count(*) from nation union all select 3, true, count(*) filter (n_regionkey <> 0) from nation")
def k3_snapshot_sink(spark, d):
    """The same rows in another order write nothing; fewer rows do."""
    n, at, out = table(spark, d, "nation"), _place(spark, "snapshot"), []
    for no, rows in enumerate((n, n.repartition(3, "n_name"), n.filter("n_regionkey <> 0")), 1):
        wrote = sinks.write_if_changed(rows, at)
        out.append(sinks.current(spark, at).agg(F.lit(no).alias("write_no"), F.lit(wrote).alias("wrote"), F.count(F.lit(1)).alias("n")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("select 'customer' as name, count(*) as n, true as verified from customer union all select 'nation', count(*), true from nation union all select 'torn', count(*), false from region")
def x29_export_verification(spark, d):
    """An export read back against its manifest; a table that lost a row afterwards is told apart."""
    at = _place(spark, "export")
    tables = {"customer": table(spark, d, "customer"), "nation": table(spark, d, "nation"), "torn": table(spark, d, "region")}
    sinks.export_csv(tables, at)
    tables["torn"].filter("r_regionkey > 0").write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{at}/torn")
    return sinks.verify_export(spark, at, {name: df.schema for name, df in tables.items()})


@query("""with m as (select strftime(o_orderdate, '%Y-%m') as period, o_orderpriority as kind, count(*) as n from orders group by 1, 2), last as (select distinct period from m order by period desc limit 12)
select period, count(*) as n_facts, cast(sum(n) as bigint) as total, min(kind) as first_kind from m where period in (select period from last) group by 1""")
def k5_feed(spark, d):
    """Entries of the newest twelve periods, read back from their JSON."""
    o = table(spark, d, "orders")
    facts = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_orderpriority").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    entry = F.from_json("entry", "schema_version int, period string, facts array<struct<kind:string,n:long>>")
    got = sinks.feed(facts, "period", "kind").select(entry.alias("e")).select("e.period", F.explode("e.facts").alias("f"))
    return got.groupBy("period").agg(F.count(F.lit(1)).alias("n_facts"), F.sum("f.n").alias("total"), F.min("f.kind").alias("first_kind"))


@query("""with recursive down(n, off) as (select n_nationkey, n_nationkey % 9 = 4 from nation where n_nationkey % 9 = 4 union select b.n_nationkey, true from down join nation b on b.n_nationkey = down.n + 5)
select n_nationkey, n_nationkey not in (select n from down) as runs from nation""")
def c13_dependency_closure(spark, d):
    """Each nation's feature needs that of the nation five before; some are vetoed, and all that need them fall with them."""
    n, k = table(spark, d, "nation").select("n_nationkey"), F.col("n_nationkey")
    needs = n.filter(k >= 5).select("n_nationkey", (k - 5).alias("need"))
    got = choices.feature_states(n, needs, n.filter(k % 9 == 4), "n_nationkey", "need")
    return got.select("n_nationkey", (F.col("state") == "runs").alias("runs"))


@query("select 'fold_evidence' as query, true as same, count(distinct l_partkey) as n from lineitem union all select 'order_counts', true, count(distinct o_custkey) from orders")
def x24_order_independence(spark, d):
    """Queries over their input in its own order, reversed, and dealt anew: the digests agree."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    fold = lambda df: identity.fold_evidence(df, "l_partkey", ["l_returnflag"], [], ["l_quantity", "l_extendedprice"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"])
    count = lambda df: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first"))
    return diffs.order_independent({"fold_evidence": (fold, li, "l_orderkey"), "order_counts": (count, o, "o_orderkey")})
