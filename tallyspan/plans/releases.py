"""Archives, releases, samples and spellings of other corpora."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tallyspan.functions import folding
from tallyspan.operators import releases, sketches
from tallyspan.plans.registry import query
from tallyspan.session import run_dir
from tallyspan.sources import archives
from tallyspan.tables import table


def _archives(spark, d):
    """Customers as zipped XML: an archive for each 500 keys, in it a member for each nation; every eleventh member is torn."""
    at = f"{run_dir(spark)}/archives-{uuid.uuid4().hex}"
    c = table(spark, d, "customer").withColumn("part", F.floor(F.col("c_custkey") / 500))

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        part, body = int(rows["part"].iloc[0]), io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            for nation, own in rows.sort_values("c_custkey").groupby("c_nationkey"):
                xml = "".join(f"<MDB><ID>{r.c_custkey}</ID><NAMEN><NAME>{r.c_name}</NAME></NAMEN><PARTEI>{r.c_mktsegment}</PARTEI></MDB>" for r in own.itertuples())
                xml = f"<DOCUMENT><VERSION>2024</VERSION>{xml}</DOCUMENT>"
                z.writestr(f"nation-{nation}.xml", xml[:-20] if (part + nation) % 11 == 0 else xml)
        store, base = fs.FileSystem.from_uri(at) if ":" in at else (fs.LocalFileSystem(), at)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/part-{part}.zip") as out:
            out.write(body.getvalue())
        return pd.DataFrame({"part": [part]})

    c.select("part", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").groupBy("part").applyInPandas(write, "part long").count()
    return archives.read_master_data(spark, at, "MDB")


@query("""select c_custkey as id, c_name as name, c_mktsegment as party, c_nationkey as nation from customer where (c_custkey // 500 + c_nationkey) % 11 <> 0""")
def s11_zipped_master_data(spark, d):
    records, _ = _archives(spark, d)
    f = lambda name: F.element_at("fields", F.lit(name))
    return records.select(f("ID").cast("long").alias("id"), f("NAMEN/NAME").alias("name"), f("PARTEI").alias("party"), F.regexp_extract("member", r"nation-(\d+)", 1).cast("int").alias("nation"))


@query("""with m as (select c_custkey // 500 as part, c_nationkey as nation, string_agg('<MDB><ID>' || c_custkey || '</ID><NAMEN><NAME>' || c_name || '</NAME></NAMEN><PARTEI>' || c_mktsegment || '</PARTEI></MDB>', '' order by c_custkey) as x from customer group by 1, 2)
select 'part-' || part || '.zip' as archive, 'nation-' || nation || '.xml' as member, if((part + nation) % 11 = 0, 'torn', 'whole') as state, case when (part + nation) % 11 <> 0 then sha256('<DOCUMENT><VERSION>2024</VERSION>' || x || '</DOCUMENT>') end as sha256 from m""")
def s11_member_digests(spark, d):
    _, members = _archives(spark, d)
    return members.select(F.regexp_extract("archive", r"([^/]+)$", 1).alias("archive"), "member", "state", "sha256")


def _next_release(orders):
    k = F.col("o_orderkey")
    kept = orders.filter(k % 100 != 11).withColumn("o_totalprice", F.when(k % 100 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return kept.unionByName(orders.filter(k % 100 == 13).withColumn("o_orderkey", k + 100_000_000))


@query("""select o_orderkey, case when o_orderkey % 100 = 11 then 'removed' else 'changed' end as change from orders where o_orderkey % 100 in (7, 11) union all select o_orderkey + 100000000, 'added' from orders where o_orderkey % 100 = 13""")
def x29_release_changes(spark, d):
    """What is new, gone and other between two releases of the orders."""
    o = table(spark, d, "orders")
    r = releases.Releases(spark, f"{run_dir(spark)}/releases-{uuid.uuid4().hex}", "o_orderkey", 64)
    first, _ = r.publish(o)
    second, _ = r.publish(_next_release(o), first)
    return r.changelog(first, second)


@query("""with n as (select count(*) as n from orders) select step, n as n_rows, written as n_written, lines as n_lines from n, (values ('again', 0, 0), ('one row other', 1, 1), ('one row back', 1, 1)) v(step, written, lines)""")
def k4_unchanged_parts(spark, d):
    """A release of the same rows writes nothing; a row that is other costs one part and one line, and so does its return."""
    o = table(spark, d, "orders")
    r = releases.Releases(spark, f"{run_dir(spark)}/releases-{uuid.uuid4().hex}", "o_orderkey", 64)
    one = o.agg(F.min("o_orderkey").alias("k")).first()["k"]
    before, _ = r.publish(o)
    out = []
    steps = {"again": o, "one row other": o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == one, "X").otherwise(F.col("o_orderstatus"))), "one row back": o}
    for step, rows in steps.items():
        name, written = r.publish(rows, before)
        out.append(r.rows(name).agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n_rows"), F.lit(len(written)).alias("n_written")).join(r.changelog(before, name).agg(F.count(F.lit(1)).alias("n_lines"))))
        before = name
    return out[0].unionByName(out[1]).unionByName(out[2])


_LEAST = "cast(('0x' || substr(md5('s:' || {}), 1, 13)) as bigint)"


@query(f"""select row_number() over (order by h, doc_id) as rank, h as hash, doc_id as item from (select distinct doc_id, {_LEAST.format('doc_id')} as h from documents where doc_id is not null) order by h, doc_id limit 50""")
def t8_bounded_sample(spark, d):
    """Fifty documents, the same ones however the table is cut."""
    return sketches.bottom_k(table(spark, d, "documents"), [], "doc_id", 50, "s").withColumn("rank", F.col("rank").cast("long"))


_SKETCH = f"""i as (select distinct l_suppkey % 20 as s, l_partkey as item from lineitem), h as (select *, {_LEAST.format('item')} as h from i),
k as (select * from (select *, row_number() over (partition by s order by h, item) as rank from h) where rank <= 64)"""


@query(f"with {_SKETCH} select s, if(count(*) < 64, count(*)::double, 63 * 4503599627370496::double / (max(h) + 1)) as n_items, count(*) < 64 as is_exact from k group by s")
def t8_set_sizes(spark, d):
    s = sketches.bottom_k(table(spark, d, "lineitem").withColumn("s", F.col("l_suppkey") % 20), ["s"], "l_partkey", 64, "s")
    return sketches.sizes(s, ["s"], 64)


@query(f"""with {_SKETCH}, p as (select distinct a.s as a, b.s as b from k a join k b on a.item = b.item and a.s < b.s),
u as (select a, b, h, item, count(*) as n from (select p.a, p.b, k.h, k.item from p join k on k.s = p.a union all select p.a, p.b, k.h, k.item from p join k on k.s = p.b) group by all),
r as (select *, row_number() over (partition by a, b order by h, item) as rank from u) select a, b, sum((n = 2)::int) / count(*) as jaccard from r where rank <= 64 group by a, b""")
def t8_set_overlaps(spark, d):
    s = sketches.bottom_k(table(spark, d, "lineitem").withColumn("s", F.col("l_suppkey") % 20), ["s"], "l_partkey", 64, "s")
    return sketches.overlaps(s, "s", 64)


_FOLD = "replace(strip_accents(lower(nfc_normalize({}))), 'ß', 'ss')"


@query(f"""with w as (select unnest(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿ]+')) as word from documents), f as (select {_FOLD.format('word')} as key, word from w)
select min(word) as word, count(distinct word) as n_spellings, count(*) as n from f group by key""")
def f23_folded_spellings(spark, d):
    """Words of all documents, met under one key whatever their case and accents."""
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÖØ-öø-ÿ]+)"), F.lit(1))).alias("word"))
    spelled = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelled.groupBy(folding.folded(F.col("word")).alias("key")).agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n")).drop("key")


@query("""with d as (select distinct unnest(regexp_extract_all(text, '[a-zà-öø-ÿ]*[éèêüäöñ][a-zà-öø-ÿ]*')) as word from documents) select word, word as other from d where word <> ''""")
def f23_composed_meets_decomposed(spark, d):
    """Accented words, written with composed letters on one side and with combining marks and capitals on the other, meet in a join."""
    letters = {"é": "é", "è": "è", "ê": "ê", "ü": "ü", "ä": "ä", "ö": "ö", "ñ": "ñ"}
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([a-zà-öø-ÿ]*[éèêüäöñ][a-zà-öø-ÿ]*)"), F.lit(1))).alias("word")).distinct()
    apart = F.upper("word")
    for whole, parts in letters.items():
        apart = F.replace(apart, F.lit(whole.upper()), F.lit(parts.upper()))
    other = words.select(apart.alias("spelling"), F.col("word").alias("other"))
    met = words.join(other, folding.folded(F.col("word")) == folding.folded(F.col("spelling")))
    # words that differ by accents only meet each other too; a word's own spelling is among them
    return met.filter(F.col("word") == F.col("other")).select("word", "other")


@query("""select p_partkey, list_aggregate(list_sort(list_distinct(regexp_extract_all(lower(p_type || '-Gruppe ' || p_name || '/' || p_type), '[a-z0-9]+'))), 'string_agg', ' ') as tokens,
 list_aggregate(list_sort(list_filter(list_distinct(regexp_extract_all(lower(p_type || '-Gruppe ' || p_name || '/' || p_type), '[a-z0-9]+')), lambda x: x <> 'gruppe')), 'string_agg', ' ') as own from part""")
def f23_group_tokens(spark, d):
    x = F.concat("p_type", F.lit("-Gruppe "), "p_name", F.lit("/"), "p_type")
    return table(spark, d, "part").select("p_partkey", folding.group_tokens(x).alias("tokens"), folding.group_tokens(x, ("gruppe",)).alias("own"))
