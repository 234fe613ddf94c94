"""Scans, sinks and streams on small files."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspan.sources import landing, markup, sinks
from tallyspan.streaming import weekly


def test_calendar(spark, tmp_path):
    (tmp_path / "c.ics").write_bytes(
        "﻿BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nDTSTART;VALUE=DATE:20260112\r\nDTEND;VALUE=DATE:20260117\r\nSUMMARY:Session w\r\n eek\r\nEND:VEVENT\r\n"
        "BEGIN:VEVENT\r\nDTSTART;VALUE=DATE:20260110\r\nDTEND;VALUE=DATE:20260114\r\nSUMMARY:Session long\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART:20260201\r\nSUMMARY:Holiday\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n".encode()
    )
    got = [(r.summary, r.first_day, r.last_day, r.week) for r in landing.calendar_events(spark, str(tmp_path / "c.ics"), "^Session").orderBy("summary").collect()]
    assert got == [("Session long", dt.date(2026, 1, 10), dt.date(2026, 1, 13), None), ("Session week", dt.date(2026, 1, 12), dt.date(2026, 1, 16), "2026-W03")]


def test_strict_csv_zip_and_reports(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,x\n2,\n")
    assert landing.read_csv_strict(spark, str(tmp_path / "a.csv"), "id int, n string").count() == 2
    with pytest.raises(Exception, match="does not conform"):
        landing.read_csv_strict(spark, str(tmp_path / "a.csv"), "id int, other string").collect()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("data.csv", "id,n,more\n7,q,1\n8,w,2\n")
    (tmp_path / "z.zip").write_bytes(buf.getvalue())
    assert [tuple(r) for r in landing.read_zipped_csv(spark, str(tmp_path / "z.zip"), "id int, n string").collect()] == [(7, "q"), (8, "w")]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"id": 1, "items": [{"t": "x"}]}')
    (tmp_path / "j" / "b.json").write_text('{"id": ')
    good, corrupt = landing.read_reports(spark, str(tmp_path / "j"), "id int, items array<struct<t:string>>")
    assert [r.id for r in good.collect()] == [1]
    assert corrupt.count() == 1
    with pytest.raises(PySparkException, match="announced"):
        landing.counted(good, "id", 2).collect()


def test_ordered_xml_and_html_tables(spark, tmp_path):
    (tmp_path / "p.xml").write_text(
        '<doc><tagesordnungspunkt top-id="T1"><rede id="R1"><p klasse="redner"><redner id="5"><name><vorname>Ann</vorname><nachname>Bo</nachname><fraktion>G1</fraktion></name></redner>Ann Bo:</p>'
        '<p klasse="J">Hello  there</p><kommentar>(Applause)</kommentar><p klasse="J">more</p></rede><rede id="R2"><p klasse="J">nobody</p></rede></tagesordnungspunkt></doc>'
    )
    units = markup.xml_units(spark, str(tmp_path / "p.xml"))
    assert [(r.pos, r.unit, r.kind) for r in units.orderBy("pos").collect()] == [(0, "R1", "redner"), (1, "R1", "J"), (2, "R1", None), (3, "R1", "J"), (4, "R2", "J")]
    assert [(r.item, r.unit, r.speaker, r.name, r.grp, r.n_paragraphs, r.n_chars) for r in markup.speeches(units).collect()] == [("T1", "R1", "5", "Ann Bo", "G1", 2, 15)]
    html = spark.createDataFrame([("<table><tr class='h'><th>N</th></tr><tr class=\"row x\"><td>Ann <b>Bo</b></td><td> yes\n</td></tr></table>",)], "h string")
    assert html.select(markup.table_cells("h").alias("c")).first().c == [["N"], ["Ann Bo", "yes"]]
    assert html.select(markup.table_cells("h", "row").alias("c")).first().c == [["Ann Bo", "yes"]]
    listed = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (9, 8, 8, 5)], "d date")
    ask = lambda day, n: tuple(markup.bounded_scan(listed, "d", F.lit(day).cast("date"), n).first())
    assert ask("2024-01-08", 9) == (2, "passed") and ask("2024-01-05", 9) == (1, "list_end") and ask("2024-01-05", 2) == (0, "budget")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    at = str(tmp_path / "snap")
    assert sinks.write_if_changed(df, at) and not sinks.write_if_changed(df.repartition(2), at)
    assert sinks.write_if_changed(df.filter("k = 1"), at)
    assert [tuple(r) for r in sinks.current(spark, at).collect()] == [(1, "a")]
    manifest = {r.name: r.n for r in sinks.export_csv({"t": df, "u": df.limit(0)}, str(tmp_path / "out")).collect()}
    assert manifest == {"t": 2, "u": 0}
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "t")).count() == 2
    new = spark.createDataFrame([(2, "z")], "k int, v string")
    assert sorted(tuple(r) for r in sinks.replace_units(df, new, "k").collect()) == [(1, "a"), (2, "z")]
    facts = spark.createDataFrame([("w1", 1, "a"), ("w1", 0, "b"), ("w2", 0, "c")], "w string, rank int, t string")
    got = {r.w: r.entry for r in sinks.feed(facts, "w", "rank", 1).collect()}
    assert got == {"w2": '{"schema_version":1,"w":"w2","facts":[{"rank":0,"t":"c"}]}'}
    items = sinks.rss_items(spark.createDataFrame([("w1", "A & B", "http://x", True), ("w2", "c", "http://y", False)], "w string, t string, l string, done boolean"), "w", "t", "l", "done").collect()
    assert len(items) == 1 and "<title>A &amp; B</title>" in items[0].item


def test_stream_equals_batch_and_keeps_late_rows_within_the_watermark(spark, tmp_path):
    first = [(1, dt.datetime(2024, 1, 10, 12), "a", 5), (2, dt.datetime(2024, 1, 15, 0), "a", 7)]
    late = [(3, dt.datetime(2024, 1, 8, 1), "a", 1)]
    schema = "id int, ts timestamp, t string, v int"
    for rows in (first, late):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        weekly.run_available(weekly.weekly_counts(s, "ts", ["t"], "v"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r.week_start, r.n, r.total) for r in weekly.newest_versions(spark, str(tmp_path / "out"), ["t"]).collect())
    want = sorted((r.week_start, r.n, r.total) for r in weekly.weekly_counts(spark.read.parquet(str(tmp_path / "in")), "ts", ["t"], "v").collect())
    assert got == want == [(dt.datetime(2024, 1, 8), 2, 6), (dt.datetime(2024, 1, 15), 1, 7)]
