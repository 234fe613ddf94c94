"""Scans of landed files: JSON reports, strict CSV, calendars, zipped master data, staged chunks.

Fetching is no part of the engine: whatever was downloaded lies in a folder
that Spark reads.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def month_chunks(span: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """``(first_day, last_day)`` of every month that the span touches."""
    months = span.select(F.explode(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))).alias("first_day"))
    return months.withColumn("last_day", F.last_day("first_day"))


def grouped_chunks(rows: DataFrame, ident: str, order: list[str], group: str) -> DataFrame:
    """``(group, items)``: ids of staged chunks, the first sighting of each, in order within their group."""
    w = Window.partitionBy(ident).orderBy(*order)
    first = rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    items = F.array_sort(F.collect_list(F.struct(*order, F.col(ident).cast("string").alias("__id"))))
    return first.groupBy(group).agg(F.transform(items, lambda x: x["__id"]).alias("items"))


def counted(rows: DataFrame, key: str, announced: int) -> DataFrame:
    """One row; fails unless the source holds as many different keys as it announced."""
    n = rows.agg(F.count_distinct(key).alias("n"))
    wrong = F.raise_error(F.format_string(f"%d of {announced} announced rows", F.col("n")))
    return n.select(F.when(F.col("n") == announced, F.col("n")).otherwise(wrong.cast("bigint")).alias("n"))


def usable_cache(rows: DataFrame, fetched: str, today: Column, max_days: int, term: str) -> DataFrame:
    """Cached rows at most ``max_days`` old and of a closed term (older than the newest)."""
    newest = rows.agg(F.max(term).alias("__newest"))
    young = F.datediff(today, F.col(fetched)) <= max_days
    return rows.crossJoin(F.broadcast(newest)).filter(young & (F.col(term) < F.col("__newest"))).drop("__newest")


def read_reports(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """``(reports, corrupt)``: nested JSON files by an explicit schema; unreadable ones are kept apart with their file."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    raw = text.select("file", "value", F.from_json("value", f"{schema}, _corrupt string", options).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return raw.filter(~bad).select("r.*", "file").drop("_corrupt"), raw.filter(bad).select("file", F.col("value").alias("content"))


def read_caches(spark: SparkSession, path: str, schema: str, version: int) -> DataFrame:
    """``(file, state, <schema>)``: JSON caches, gzipped or not: usable, of an old_version, or corrupt; only usable ones keep their contents."""
    names = [f.strip().split()[0] for f in schema.split(",")]
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    raw = text.select("file", F.from_json("value", f"version int, {schema}, _corrupt string", options).alias("r"))
    state = F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull() | F.col("r.version").isNull(), "corrupt").when(F.col("r.version") != version, "old_version").otherwise("usable")
    return raw.withColumn("state", state).select("file", "state", *[F.when(F.col("state") == "usable", F.col(f"r.{n}")).alias(n) for n in names])


def read_csv_strict(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV with a header and exactly this schema; malformed rows fail the scan."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path, sep=sep)


def read_batch(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``(column)``: the different entries of a tab-separated list with a header; blanks and lines that begin with # are none, other columns are ignored. Fails without the column."""
    rows = spark.read.option("header", True).option("sep", "\t").csv(path)
    if column not in rows.columns:
        raise ValueError(f"{path}: no column {column!r}")
    entry = F.nullif(F.trim(F.col(column)), F.lit(""))
    return rows.select(entry.alias(column)).filter(F.col(column).isNotNull() & ~F.col(column).startswith("#")).distinct()


def calendar_events(spark: SparkSession, path: str, summary: str) -> DataFrame:
    """``(file, summary, first_day, last_day, week)`` of the all-day events of ICS files whose summary matches.

    Folded lines are joined; the exclusive end becomes the last day; ``week`` is
    null for an event that spans more than one ISO week.
    """
    from tallyspan.functions.scalars import iso_week

    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r?\n[ \t]", "").alias("t"))
    events = text.select("file", F.explode(F.regexp_extract_all("t", F.lit(r"(?s)BEGIN:VEVENT(.*?)END:VEVENT"), F.lit(1))).alias("e"))
    day = lambda name: F.try_to_date(F.regexp_extract("e", rf"{name}[^:\r\n]*:([0-9]{{8}})", 1), "yyyyMMdd")
    fields = events.select("file", F.trim(F.regexp_extract("e", r"SUMMARY[^:\r\n]*:([^\r\n]*)", 1)).alias("summary"), day("DTSTART").alias("first_day"), F.date_sub(F.coalesce(day("DTEND"), F.date_add(day("DTSTART"), 1)), 1).alias("last_day"))
    one = iso_week("first_day") == iso_week("last_day")
    return fields.filter(F.col("summary").rlike(summary)).withColumn("week", F.when(one, iso_week("first_day")))


def read_zipped_csv(spark: SparkSession, path: str, schema: str, max_bytes: int = 256 << 20) -> DataFrame:
    """The rows of the only CSV in each zip file; other contents and oversized members fail."""
    names = [f.split()[0] for f in schema.split(",")]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    members = [m for m in z.infolist() if m.filename.lower().endswith(".csv")]
                    if len(members) != 1 or members[0].file_size > max_bytes:
                        raise ValueError(f"one CSV of at most {max_bytes} bytes expected, found {[m.filename for m in members]}")
                    with z.open(members[0]) as f:
                        got = list(csv.DictReader(io.TextIOWrapper(f, "utf-8-sig")))
                missing = set(names) - set(got[0] if got else names)
                if missing:
                    raise ValueError(f"columns missing: {sorted(missing)}")
                yield pd.DataFrame(got, columns=names, dtype=object)

    text = ", ".join(f"{n} string" for n in names)
    out = spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, text)
    return out.select(*[F.expr(f"try_cast({f.split()[0]} as {f.split()[1]})").alias(f.split()[0]) for f in schema.split(",")])
