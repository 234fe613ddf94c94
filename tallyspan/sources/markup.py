"""Units of XML and HTML files: one small parser per file, everything ordered is done by Spark windows."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNITS = "file string, pos int, item string, unit string, tag string, kind string, speaker string, name string, grp string, role string, text string"


def _elements(root: ET.Element, roles: dict[str, str]) -> Iterator[tuple]:
    """Paragraph-like elements in document order with the item and the unit they stand in."""

    def walk(node: ET.Element, item: str | None, unit: str | None) -> Iterator[tuple]:
        item = node.get(roles["item_id"], item) if node.tag == roles["item"] else item
        unit = node.get(roles["unit_id"], unit) if node.tag == roles["unit"] else unit
        speaker = node.find(roles["speaker"]) if node.tag == roles["paragraph"] else None
        if node.tag in (roles["paragraph"], roles["comment"], roles["chair"]):
            person = speaker.find(".//name") if speaker is not None else None
            part = lambda tag: person.findtext(tag) if person is not None else None
            full = " ".join(x for x in (part("vorname"), part("nachname")) if x) or None
            role = person.findtext(".//rolle_lang") if person is not None else None
            own = "".join(node.itertext()) if speaker is None else (speaker.tail or "")
            yield item, unit, node.tag, node.get(roles["kind"]), speaker.get("id") if speaker is not None else None, full, part("fraktion"), role, " ".join(own.split())
        for child in node:
            if child.tag != roles["speaker"]:
                yield from walk(child, item, unit)

    return walk(root, None, None)


#: Tag and attribute names of the sitting XML.
SITTING = {"item": "tagesordnungspunkt", "item_id": "top-id", "unit": "rede", "unit_id": "id", "paragraph": "p", "kind": "klasse", "speaker": "redner", "comment": "kommentar", "chair": "name"}


def xml_units(spark: SparkSession, path: str, roles: dict[str, str] | None = None, max_bytes: int = 64 << 20) -> DataFrame:
    """Flat rows of ordered XML; a file with a DTD or above ``max_bytes`` fails."""
    names = roles or SITTING
    columns = [c.split()[0] for c in UNITS.split(", ")]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                if len(content) > max_bytes or b"<!ENTITY" in content:
                    raise ValueError(f"{file}: too large, or entity declarations")
                found = list(_elements(ET.fromstring(content), names))
                yield pd.DataFrame([(file, n, *x) for n, x in enumerate(found)], columns=columns)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, UNITS)


def attributed(units: DataFrame) -> DataFrame:
    """Units with the speaker, name, group and role that hold at each place: those last named in its unit."""
    w = Window.partitionBy("file", "unit").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hold = lambda c: F.last(F.when(F.col("speaker").isNotNull(), F.struct(c)), ignorenulls=True).over(w)[c]
    return units.withColumns({f"at_{c}": hold(c) for c in ("speaker", "name", "grp", "role")})


def speeches(units: DataFrame, body: tuple[str, ...] = ("J", "J_1", "O")) -> DataFrame:
    """``(file, item, unit, speaker, name, grp, role, n_paragraphs, n_chars)``: the body paragraphs of each unit and speaker."""
    own = attributed(units).filter(F.col("unit").isNotNull() & F.col("kind").isin(list(body)) & F.col("at_speaker").isNotNull())
    return own.groupBy("file", "item", "unit", F.col("at_speaker").alias("speaker")).agg(
        F.min("at_name").alias("name"), F.min("at_grp").alias("grp"), F.min("at_role").alias("role"), F.count(F.lit(1)).alias("n_paragraphs"), F.sum(F.length("text")).alias("n_chars")
    )


def table_cells(html: Column | str, row_class: str | None = None) -> Column:
    """The cells of each table row as arrays of plain texts."""
    opening = f'<tr[^>]*class="[^"]*{row_class}[^"]*"[^>]*>' if row_class else "<tr[^>]*>"
    rows = F.regexp_extract_all(F.col(html) if isinstance(html, str) else html, F.lit(f"(?is){opening}(.*?)</tr>"), F.lit(1))
    plain = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "(?s)<[^>]*>", " "), r"\s+", " "))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit("(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), plain))


def links(html: Column | str) -> Column:
    """The links of a page in order, as (href, text)."""
    found = F.regexp_extract_all(F.col(html) if isinstance(html, str) else html, F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?(?=</a>|<a\s|$)'), F.lit(0))
    plain = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "(?s)<[^>]*>", " "), r"\s+", " "))
    return F.transform(found, lambda x: F.struct(F.regexp_extract(x, '(?is)href="([^"]*)"', 1).alias("href"), plain(x).alias("text")))


def entries(html: Column | str, entry_class: str) -> Column:
    """The markup of each entry of a list page: from an opening tag of that class to the next one or the end."""
    page = F.col(html) if isinstance(html, str) else html
    opening = rf'(?i)<[a-z]+[^>]*class="[^"]*\b{entry_class}\b[^"]*"[^>]*>'
    return F.slice(F.split(page, opening), 2, F.greatest(F.size(F.split(page, opening)) - 1, F.lit(0)))


def letters_and_digits(x: Column | str) -> Column:
    """A title as a key: its letters and digits, whatever their case and what stands between."""
    return F.lower(F.regexp_replace(F.col(x) if isinstance(x, str) else x, r"[^\p{L}\p{N}]", ""))


def sheet_links(pages: DataFrame, html: str, wanted: str) -> DataFrame:
    """``(day, title, href)`` of the links of pages whose address matches ``wanted`` and whose text begins with a date and a colon."""
    each = pages.select(F.explode(links(html)).alias("l")).filter(F.col("l.href").rlike(wanted))
    day, title = F.regexp_extract("l.text", r"^\s*(\d{4}-\d{2}-\d{2})\s*:", 1), F.regexp_extract("l.text", r"(?s)^\s*\d{4}-\d{2}-\d{2}\s*:\s*(.*)$", 1)
    return each.select(F.nullif(day, F.lit("")).alias("day"), title.alias("title"), F.col("l.href").alias("href")).filter("day is not null")


def bounded_scan(listed: DataFrame, date: str, target: Column, budget: int) -> DataFrame:
    """One row on a newest-first list: rows of the target day and how the scan ended (passed the day, list end, or out of budget)."""
    w = Window.orderBy(F.desc(date))  # a landed list page, bounded by the budget
    few = listed.orderBy(F.desc(date)).limit(budget).withColumn("__n", F.row_number().over(w))
    g = few.agg(F.count_if(F.col(date) == target).alias("n_found"), F.bool_or(F.col(date) < target).alias("__passed"), F.count(F.lit(1)).alias("__seen"))
    end = F.when(F.col("__passed"), "passed").when(F.col("__seen") < budget, "list_end").otherwise("budget")
    return g.select("n_found", end.alias("scan_end"))
