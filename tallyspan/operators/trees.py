"""Document trees as rows: nodes numbered in document order, with the path of their ancestors."""

from __future__ import annotations

import xml.parsers.expat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tree_nodes(docs: DataFrame, key: str, xml_text: str) -> DataFrame:
    """``(key, pre, last, tag, attrs, path, text)``: the elements of each document, in order.

    ``pre`` numbers elements as they open, ``last`` is the number of the last
    one within, so b lies within a if ``a.pre < b.pre <= a.last``; ``path`` are
    the numbers of the ancestors from the root down. ``text`` is an element's
    own text. A document that is no XML gives one row without a tag.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, pre int, last int, tag string, attrs map<string,string>, path array<int>, text string"

    def nodes(x: str) -> list[list]:
        rows, stack = [], []
        parser = xml.parsers.expat.ParserCreate()
        parser.buffer_text = True

        def opened(tag: str, attrs: dict[str, str]) -> None:
            rows.append([len(rows), 0, tag, list(attrs.items()), list(stack), ""])
            stack.append(rows[-1][0])

        def closed(tag: str) -> None:
            rows[stack.pop()][1] = len(rows) - 1

        def words(data: str) -> None:
            rows[stack[-1]][5] += data

        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = opened, closed, words
        try:
            parser.Parse(x.encode(), True)
        except xml.parsers.expat.ExpatError:
            return [[0, 0, None, [], [], None]]
        return rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, x in zip(b[key], b["__xml"], strict=True):
                found = pd.DataFrame(nodes(x), columns=["pre", "last", "tag", "attrs", "path", "text"])
                found.insert(0, key, [k] * len(found))
                found["attrs"] = [dict(a) for a in found["attrs"]]
                yield found

    return docs.filter(F.col(xml_text).isNotNull()).select(key, F.col(xml_text).alias("__xml")).mapInPandas(run, schema)


def nearest_above(nodes: DataFrame, key: str, marks: DataFrame, value: str) -> DataFrame:
    """``(key, pre, value)``: for each node the ``value`` of the nearest node of ``marks`` above it, or its own.

    Nodes meet marks by the numbers on their path, so the work grows with
    depth, not with the size of a document.
    """
    up = nodes.select(key, "pre", F.explode(F.concat("path", F.array("pre"))).alias("__at"))
    m = marks.select(key, F.col("pre").alias("__at"), F.col(value).alias("__v"))
    return up.join(m, [key, "__at"]).groupBy(key, "pre").agg(F.max_by("__v", "__at").alias(value))


def listed_pages(refs: DataFrame, key: str, ident: str, page: str) -> DataFrame:
    """``(key, ident, page, conflict)`` of a table of contents; a unit listed at two pages is a conflict without a page."""
    g = refs.groupBy(key, ident).agg(F.min(page).alias("__a"), F.max(page).alias("__z"))
    conflict = F.coalesce(F.col("__a") != F.col("__z"), F.lit(False))
    return g.select(key, ident, F.when(~conflict, F.col("__a")).alias(page), conflict.alias("conflict"))


def placed_units(nodes: DataFrame, key: str, unit: Column, item: Column, ident: Column, mark: Column, excluded: DataFrame, refs: DataFrame) -> DataFrame:
    """``(key, unit, item, place, mark, page, state)`` of each unit of each document.

    The passes run in this order, each on what the ones before left: units that
    ``excluded`` ``(key, unit)`` names leave; a unit belongs to the item around
    it (``inside``) or else to the nearest item before it (``adopted``), or to
    none; it has the nearest mark above it, or if it was adopted and has none,
    its item's; its page is the one that ``refs`` ``(key, unit, page)`` list.
    ``state`` is placed, unplaced (no item), page_conflict or no_page.
    """
    base = nodes.withColumns({"__unit": F.coalesce(unit, F.lit(False)), "__item": F.coalesce(item, F.lit(False)), "__id": ident, "__mark": mark})
    w = Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("__before", F.last(F.when(F.col("__item"), F.struct("pre", F.col("__id").alias("id"))), ignorenulls=True).over(w))
    units = base.filter("__unit").join(excluded.select(key, F.col("unit").alias("__id")).distinct(), [key, "__id"], "left_anti")
    around = nearest_above(units, key, base.filter("__item").select(key, "pre", "__id"), "__id").withColumnRenamed("__id", "__around")
    marks = base.filter(F.col("__mark").isNotNull()).select(key, "pre", "__mark")
    over = nearest_above(base.filter("__unit or __item"), key, marks, "__mark").select(key, "pre", F.col("__mark").alias("__over"))
    got = units.join(around, [key, "pre"], "left").join(over, [key, "pre"], "left")
    got = got.withColumn("__place", F.when(F.col("__around").isNotNull(), "inside").when(F.col("__before").isNotNull(), "adopted").otherwise("none"))
    theirs = over.select(key, F.col("pre").alias("__ipre"), F.col("__over").alias("__theirs"))
    got = got.withColumn("__ipre", F.when(F.col("__place") == "adopted", F.col("__before.pre"))).join(theirs, [key, "__ipre"], "left")
    got = got.join(listed_pages(refs, key, "unit", "page").withColumnRenamed("unit", "__id"), [key, "__id"], "left")
    conflict = F.coalesce("conflict", F.lit(False))
    state = F.when(F.col("__place") == "none", "unplaced").when(conflict, "page_conflict").when(F.col("page").isNull(), "no_page").otherwise("placed")
    return got.select(key, F.col("__id").alias("unit"), F.coalesce("__around", F.col("__before.id")).alias("item"), F.col("__place").alias("place"), F.coalesce("__over", "__theirs").alias("mark"), "page", state.alias("state"))


def annex_places(rows: DataFrame, doc: str, order: list[str], heading: Column, ref: Column, page: Column, submission: Column, items: DataFrame, item: str) -> DataFrame:
    """``rows`` that are submissions, with ``context``, ``item``, ``page`` and ``state``.

    A heading begins a context, and references don't reach out of theirs. A
    submission belongs to the item that its context has named so far, if it is
    one item, and one only of that name is in ``items`` ``(doc, item)``: else it
    is ``ambiguous``, or ``unreferenced`` if nothing was named. Pages are
    carried forward over contexts; before the first there is none.
    """
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = rows.withColumns({"context": F.sum(yes(heading).cast("int")).over(w), "page": F.last(page, ignorenulls=True).over(w), "__ref": F.when(~yes(heading), ref)})
    within = Window.partitionBy(doc, "context").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"__low": F.min("__ref").over(within), "__high": F.max("__ref").over(within)}).filter(yes(submission))
    known = items.groupBy(doc, F.col(item).alias("__low")).agg(F.count(F.lit(1)).alias("__n"))
    out = out.join(known, [doc, "__low"], "left")
    one = (F.col("__low") == F.col("__high")) & (F.col("__n") == 1)
    state = F.when(F.col("__low").isNull(), "unreferenced").when(yes(one), "assigned").otherwise("ambiguous")
    return out.withColumns({"state": state, "item": F.when(yes(one), F.col("__low"))}).drop("__ref", "__low", "__high", "__n")
