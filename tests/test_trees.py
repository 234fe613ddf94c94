from pyspark.sql import functions as F

from tallyspan.operators import trees, units

DOC = """<doc><toc><ref rid="u1" page="3"/><ref rid="u2" page="4"/><ref rid="u2" page="5"/><ref rid="u4" page="6"/><ref rid="u4" page="6"/></toc>
<unit id="u0">early</unit><item id="i1" mark="M"><unit id="u1">one<b>two</b>three</unit><group mark="G"><unit id="u2"/></group></item><unit id="u3"/><unit id="u4"/><item id="i2"/><unit id="u5"/></doc>"""


def placed(spark, gone):
    docs = spark.createDataFrame([(1, DOC), (2, "<broken>"), (3, None), (4, "<doc><unit id='u0'/></doc>")], "k int, x string")
    nodes = trees.tree_nodes(docs, "k", "x")
    tag, at = F.col("tag"), lambda n: F.element_at("attrs", F.lit(n))
    refs = nodes.filter(tag == "ref").select("k", at("rid").alias("unit"), at("page").cast("int").alias("page"))
    out = spark.createDataFrame([(1, g) for g in gone], "k int, unit string")
    return nodes, {(r.k, r.unit): (r.item, r.place, r.mark, r.page, r.state) for r in trees.placed_units(nodes, "k", tag == "unit", tag == "item", at("id"), at("mark"), out, refs).collect()}


def test_numbers_paths_and_texts(spark):
    nodes, _ = placed(spark, [])
    rows = {(r.k, r.pre): r for r in nodes.collect()}
    u1 = next(r for r in rows.values() if (r.attrs or {}).get("id") == "u1")
    assert u1.text == "onethree" and [rows[1, p].tag for p in u1.path] == ["doc", "item"] and u1.last == u1.pre + 1
    assert rows[1, 0].last == max(p for k, p in rows if k == 1)
    assert [r.tag for k, r in ((k, r) for (k, _), r in rows.items()) if k == 2] == [None]


def test_passes_in_order(spark):
    _, got = placed(spark, [])
    assert got == {
        (1, "u0"): (None, "none", None, None, "unplaced"),
        (1, "u1"): ("i1", "inside", "M", 3, "placed"),
        (1, "u2"): ("i1", "inside", "G", None, "page_conflict"),
        (1, "u3"): ("i1", "adopted", "M", None, "no_page"),
        (1, "u4"): ("i1", "adopted", "M", 6, "placed"),
        (1, "u5"): ("i2", "adopted", None, None, "no_page"),
        (4, "u0"): (None, "none", None, None, "unplaced"),
    }
    _, less = placed(spark, ["u3", "u0"])
    assert set(got) - set(less) == {(1, "u3"), (1, "u0")} and less[1, "u4"] == got[1, "u4"]


def test_annexes_reset_their_context(spark):
    rows = [  # doc, pos, kind, value
        ("d", 0, "sub", None), ("d", 1, "page", "7"), ("d", 2, "head", None), ("d", 3, "sub", None), ("d", 4, "ref", "T1"), ("d", 5, "sub", None), ("d", 6, "ref", "T1"), ("d", 7, "sub", None),
        ("d", 8, "ref", "T2"), ("d", 9, "sub", None), ("d", 10, "head", None), ("d", 11, "sub", None), ("d", 12, "page", "8"), ("d", 13, "ref", "T3"), ("d", 14, "sub", None), ("d", 15, "head", None), ("d", 16, "ref", "T9"), ("d", 17, "sub", None),
    ]
    df = spark.createDataFrame(rows, "doc string, pos int, kind string, v string").repartition(3)
    items = spark.createDataFrame([("d", "T1"), ("d", "T2"), ("d", "T3"), ("d", "T3"), ("e", "T9")], "doc string, item string")
    is_ = lambda k: F.col("kind") == k
    got = trees.annex_places(df, "doc", ["pos"], is_("head"), F.when(is_("ref"), F.col("v")), F.when(is_("page"), F.col("v")), is_("sub"), items, "item")
    assert {r.pos: (r.context, r.item, r.page, r.state) for r in got.collect()} == {
        0: (0, None, None, "unreferenced"), 3: (1, None, "7", "unreferenced"), 5: (1, "T1", "7", "assigned"), 7: (1, "T1", "7", "assigned"), 9: (1, None, "7", "ambiguous"),
        11: (2, None, "7", "unreferenced"), 14: (2, None, "8", "ambiguous"), 17: (3, None, "8", "ambiguous"),
    }


def test_chains_of_attachments(spark):
    ways = ["b", "o", "b", "b", "b", "a", "a", "o", "x", "o", "a", "b", "o", "a"]
    df = spark.createDataFrame([("u", i, w) for i, w in enumerate(ways)] + [("v", 0, "a"), ("v", 1, None)], "u string, i int, w string").repartition(3)
    w = F.col("w")
    got = {(r.u, r.i): (r.root.i, r.side, r.state) for r in units.attached(df, "u", ["i"], w.isin("b", "x"), w.isin("a", "x")).collect()}
    assert [got["u", i] for i in range(len(ways))] == [
        (0, None, "refused"), (1, None, "own"), (1, "suffix", "attached"), (1, "suffix", "attached"), (1, "suffix", "attached"), (7, "prefix", "attached"), (7, "prefix", "attached"), (7, None, "own"),
        (8, None, "refused"), (9, None, "own"), (10, None, "refused"), (11, None, "refused"), (12, None, "own"), (13, None, "refused"),
    ]
    assert got["v", 0] == (1, "prefix", "attached") and got["v", 1] == (1, None, "own")
