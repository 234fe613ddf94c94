"""Operators on small hand-made tables: ties, nulls, empty inputs, order of rows."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspan.functions import scalars as S
from tallyspan.functions import texts as T
from tallyspan.operators import diffs, histories, identity, intervals, linking, periods, plurality, quality, ranking
from tallyspan.operators.graph import connected_components

DAY = dt.date


def test_plurality_ties_and_unknowns(spark):
    rows = [(1, 3, 1, 0), (2, 2, 2, 1), (3, 0, 0, 0), (4, None, 1, None), (5, None, None, None), (6, 0, 1, 3)]
    df = spark.createDataFrame(rows, "vote int, yes int, no int, abstain int")
    got = {r.vote: r.l for r in df.select("vote", plurality.leading().alias("l")).collect()}
    assert got == {1: "yes", 2: None, 3: None, 4: "no", 5: None, 6: "abstain"}


def test_covers_total_never_takes_unknown_for_zero(spark):
    counts = spark.createDataFrame([(1, 2, 1, 0, 0), (1, 1, 0, 0, 0), (2, 0, 0, 0, 0), (3, 1, None, 0, 0)], "vote int, yes int, no int, abstain int, absent int")
    totals = spark.createDataFrame([(1, 3, 1, 0, 0), (2, 0, 0, 0, 0), (3, 1, None, 0, 0), (4, 1, 1, 1, 1)], "vote int, yes int, no int, abstain int, absent int")
    got = {r.vote: r.covers for r in plurality.covers_total(counts, totals, "vote").collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_components_of_paths_stars_and_noise_in_any_order(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, x) for x in range(201, 260)] + [(300, 300), (None, 5), (400, None), (500, 501), (501, 500), (500, 501)]
    expect = dict.fromkeys(range(61), 0) | dict.fromkeys(range(200, 260), 200) | {500: 500, 501: 500}
    for seed in range(2):
        random.Random(seed).shuffle(edges)
        df = spark.createDataFrame([(*e, "x") for e in edges], "src int, dst int, u string")
        assert {r.node: r.component for r in connected_components(df).collect()} == expect
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_strict_prior_uses_own_term_once_it_is_long_enough(spark):
    rows = [(i, 1 if i < 5 else 2, float(v), v != 99) for i, v in enumerate([1, 5, 3, 99, 2, 4, 6, 1, 7])]
    df = spark.createDataFrame(rows, "p int, term int, v double, ok boolean").withColumn("m", F.lit("a"))
    out = periods.strict_prior(df, ["m"], "p", "v", "term", F.col("ok"), F.lit("max"), F.lit(2))
    got = {r.p: (r.base_kind, r.base_n, r.percentile) for r in out.collect()}
    assert got[0] == ("all", 0, None) and got[1] == ("all", 1, 1.0) and got[2] == ("term", 2, 0.5)
    assert got[3][2] is None  # not usable itself
    assert got[4] == ("term", 3, pytest.approx(1 / 3)) and got[5] == ("all", 4, 0.75)  # the unusable one is in no baseline
    assert got[8] == ("term", 3, 1.0)


def test_metric_registry_refuses_nonsense():
    with pytest.raises(ValueError):
        periods.MetricSpec("x", direction="up")
    with pytest.raises(ValueError):
        periods.MetricSpec("x", min_history=0)
    with pytest.raises(ValueError):
        periods.validate_registry([periods.MetricSpec("a", tie_rank=1), periods.MetricSpec("b", tie_rank=1)])


def test_count_of_nothing_is_zero_but_an_extreme_of_nothing_is_none(spark):
    empty = spark.createDataFrame([], "period string, id string, value double")
    weeks = spark.createDataFrame([("w1",), ("w2",)], "period string")
    assert {r.value for r in periods.observe(empty, periods.MetricSpec("n", aggregation="count"), weeks).collect()} == {0.0}
    assert {r.value for r in periods.observe(empty, periods.MetricSpec("n"), weeks).collect()} == {None}


def test_intervals(spark):
    rows = [(1, "a", DAY(2020, 1, 1), DAY(2020, 1, 5)), (1, "a", DAY(2020, 1, 5), DAY(2020, 1, 9)), (1, "b", DAY(2020, 1, 9), None), (1, None, DAY(2019, 1, 1), DAY(2019, 2, 1))]
    df = spark.createDataFrame(rows, "k int, l string, valid_from date, valid_until date")
    got = {(r.l, r.valid_from, r.valid_until) for r in intervals.coalesce_intervals(df, ["k"], "l").collect()}
    assert got == {("a", DAY(2020, 1, 1), DAY(2020, 1, 9)), ("b", DAY(2020, 1, 9), None), (None, DAY(2019, 1, 1), DAY(2019, 2, 1))}
    facts = spark.createDataFrame([(1, DAY(2020, 1, 4)), (1, DAY(2020, 1, 9)), (1, DAY(2018, 1, 1)), (2, DAY(2020, 1, 4))], "k int, d date")
    assert {(r.d, r.l) for r in intervals.as_of_join(facts, df, ["k"], "d").collect()} == {(DAY(2020, 1, 4), "a"), (DAY(2020, 1, 9), "b")}
    levels = intervals.sweep(df, ["k"]).orderBy("valid_from").collect()
    assert [(r.n, r.valid_from, r.valid_until) for r in levels][-1] == (1, DAY(2020, 1, 1), None)
    bad = spark.createDataFrame([(1, DAY(2020, 1, 5), DAY(2020, 1, 1))], "k int, valid_from date, valid_until date")
    with pytest.raises(PySparkException, match="ends before it starts"):
        intervals.sweep(bad, ["k"]).collect()


def test_diff_digest_and_fingerprint_ignore_order(spark):
    rows = [(i, f"v{i % 3}" if i % 5 else None) for i in range(40)]
    a = spark.createDataFrame(rows, "k int, v string")
    b = spark.createDataFrame(rows[::-1], "k int, v string").repartition(5)
    assert diffs.equal_tables(a, b)
    assert not diffs.equal_tables(a, b.union(b.limit(1)))
    assert not diffs.equal_tables(a, a.withColumn("v", F.coalesce("v", F.lit(""))))
    assert diffs.diff(a, b, ["k"], ["v"]).count() == 0
    c = a.filter("k <> 3").withColumn("v", F.when(F.col("k") != 4, F.col("v")))
    assert {(r.k, r.change) for r in diffs.diff(a, c, ["k"], ["v"]).collect()} == {(3, "removed"), (4, "changed")}
    g = a.withColumn("g", F.col("k") % 4)
    h = a.withColumn("g", F.concat(F.lit("x"), (F.col("k") % 4).cast("string")))
    f = lambda x: diffs.group_fingerprint(x, "g", F.col("k").cast("string")).first()
    assert f(g) == f(h) != f(a.withColumn("g", F.col("k") % 5))


def test_top_with_ties_and_samples(spark):
    def top(values, **kw):
        df = spark.createDataFrame(list(enumerate(values)), "k int, v int")
        return sorted(r.k for r in ranking.top_with_ties(df, "v", [F.col("k")], **kw).collect())

    assert top([9, 8, 7, 6, 5, 5, 1]) == [0, 1, 2, 3, 4, 5]
    assert top([9, 8, 7] + [5] * 20) == [0, 1, 2]
    assert top([5] * 20) == [0, 1, 2, 3, 4]
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("s"))
    one = {r.id for r in ranking.stratified_sample(df, "id", "s", 0.1, 5, 1).collect()}
    assert one == {r.id for r in ranking.stratified_sample(df.repartition(7), "id", "s", 0.1, 5, 1).collect()}
    assert len(one) == 51 and one != {r.id for r in ranking.stratified_sample(df, "id", "s", 0.1, 5, 2).collect()}


def test_links_need_uniqueness(spark):
    items = spark.createDataFrame([("s", 1, [1, 2], "Gesetz über die Fischerei"), ("s", 2, [3], "Haushalt der Kommunen"), ("s", 3, [], "Haushalt der Kommunen")], "s string, i int, n array<int>, t string")
    votes = spark.createDataFrame([("s", 10, [2], "x"), ("s", 11, [9], "gesetz  über die FISCHEREI!"), ("s", 12, [], "Haushalt der Kommunen")], "s string, v int, n array<int>, t string")
    got = {(r.v, r.i, r.basis) for r in linking.ranked_links(items, votes, "i", "v", "s", [("number", "n", "n")], ("t", "t")).collect()}
    assert got == {(10, 1, "number"), (11, 1, "title")}


def test_fold_is_the_same_in_every_order(spark):
    rows = [(1, "a", True, 5, 2), (1, "b", None, 7, 1), (1, "a", False, 9, 3), (2, None, None, None, 1)]
    outs = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, s string, f boolean, v int, o int").repartition(3)
        outs.add(tuple(sorted(map(tuple, identity.fold_evidence(df, "k", ["s"], ["f"], ["v"], ["o"]).collect()))))
    assert outs == {((1, "a,b", True, 7), (2, "", None, None))}


def test_quality_gates(spark):
    src = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    st = spark.createDataFrame([(1,), (2,), (2,), (9,)], "k int")
    assert {(r.k, r.problem) for r in quality.conservation(src, st, "k").collect()} == {(2, "several"), (3, "no_status"), (9, "no_source")}
    with pytest.raises(PySparkException, match="several values"):
        quality.uniform(spark.createDataFrame([(1, 1), (1, 2)], "g int, v int"), "g", "v").collect()
    df = spark.createDataFrame([(None,), (1,), (5,)], "x int")
    assert [r.r for r in df.select(quality.first_reason((F.col("x") > 3, "big")).alias("r")).collect()] == ["big", None, "big"]


def test_turns_and_sessions(spark):
    rows = [(1, i, r) for i, r in enumerate(["system", "assistant", "user", "user", "assistant", "assistant"])]
    got = [(r.kind, r.parent, r.exchange) for r in histories.turn_kinds(spark.createDataFrame(rows, "c int, t int, r string"), "c", "t", "r").orderBy("t").collect()]
    assert got == [("procedure", None, 0), ("statement", None, 0), ("question", None, 1), ("follow_up", None, 1), ("answer", 3, 1), ("resumption", 3, 1)]
    s = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, h)) for h in (0, 1, 5, 20)], "k int, ts timestamp")
    assert [r.session for r in histories.sessions(s, "k", "ts", F.lit(4 * 3600)).orderBy("ts").collect()] == [1, 1, 1, 2]


def test_scalars(spark):
    one = lambda e: spark.range(1).select(e.alias("x")).first().x
    assert one(S.clock_minutes(F.lit("23:30"), F.lit("0:15"))) == 45
    assert one(S.clock_minutes(F.lit("late"), F.lit("0:15"))) is None
    assert one(S.margin(F.lit(0), F.lit(0))) is None
    assert one(S.collapse(F.lit("   "))) is None and one(S.collapse(F.lit(" a\n b "))) == "a b"
    assert one(S.iso_week(F.lit("2027-01-01").cast("date"))) == "2026-W53"
    assert one(S.floor_percent(F.lit(0.99999))) == 99
    assert one(T.canonical_group(F.lit("ABAB"), ["AB", "CD"])) == "AB"
    assert one(T.canonical_group(F.lit("ABCD"), ["AB", "CD"])) is None
    assert one(T.genitive(F.lit("Max"))) == "Max’"
    assert one(T.paragraphs(F.lit("<p>a &amp; <b>b</b></p><script>var t='</p>';</script><div>c<br>d"))) == ["a & b", "c", "d"]
    assert one(T.operative_part(F.lit("x Beschluss: zusam-\nmen  gut\n\nEnde"), "Beschluss:", "\n\n")) == "zusammen gut"
    assert one(T.operative_part(F.lit("Beschluss: a Beschluss: b"), "Beschluss:", "\n\n")) is None


def test_facts_gate_topic_and_tie_value(spark):
    """A metric that needs a topic is posted with one and withheld without; equal values go to the higher tie value, then the lowest id."""
    from tallyspan.operators import periods

    weeks = [(f"2024-W{n:02}", n, 2024, n != 4) for n in range(1, 9)]
    p = spark.createDataFrame(weeks, "period string, period_no int, term int, complete boolean")
    rows = [(w, "7", float(n), "t" if n != 7 else None, 1.0) for w, n, *_ in weeks] + [(w, i, float(n), "t", t) for w, n, *_ in weeks[7:] for i, t in (("12", 5.0), ("9", 5.0))]
    c = spark.createDataFrame(rows, "period string, id string, value double, topic string, tie_value double")
    spec = periods.MetricSpec("m", min_history=3, tie_rank=1, requires_topic=True)
    got = {r.period_no: r for r in periods.compute_facts({"m": c}, [spec], p).collect()}
    assert [got[n].withheld for n in range(1, 9)] == ["not_comparable"] * 3 + ["no_observation", None, None, "no_topic", None]
    assert (got[8].cited, got[8].base_n, got[8].percentile, got[8].base_from, got[8].base_to, got[8].rank) == ("9", 6, 1.0, 1, 7, 1)
    assert (got[5].base_n, got[4].base_n, got[1].base_n) == (3, 3, 0)


def test_lead_positions_and_single_subjects(spark):
    from tallyspan.operators import linking

    rows = [(1, "  ", 0, 1, "a", False), (1, "law", 1, 5, "a", True), (1, "paper", 1, 2, "b", True), (2, None, 0, 1, None, None), (3, "x", 0, 1, "a", True), (3, "y", 1, 0, "a", True), (4, "z", 0, 0, "a", False), (4, "z", 0, 0, "b", False)]
    df = spark.createDataFrame(rows, "item int, title string, rank int, id int, subject string, minor boolean")
    assert sorted(tuple(r) for r in linking.lead_positions(df, "item", "title", ["rank", "id"]).collect()) == [(1, "paper"), (3, "x"), (4, "z")]
    assert sorted(tuple(r) for r in linking.single_subject(df, "item", "subject", "minor").collect()) == [(1, "a"), (3, "a")]


def test_nested_speakers_split_their_unit(spark):
    from tallyspan.operators import units

    def row(unit, pos, kind, speaker=None, name=None, text=None, q=False):
        return (unit, pos, kind, speaker, name, text, "a", q)

    rows = [
        row("u", 0, "t", text="Dear all"), row("u", 1, "c", text="the floor goes to Bo"), row("u", 2, "m", "b", "Bo"), row("u", 3, "t", text="Dear house, I say"),
        row("u", 4, "m", "c", "Cy"), row("u", 5, "t", text="Dear, not granted"),
        row("u", 6, "c", text="now Cy"), row("u", 7, "m", "c", "Cy", q=True), row("u", 8, "t", text="Dear, asked"),
        row("u", 9, "c", text="Cy again"), row("u", 10, "m", "c", "Cy"), row("u", 11, "t", text="no greeting"),
        row("u", 12, "c", text="Bo goes on"), row("u", 13, "m", "b", "Bo"), row("u", 14, "t", text="Dear, as before"),
        row("u", 15, "c", text="Al"), row("u", 16, "m", "a", "Al"), row("u", 17, "t", text="Dear, back"),
        row("v", 0, "m", "b", "Bo"), row("v", 1, "t", text="Dear"),
    ]
    df = spark.createDataFrame(rows, "unit string, pos int, kind string, speaker string, name string, text string, owner string, q boolean")
    got = units.split_nested(df, "unit", ["pos"], F.col("kind") == "m", F.col("kind") == "c", "speaker", "name", "text", "owner", F.col("q"), "^Dear").collect()
    assert len(got) == len(rows)
    at = {(r.unit, r.pos): r for r in got}
    assert [at["u", p].ruling for p in (2, 4, 7, 10, 13, 16)] == ["split", "not_granted", "question", "no_salutation", "same_speaker", "split"] and at["v", 0].ruling == "not_granted"
    assert [at["u", p].part for p in (0, 1, 2, 15, 16, 17)] == ["u", "u", "u:1", "u:1", "u:2", "u:2"] and at["u", 14].part_owner == "b"
    assert units.split_nested(df.limit(0), "unit", ["pos"], F.col("kind") == "m", F.col("kind") == "c", "speaker", "name", "text", "owner", F.col("q"), "^Dear").count() == 0
