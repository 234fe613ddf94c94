import pytest
from pyspark.sql import functions as F

from tallyspan.operators import choices, periods, writers


def test_best_source_counts_and_conflicts_stay(spark):
    rows = [("a", "b", "x"), ("a", "c", "y"), ("b", "a", None), ("b", "c", "y"), ("c", "a", "x"), ("c", "a", "y"), ("c", "b", "x"), ("d", "z", "x"), ("e", "a", "x"), ("e", "a", "x")]
    df = spark.createDataFrame(rows, "u string, s string, v string").repartition(3)
    got = {r.u: (r.v, r.s, r.state) for r in choices.preferred_evidence(df, "u", "s", "v", ["a", "b", "c"]).collect()}
    assert got == {"a": ("x", "b", "settled"), "b": ("y", "c", "settled"), "c": (None, "a", "conflict"), "e": ("x", "a", "settled")}


def test_features_are_blocked_by_chains_circles_and_unknown_needs(spark):
    names = ["a", "b", "c", "d", "e", "f", "g", "h", *(f"n{i}" for i in range(15))]
    needs = [("b", "a"), ("c", "b"), ("d", "ghost"), ("e", "f"), ("f", "e"), ("g", "h"), ("h", "g"), ("h", "a"), ("x", "a"), ("n0", "a"), *((f"n{i}", f"n{i - 1}") for i in range(1, 15))]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    got = choices.feature_states(df, spark.createDataFrame(needs, "k string, need string"), spark.createDataFrame([("a",), ("zz",)], "k string"), "k", "need")
    state = {r.k: (r.state, r.round) for r in got.collect()}
    want = {"a": ("vetoed", 0), "b": ("blocked", 1), "c": ("blocked", 2), "d": ("blocked", 0), "e": ("runs", None), "f": ("runs", None), "g": ("blocked", 2), "h": ("blocked", 1)}
    assert state == want | {f"n{i}": ("blocked", i + 1) for i in range(15)}
    none = choices.feature_states(df, spark.createDataFrame(needs[:1], "k string, need string"), df.limit(0), "k", "need")
    assert {r.state for r in none.collect()} == {"runs"}


def test_groups_and_pages_that_differ(spark):
    a = spark.createDataFrame([("p", 1, "x"), ("p", 2, "y"), ("q", 3, None), ("q", 3, None)], "k string, i int, v string")
    b = spark.createDataFrame([("q", 3, None), ("p", 2, "z"), ("r", 4, "n"), ("q", 3, None), ("p", 1, "x")], "k string, i int, v string")
    assert sorted(map(tuple, choices.differing_groups(a, b, "k").collect())) == [("p", 2, 2), ("r", 0, 1)]
    got = choices.page_changes(a.distinct(), b.distinct(), "k", "i", ["v"]).collect()
    assert sorted(map(tuple, got)) == [("p", 2, "changed", "v"), ("r", 4, "gained", None)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("Frage 3 der Abgeordneten Dr. Ada Test (ABC):", ("Ada Test", "ABC")),
        ("Frage 3 des Kollegen von Beispiel, Gruppe B:", ("von Beispiel", "Gruppe B")),
        ("Frage 1 des Herrn A: nein. Frage 2 der Frau Prof. Dr. B-C :", ("B-C", None)),
        ("Frage 1 von Ihnen:", (None, None)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_announced_askers(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(choices.announced_asker(F.col("t")).alias("x")).first().x
    assert (r.name, r.grp) == want


def test_topics(spark):
    rows = [("Beratung: Großer Haushalt", None, "heading"), ("Beratung: ZP", ["", "Antrag", "Neues Gesetz gegen Betrug"], "title"), ("Beratung: ZP", ["Antrag"], "short_heading"), ("Beratung:", [None, "Antrag"], "short_title"), (None, None, "none"), (None, [], "none")]
    df = spark.createDataFrame(rows, "h string, t array<string>, want string")
    got = df.select("want", choices.topic_choice(F.col("h"), F.coalesce("t", F.array().cast("array<string>")), ["^Beratung:"]).alias("x")).collect()
    assert [r.x.origin for r in got] == [r.want for r in got]


def test_sightings_settle(spark):
    rows = [("k", 1, None, "b", 5), ("k", 2, "t", None, None), ("k", 3, "u", "c", None), (None, 4, "v", "v", 1), ("m", 9, None, None, 2)]
    df = spark.createDataFrame(rows, "k string, o int, a string, b string, c int").repartition(3)
    got = {r.k: (r.a, r.b, r.c) for r in writers.settled(df, "k", ["o"], ("a",), ("b",), ("c",)).collect()}
    assert got == {"k": ("t", "c", None), "m": (None, None, 2)}


def test_units_of_nested_reports(spark):
    schema = "s string, items array<struct<heading:string,units:array<struct<sequence:int,given:string,x:int>>>>"
    rows = [("18/1", [("h", [(None, " ", 1), (7, "R7", 2)]), ("i", [])]), ("18/2", [("h", [(None, None, 3)])]), ("18/3", None)]
    got = writers.spoken_units(spark.createDataFrame(rows, schema), "s", "items", "units", "sequence", "given").collect()
    assert sorted(map(tuple, got)) == [("18/1", 1, 1, "18/1#item-1-1", 1), ("18/1", 1, 7, "18/1#R7", 2), ("18/2", 1, 1, "18/2#item-1-1", 3)]
    c = spark.createDataFrame([("q", 1, " A ", "G"), ("i", 2, "B", "G"), ("q", None, "C", "G"), (None, 4, "", "G")], "kind string, no int, name string, grp string")
    out = [(r.refused, r.speaker_key, r.speaker_name, r.speaker_group) for r in writers.contribution_speakers(c, "kind", ("q", "i"), "no", "name", "grp", ("i",)).collect()]
    assert out == [(False, "no:1", "A", "G"), (False, "no:2", "B", None), (False, None, "C", None), (True, "no:4", None, "G")]


def test_ranked_answers_have_a_state_for_every_owner(spark):
    owners = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", None)], "o string, asked boolean")
    answers = spark.createDataFrame([("a", "y", 2), ("a", "x", 3), ("a", "y", 9), ("b", None, 1), ("z", "x", 1)], "o string, v string, p int")
    ranked, states = writers.ranked_answers(owners, answers, "o", "v", ["p"], F.col("asked"))
    assert sorted(map(tuple, ranked.collect())) == [("a", "x", 2), ("a", "y", 1)]
    assert sorted(map(tuple, states.collect())) == [("a", "answered", 2), ("b", "none", 0), ("c", "not_asked", 0), ("d", "not_asked", 0)]


def test_all_metrics_together_are_each_by_itself(spark):
    months = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "period string")
    rows = spark.createDataFrame([("m1", "10", "g", 1, 5.0, "t"), ("m1", "9", "g", 1, 1.0, "s"), ("m1", "8", "h", 2, 1.0, None), ("m2", "7", "h", None, 1.0, "t")], "period string, id string, group_id string, value int, tie_value double, topic string")
    specs = [periods.MetricSpec("a", tie_rank=1), periods.MetricSpec("b", "min", tie_rank=2), periods.MetricSpec("c", aggregation="grouped_extreme", tie_rank=3), periods.MetricSpec("d", aggregation="count", tie_rank=4)]
    together = {(r.metric_id, r.period): (r.value, r.cited, r.topic, r.n) for r in periods.observe_all({s.metric_id: rows for s in specs}, specs, months).collect()}
    alone = {(s.metric_id, r.period): (r.value, r.cited, r.topic, r.n) for s in specs for r in periods.observe(rows, s, months).collect()}
    assert together == alone and together["c", "m1"][:2] == (2.0, "g") and together["d", "m3"][0] == 0 and together["a", "m2"][0] is None


def test_titles_meet_by_what_is_rare_and_none_is_lost(spark):
    import random

    from tallyspan.functions.scalars import titles_match
    from tallyspan.operators import linking

    rng = random.Random(7)
    words = ["haushalt", "steuer", "gesetz", "zur", "der", "und", "bericht", "verkehr", "a", "xy", "änderung", "gesetzentwurf"]
    say = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
    heads = spark.createDataFrame([(rng.randint(1, 3), say()) for _ in range(60)] + [(1, "steuergesetze"), (1, "a"), (2, "xy")], "s int, h string").distinct()
    titles = spark.createDataFrame([(rng.randint(1, 4), say()) for _ in range(60)] + [(1, "uergesetz"), (1, "xy a"), (2, "y")], "s int, t string").distinct()
    want = heads.join(titles, "s").filter(titles_match(F.col("h"), F.col("t"))).select("s", "h", "t")
    got = linking.matching_titles(heads, titles, "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
