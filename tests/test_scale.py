"""Work that must not grow faster than its input."""

import datetime
import random
import re

from pyspark.sql import functions as F

from tallyspan.operators import diffs, intervals, linking
from tallyspan.plans import joins


def most_rows(df):
    """The most rows that any operator of the run made."""
    qe = df._jdf.queryExecution()
    df._jdf.collectToPython()
    todo, most = [qe.executedPlan()], 0
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        metric = plan.metrics().get("numOutputRows")
        most = max(most, metric.get().value() if metric.isDefined() else 0)
        children = plan.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def saved(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_a_band_with_many_suppliers_makes_no_pairs(spark, tmp_path):
    customers = [(i, 1, 10.0) for i in range(300)] + [(300, 2, 10.0), (301, 2, 10.0), (302, 2, 900.0), (302, 1, 10.0), (303, None, 10.0), (304, 3, 10.0)]
    suppliers = [(i, 1, 20.0) for i in range(300)] + [(300, 2, 20.0), (300, 2, 30.0), (None, 3, 20.0)]
    at = saved(
        spark,
        tmp_path,
        customer=(customers, "c_custkey long, c_nationkey int, c_acctbal double"),
        supplier=(suppliers, "s_suppkey long, s_nationkey int, s_acctbal double"),
        orders=([(1, 0, "F"), (2, 1, "F"), (3, 301, "F"), (4, 304, "O")], "o_orderkey long, o_custkey long, o_orderstatus string"),
        lineitem=([(1, 7), (1, 7), (2, 7), (2, 8), (3, 9), (4, 9)], "l_orderkey long, l_suppkey long"),
    )
    df = joins.s18_lookup_cascade(spark, at)
    got = {r.c_custkey: (r.s_suppkey, r.source) for r in df.collect()}
    told = {k: v for k, v in got.items() if v[0] is not None}
    assert told == {0: (7, "order"), 300: (300, "nation"), 301: (300, "nation")} and len(got) == 305
    assert most_rows(joins.s18_lookup_cascade(spark, at)) < 1000


def test_extremes_tell_one_value_from_several(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 3), (2, 4), (2, 9), (3, None)], "k int, v int")
    assert sorted(map(tuple, linking.extremes(df, ["k"], "v").collect()), key=repr) == [(1, 5), (2, 3), (2, 9), (3, None)]


def test_inputs_are_dealt_to_as_many_tasks_as_any_shuffle(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(100)], "k int, v int")
    seen = []

    def run(rows):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows.groupBy("v").agg(F.count(F.lit(1)).alias("n"))

    got = diffs.order_independent({"q": (run, df, "k")}).collect()
    assert [tuple(r) for r in got] == [("q", True, 5)]
    assert len(seen) == 3 and not any(re.search(r"RepartitionByExpression.*, \d+$", p.splitlines()[0]) for p in seen)


def test_a_label_proved_by_many_intervals_is_one_row_a_fact(spark):
    rng = random.Random(3)
    day = lambda n: None if n is None else datetime.date(2020, 1, 1) + datetime.timedelta(n)
    spans = [(rng.choice((1, 2, 3, None)), rng.choice(("a", "b", "c", None)), a := rng.choice((None, *range(60))), rng.choice((None, *range((a or 0) - 2, (a or 0) + 9)))) for _ in range(60)]
    spans += [(9, "a", 0, 5), (9, "b", 5, 9), (9, "b", 7, None), (8, "a", 0, None), (8, None, 0, 9)]
    facts = [(i, k, n) for i, (k, n) in enumerate((k, n) for k in (1, 2, 3, 7, 8, 9, None) for n in (None, *range(-1, 70)))] + [(0, 9, 6)]
    h = spark.createDataFrame([(k, v, day(a), day(b)) for k, v, a, b in spans], "k int, label string, valid_from date, valid_until date")
    f = spark.createDataFrame([(i, k, day(n)) for i, k, n in facts], "i int, k int, day date").repartition(3)

    def want(k, n):
        on = {v for s, v, a, b in spans if None not in (k, n, v, a) and s == k and a <= n and (b is None or n < b)}
        return on.pop() if len(on) == 1 else None

    out = intervals.proved_label(f, h, "k", "day", "label")
    assert sorted(((r.i, r.k, r.day, r.label) for r in out.collect()), key=repr) == sorted(((i, k, day(n), want(k, n)) for i, k, n in facts), key=repr)
    many = spark.createDataFrame([(1, "a", day(0), day(100))] * 200, h.schema)
    hot = spark.createDataFrame([(i, 1, day(i % 100)) for i in range(200)], f.schema)
    assert most_rows(intervals.proved_label(hot, many, "k", "day", "label")) < 1000
