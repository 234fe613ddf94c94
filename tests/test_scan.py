import random

import pytest

from tallyspan.operators import floor
from tallyspan.operators.scan import Machine, scan

RUNS = Machine("0", {("0", "f"): ("1", ()), ("1", "f"): ("2", ("stopped",)), ("1", "ok"): ("0", ()), ("0", "ok"): ("0", ("ok",))})


def brute(rows, machine):
    out, state, counts, unit = [], None, None, object()
    for u, o, e in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        if u != unit:
            state, counts, unit = machine.start, dict.fromkeys(machine.counters, 0), u
        before = state
        state, raised = machine.rules.get((state, e), (state, ()))
        for c in raised:
            counts[c] += 1
        out.append((u, o, e, before, *(counts[c] for c in machine.counters)))
    return out


@pytest.mark.parametrize("block,one_task", [(10_000, 50_000), (3, 50_000), (10, 5)])
def test_scan_equals_a_loop_over_units_that_cross_blocks(spark, block, one_task):
    rng = random.Random(block)
    hot = [(1, i, rng.choice(["f", "ok", "x", None])) for i in range(90)]
    rows = hot + [(u, i, rng.choice(["f", "ok"])) for u in (2, 3, None) for i in range(7)] + [(u, 0, "f") for u in range(10, 25)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "u int, o int, e string").repartition(4)
    got = scan(df, "u", ["o"], {"state": ("e", RUNS)}, block, one_task)
    assert got.columns == ["u", "o", "e", "state", "ok", "stopped"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, RUNS), key=repr)
    assert scan(df.limit(0), "u", ["o"], {"state": ("e", RUNS)}).count() == 0


def rulings(spark, events, **options):
    rows = [("u", i, e[0], e[1] if len(e) > 1 else None, e[2] if len(e) > 2 else None, "ab") for i, e in enumerate(events)]
    df = spark.createDataFrame(rows, "u string, o int, e string, s string, names array<string>, t string")
    f = floor.followed(df, "u", ["o"], "e", **options)
    r = floor.turn_rulings(f, "u", ["o"], "e", "s", "names")
    return [(x.s, x.ruling) for x in r.orderBy("marker").collect()], floor.segments(f, "u", "e", "s", "t", r).collect()


def test_rulings_of_turns(spark):
    got, _ = rulings(
        spark,
        [
            ("turn", "A"),  # nobody asked
            ("invite",), ("turn", "B"), ("turn", "B"),  # the chair's floor serves once
            ("offer",), ("turn", "A"),  # not answered yet
            ("consent",), ("turn", "A"), ("resume",), ("own",), ("turn", "A"), ("turn", "B"),
            ("offer", None, ["A", "C"]), ("consent",), ("turn", "B"), ("turn", "A"), ("turn", "A"), ("turn", "C"), ("turn", "B"),
            ("refusal",), ("turn", "C"), ("offer", None, ["C"]), ("turn", "C"), ("consent",), ("turn", "C"),
            ("refusal",), ("renewal",), ("turn", "C"),
        ],
        block=8, one_task=3,
    )
    assert got == [
        ("A", "unasked"), ("B", "chair_floor"), ("B", "unasked"), ("A", "unanswered"), ("A", "authorized"), ("A", "continued"), ("B", "spent"),
        ("B", "recipient_mismatch"), ("A", "authorized"), ("A", "continued"), ("C", "authorized"), ("B", "spent"),
        ("C", "refused"), ("C", "refused"), ("C", "authorized"), ("C", "authorized"),
    ]


def test_words_go_to_their_voice_and_are_conserved(spark):
    events = [("text",), ("chair",), ("lost",), ("text",), ("text",), ("turn", "A"), ("text",), ("own",), ("resume",), ("text",)]
    _, got = rulings(spark, events)
    assert {(r.marker, r.voice): (r.n_rows, r.ruling) for r in got} == {(0, "holder"): (1, None), (0, "chair"): (1, None), (1, "unattributed"): (2, None), (2, "other"): (1, "unasked"), (2, "holder"): (1, None), (3, "holder"): (1, None)}
    assert sum(r.n_chars for r in got) == 2 * sum(e[0] not in floor.MARKERS for e in events)
