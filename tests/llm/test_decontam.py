import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspan.llm import decontam


def brute(pattern, text):
    """(distance, end) of the best semi-global match, the first of equals."""
    prev = list(range(len(pattern) + 1))
    best = (len(pattern) + 1, 0)
    for j, c in enumerate(text):
        cur = [0]
        for i, p in enumerate(pattern):
            cur.append(min(prev[i] + (p != c), prev[i + 1] + 1, cur[i] + 1))
        prev = cur
        if cur[-1] < best[0]:
            best = (cur[-1], j + 1)
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_myers_equals_dynamic_programming(pattern, text):
    d, end = brute(pattern, text)
    assert decontam.myers(pattern, text, len(pattern)) == ((d, end) if text else None)
    assert decontam.myers(pattern, text, d - 1) is None


def test_matcher_finds_all_within_budget_and_none_beyond():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(12)]
    m = decontam.Matcher(items)
    for _ in range(60):
        i, item = rng.choice(items)
        s = list(item)
        for _ in range(rng.randint(0, 16)):
            at = rng.randrange(len(s))
            what = rng.randint(0, 2)
            s[at : at + (what != 1)] = [] if what == 0 else ["Z"]
        text = "".join([word() + " "] * 9) + "".join(s) + " " + word()
        flat = decontam.fold_text(text)
        expect = {n: brute(t, flat)[0] for n, t in items if brute(t, flat)[0] <= int(len(t) * decontam.RATE)}
        got = {}
        for n, d, a, b in m.find(text):
            got[n] = min(d, got.get(n, d))
            assert brute(dict(items)[n], flat[a:b])[0] == d
        assert got == expect


def test_frame_edges(spark):
    items = spark.createDataFrame([(1, "Alpha beta gamma delta epsilon"), (2, None), (3, "  "), (1, "Alpha beta gamma delta epsilon")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "xx alpha\tBETA gamma delta epsilon yy", "s"), (2, None, "s"), (3, "", None), (None, "alpha beta gamma delta epsilom", "t"), (5, "clean " * 30000, "t")],
        "doc_id long, text string, item_id string",
    )
    got = decontam.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.distance, r.start, r.end) for r in got} == {(1, 1, 0, 3, 33), (None, 1, 1, 0, 29)}  # the first of equal ends
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    named = items.selectExpr("concat('item-', item_id) as item_id", "text")
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, named).collect()} == {(1, "item-1"), (None, "item-1")}
    small = decontam.contaminated(docs, items, block_chars=20)
    assert {(r.doc_id, r.item_id) for r in small.collect()} == {(1, 1), (None, 1)}


def test_case_of_all_scripts_and_kinds_of_space_fold_one_to_one():
    m = decontam.Matcher([(1, "Ça été très ünlöblich, mañana vençãΣ der İstanbul Straße")])
    for t in ("xx ÇA ÉTÉ TRÈS ÜNLÖBLICH, MAÑANA VENÇÃσ DER İSTANBUL STRAßE yy", "ça\u00a0été\ntrès\tünlöblich, mañana vençãσ der İstanbul straße"):
        assert len(decontam.fold_text(t)) == len(t)
        assert [(i, d <= 1) for i, d, *_ in m.find(t)] == [(1, True)]
