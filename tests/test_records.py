from tallyspan.operators import lookups, questions, results


def test_questions_take_the_first_free_turn(spark):
    rows = [  # unit, pos, asker, announced, id
        ("u", 1, "A", False, "t0"), ("u", 2, "A", True, "q1"), ("u", 3, "A", True, "q2"), ("u", 4, "B", True, "q3"), ("u", 5, "A", False, "t1"),
        ("u", 6, "A", False, "t2"), ("u", 7, "A", False, "t3"), ("u", 8, "A", True, "q4"), ("v", 9, "A", False, "t4"), ("v", 1, "C", True, "q5"), ("v", 2, None, True, "q6"), ("v", 3, None, False, "t6"),
    ]
    df = spark.createDataFrame(rows, "unit string, pos int, asker string, announced boolean, id string").repartition(3)
    got = questions.put_questions(df, "unit", ["pos"], "asker", "announced", "id")
    assert {r.id: r.turn for r in got.collect()} == {"q1": "t1", "q2": "t2", "q3": None, "q4": None, "q5": None, "q6": "t6"}
    people = spark.createDataFrame([("B", 7), ("B", 7), ("C", 1), ("C", 2)], "name string, person int")
    named = questions.named_askers(got, "id", "turn", "asker", people, "name", "person").collect()
    assert {r.id: (r.person, r.source) for r in named} == {"q1": (None, "turn"), "q2": (None, "turn"), "q3": (7, "candidate"), "q4": (None, "name"), "q5": (None, "name"), "q6": (None, "turn")}
    assert questions.put_questions(df.limit(0), "unit", ["pos"], "asker", "announced", "id").count() == 0


def test_official_results_by_tolerance_documents_and_uniqueness(spark):
    tally = r"Total: Yes (\d+) No (\d+)"
    text = "\n\n".join(
        [
            "Vote on 1/1\nTotal: Yes 103 No 50\nMotion accepted",
            "Vote on 1/2\nTotal: Yes 104 No 50\nMotion rejected",  # four off
            "Total: Yes 70 No 7\naccepted Total: Yes 71 No 7\nrejected",
            "Vote on 9/9\nTotal: Yes 80 No 8\naccepted",
            "Total: Yes 90 No 9\nis not accepted",
            "Vote on 1/6 and 1/7\nTotal: Yes 60 No 6\naccepted",
            "Vote on 1/8\nTotal: Yes 30 No 3\naccepted",
            "Vote on 1/8\nTotal: Yes 33 No 3\nrejected",
            "Total: Yes 20 No 2\naccepted",
            "Total: Yes 20 No 2\nrejected",
            "Total: Yes 11 No 1\n5/5 accepted",
        ]
    )
    pages = spark.createDataFrame([("p", text), ("q", None), ("r", "")], "page string, text string")
    found = results.tallies(pages, "page", "text", tally, r"\d+/\d+")
    assert found.count() == 12
    votes = [
        ("near", "p", 100, 50, ["1/1"], "found", "accepted"),
        ("off", "p", 100, 50, ["1/2"], "absent", None),
        ("exact", "p", 70, 7, None, "found", "accepted"),
        ("second", "p", 71, 7, [], "found", "rejected"),
        ("foreign", "p", 80, 8, ["1/4"], "absent", None),
        ("negated", "p", 90, 9, ["1/5"], "found", "negated"),
        ("partial", "p", 60, 6, ["1/6"], "found", "accepted"),  # not all documents are its own, but its counts are equal
        ("provisional", "p", 61, 6, ["1/6"], "absent", None),
        ("several", "p", 33, 3, ["1/8"], "found", "rejected"),
        ("several_near", "p", 31, 3, ["1/8"], "absent", None),
        ("twice", "p", 20, 2, ["1/9"], "ambiguous", None),
        ("named", "p", 11, 1, ["1/3"], "found", "foreign"),
        ("nothing", "q", 1, 1, ["1/1"], "absent", None),
    ]
    df = spark.createDataFrame([v[:5] for v in votes], "vote string, page string, yes long, no long, docs array<string>")
    got = results.official(df, "vote", "page", "yes", "no", "docs", found, {"accepted": "accepted", "rejected": "rejected"}, r"\bnot\s+(?:accepted|rejected)")
    assert {r.vote: (r.state, r.outcome) for r in got.collect()} == {v[0]: v[5:] for v in votes}


def test_lists_end_by_their_cursors(spark):
    rows = [
        ("whole", 0, None, "a", 3, [1, 2]), ("whole", 1, "a", None, 3, [3]),
        ("held", 0, None, "a", 2, [1, 2]), ("held", 1, "a", "b", 2, [9]),
        ("repeat", 0, None, "a", 9, [1]), ("repeat", 1, "a", "a", 9, [2]), ("repeat", 2, "a", "b", 9, [3]),
        ("gap", 0, None, "a", 4, [1]), ("gap", 2, "b", None, 4, [3]),
        ("empty", 0, None, "a", 2, [1]), ("empty", 1, "a", "b", 2, []),
        ("none", 0, None, None, None, [1]), ("twice", 0, None, "a", 2, [1]), ("twice", 1, "a", None, 2, [1]), ("over", 0, None, None, 1, [1, 2]), ("cut", 0, None, "a", 5, [1]),
    ]
    df = spark.createDataFrame(rows, "s string, page int, used string, next string, total long, items array<int>").repartition(3)
    got = {r.s: (r.n_pages, r.n_items, r.ended, r.state) for r in lookups.paged_lists(df, "s", "page", "used", "next", "total", "items").collect()}
    assert got == {
        "whole": (2, 3, "no_cursor", "complete"), "held": (1, 2, "all_held", "complete"), "repeat": (2, 2, "repeated_cursor", "short"), "gap": (1, 1, "missing_page", "short"),
        "empty": (2, 1, "empty_page", "short"), "none": (1, 1, "no_cursor", "unannounced"), "twice": (2, 1, "no_cursor", "short"), "over": (1, 2, "no_cursor", "over"), "cut": (1, 1, "open", "short"),
    }


def test_lookups_behind_failures_in_a_row_are_not_asked(spark):
    log = [("u", i, o) for i, o in enumerate(["hit", "failed", "miss", "failed", "failed", "failed", "hit", "failed"])] + [("v", 0, "failed"), ("v", 1, "failed"), ("v", 2, "hit")]
    df = spark.createDataFrame(log, "u string, i int, o string")
    got = sorted((r.u, r.i, r.state, r.n_asked) for r in lookups.stop_after(df, "u", ["i"], "o", 3).collect())
    assert [g[2] for g in got] == ["hit", "failed", "miss", "failed", "failed", "failed", "not_asked", "not_asked", "failed", "failed", "hit"]
    assert got[7][3] == 6 and got[10][3] == 3
