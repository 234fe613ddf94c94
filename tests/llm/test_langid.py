import math
import random

from tallyspan.llm import langid

ALPHABETS = {"aa": ["ba", "di", "ko", "lu"], "bb": ["sch", "tz", "ung", "ä"], "cc": ["ção", "mente", "lh", "o"]}


def say(lang, rng):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(2, 40)))


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(4)
    rows = [(i, say(lang, rng), lang) for i, lang in enumerate(rng.choice(list(ALPHABETS)) for _ in range(300))]
    learn = spark.createDataFrame([r for r in rows if r[0] % 3] + [(900, None, "aa"), (901, "ba di", None)], "doc_id long, text string, lang string")
    model = langid.train(learn)
    odd = [(1000, None), (1001, ""), (1002, "123 !? \n"), (1003, "BA DI KO"), (1004, "sch" * 60000), (1005, "日本"), (None, "ba di"), (None, "ba di")]
    df = spark.createDataFrame([(i, t, "x", 0.0) for i, t, _ in rows] + [(i, t, "y", None) for i, t in odd], "doc_id long, text string, lang_pred string, score double")
    got = {}
    for r in langid.identify(df, model).collect():
        assert 0 <= r.score <= 1
        got.setdefault(r.doc_id, []).append(r.lang_pred)
    held = [r for r in rows if r[0] % 3 == 0]
    assert sum(got[i][0] == lang for i, _, lang in held) / len(held) > 0.97
    assert [got[i] for i in (1000, 1001, 1002)] == [["und"]] * 3
    assert got[1003] == ["aa"] and got[1004] == ["bb"] and got[1005][0] in ALPHABETS and got[None] == ["aa", "aa"]
    nothing = langid.train(learn.limit(0))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_code_lengths_are_those_of_escape_c():
    """The table's costs against the recursion written out, for a tree of two languages."""
    texts = {"x": b"abracadabra abra", "y": b"zebra zoo"}
    counts = []
    for lang, t in texts.items():
        own: dict = {}
        data = b"   " + t
        for i in range(len(t)):
            g = int.from_bytes(data[i : i + 4], "big")
            own[g] = own.get(g, 0) + 1
        counts += [(lang, g, n) for g, n in own.items()]
    tree = langid.ContextTree(sorted(counts))
    probe = "abrazebq zebé".encode()
    got = tree.bits([probe])[0]
    for k, lang in enumerate(tree.langs):
        grams = [tuple(g.to_bytes(4, "big")) for a, g, _ in counts if a == lang]
        times = [n for a, _, n in counts if a == lang]

        def cost(context, s, grams=grams, times=times):
            seen: dict = {}
            for g, n in zip(grams, times, strict=True):
                if tuple(g[3 - len(context) : 3]) == context:
                    seen[g[3]] = seen.get(g[3], 0) + n
            total, kinds = sum(seen.values()), len(seen)
            if s in seen:
                return math.log2(total + kinds) - math.log2(seen[s])
            escape = math.log2(total + kinds) - math.log2(kinds) if total else 0
            return escape + (cost(context[1:], s) if context else 8)

        data = b"   " + probe
        want = sum(cost(tuple(data[i : i + 3]), data[i + 3]) for i in range(len(probe)))
        assert math.isclose(got[k], want, rel_tol=1e-4)


def test_order_and_bytes_are_the_same_for_many_languages():
    """Costs under a language don't depend on how many others there are."""
    rng = random.Random(6)
    counts = []
    for k in range(20):
        text = "".join(rng.choice([chr(0x400 + k * 8 + j) for j in range(8)] + [" "]) for _ in range(400)).encode()
        own: dict = {}
        for g in langid.windows(text).tolist():
            own[g] = own.get(g, 0) + 1
        counts += [(f"l{k:02}", g, n) for g, n in own.items()]
    probe = "".join(chr(0x400 + 3 * 8 + rng.randrange(8)) for _ in range(50)).encode()
    many = langid.ContextTree(sorted(counts))
    alone = langid.ContextTree(sorted(c for c in counts if c[0] == "l03"))
    cost = many.bits([probe])[0]
    assert math.isclose(cost[3], alone.bits([probe])[0][0], rel_tol=1e-5) and cost.argmin() == 3


def test_sample_takes_different_texts_and_every_language(spark):
    rows = [("aa", "copy of one text")] * 500 + [("aa", f"text {n}") for n in range(40)] + [("bb", "the only one")] * 3 + [("cc", None), (None, "x")]
    taken = langid.sample(spark.createDataFrame(rows, "lang string, text string"), "lang", "text", 10).collect()
    assert {r.lang for r in taken} == {"aa", "bb"} and len({(r.lang, r.text) for r in taken}) == len(taken) < 30
