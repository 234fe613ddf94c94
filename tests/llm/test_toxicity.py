import random

import pytest
import zstandard

from tallyspan.llm import toxicity


def world(n, seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    bad = ["vilewort", "grimscum", "nastyfool", "moron"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(3, 150))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = world(900, 1)
    docs = spark.createDataFrame([(i, t, "s", 0.5) for i, t, _ in rows] + [(5000, None, "s", 0.1), (5001, "", "s", 0.1), (5002, "clean " * 60000, "s", 0.1), (None, "x", "s", 0.1), (None, "x", "s", 0.1)], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 3] + [(5000, 1, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert all(w in model.toxic for w in (b"vilewort", b"grimscum", b"nastyfool"))
    got = {}
    for r in toxicity.score(docs, model).collect():
        assert 0 <= r.score <= 1
        got.setdefault(r.doc_id, []).append(r.score)
    held = [(i, y) for i, _, y in rows if i % 3 == 0]
    assert sum((got[i][0] >= 0.5) == bool(y) for i, y in held) / len(held) > 0.98
    assert max(*got[5000], *got[5001], *got[5002]) < 0.5 and len(got[None]) == 2
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s < 0.5 for x in got.values() for s in x)


def brute_length(content, window):
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress(window))


def test_gain_is_the_difference_of_compressed_lengths():
    plain, toxic = b" the quiet house by the river ", b" vilewort  grimscum "
    model = toxicity.CompressionModel(plain, toxic)
    text = "The quiet house, by the vilewort of the river! " * 3 + "and nothing else"
    own = text.lower().translate(str.maketrans("", "", ",!")).split()
    cut = [" " + " ".join(own[i : i + 8]) + " " for i in range(0, len(own), 8)]
    want = [brute_length(plain, w.encode()) - brute_length(plain + toxic, w.encode()) for w in cut]
    assert model.gains(toxicity.words(text)).tolist() == want and max(want) >= 3
    assert not len(model.gains([]))


def test_marked_grams_and_stretches(spark):
    rows = world(600, 3)
    sample = spark.createDataFrame([(t, y, i % 2) for i, t, y in rows], "text string, toxic int, fold int")
    sizes = {f: tuple(sum(y == k and i % 2 == f for i, _, y in rows) for k in (0, 1)) for f in (0, 1)}
    marked, half = toxicity.marked_grams(toxicity.gram_counts(sample), sizes, [-1, 0])
    assert b" vilew" in half
    assert b" vilew" in marked and toxicity.stretches([b"vilewort", b"zzzz"], marked) == b" vilewort "
    seen = {(r.gram, r.fold): (r.a, r.b) for r in toxicity.gram_counts(sample).collect()}
    assert seen[b" vilew", 1] == (sum("vilewort" in t for i, t, _ in rows if i % 2), 0)


def test_near_copies_are_one_text_of_the_sample(spark):
    body = " ".join(f"word{n}" for n in range(200))
    docs = spark.createDataFrame([(n, f"{body} tail{n}") for n in range(50)] + [(99, "quite another text of its own")], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(50)] + [(99, 0)], "doc_id long, toxic int")
    assert toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 1000, 1000).count() <= 7


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0)]])
def test_one_kind_of_label_gives_its_share(spark, labels):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [float(bool(labels and labels[0][2]))]
    assert toxicity.score(docs.limit(0), model).count() == 0
