import random

import corpus_pipeline
from tallyspan.llm import decontam, packing, pii, simhash, toxicity
from tests.llm.test_pii import brute_spans
from tests.llm.test_simhash import brute_components, brute_fp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def world():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bad = ["vilewort", "grimscum", "nastyfool"]
    docs, labels = [], []
    for i in range(300):
        t = say(rng.randint(5, 120))
        if i % 6 == 0:
            words = t.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
            t = " ".join(words)
        labels.append((i, 1, int(i % 6 == 0)))
        docs.append([i, t])
    bench = [(n, say(20)) for n in range(4)]
    docs += [[300 + n, say(10) + " " + t.upper() + " " + say(10)] for n, t in bench]
    docs += [[310, docs[1][1]], [311, docs[1][1]], [312, ""], [313, None], [314, "write to ann.b@mail.example.org or +1 (222) 333-4444 now " + say(9)], [315, say(4000)]]
    return [(i, t, "en", "s", len(t or "")) for i, t in docs], labels, bench


def test_run_equals_brute_force_stage_by_stage(spark, tmp_path):
    docs, labels, bench = world()
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = {r[0]: r[1] for r in docs}

    kept = corpus_pipeline.toxicity_filter(spark, at, str(tmp_path))
    assert kept.columns == at.columns
    got = {r.doc_id for r in kept.collect()}
    assert got == {i for i in rows if not (i < 300 and i % 6 == 0)}
    rows = {i: rows[i] for i in got}

    kept = corpus_pipeline.near_dedup(spark, kept, str(tmp_path))
    comp = brute_components({i: brute_fp(t) for i, t in rows.items()})
    rows = {i: rows[i] for i in rows if comp[i] == i}
    assert {r.doc_id for r in kept.collect()} == set(rows)

    kept = corpus_pipeline.decontamination(spark, kept, str(tmp_path))
    matcher = decontam.Matcher(bench)
    rows = {i: t for i, t in rows.items() if not any(t and x in decontam.fold_text(t) for _, x in bench)}
    assert all(next(matcher.find(t), None) is None for t in rows.values())
    assert {r.doc_id for r in kept.collect()} == set(rows)

    kept = corpus_pipeline.redaction(spark, kept, str(tmp_path))
    clean = {r.doc_id: r for r in kept.collect()}
    assert set(clean) == set(rows) and kept.columns == at.columns
    for i, t in rows.items():
        if brute_spans(t):
            assert "@" not in clean[i].text and "[EMAIL]" in clean[i].text and "[PHONE]" in clean[i].text
        else:
            assert clean[i].text == t
        assert clean[i].n_chars == (None if clean[i].text is None else len(clean[i].text))

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encode = packing.encoder()
    expect = {(i, p, s, n) for i, r in clean.items() for p, (s, n) in enumerate(packing.cut(len(encode(r.text or "")) + 1))}
    assert {(r.doc_id, r.piece, r.start, r.length) for r in out} == expect


def test_stages_stand_in_their_order_and_call_their_operators(monkeypatch, spark):
    """Each stage hands its documents to its operator and gives back what that gives."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii_redaction", "best_fit_packing"]
    docs, called = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA), []
    for module, name in ((toxicity, "drop_toxic"), (simhash, "keep_first"), (decontam, "drop_contaminated"), (pii, "redact"), (packing, "pack")):
        monkeypatch.setattr(module, name, lambda d, *_, n=name, **__: called.append((n, d is docs)) or d)
    monkeypatch.setattr(toxicity, "train", lambda *_: None)
    monkeypatch.setattr(pii, "train", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "nowhere").count() == 1
    assert called == [(n, True) for n in ("drop_toxic", "keep_first", "drop_contaminated", "redact", "pack")]


def test_empty_tables_and_odd_rows_pass_every_stage(spark, tmp_path):
    """Empty tables give an empty result; a null id, a null text, an empty and a very long one go through."""
    none = spark.createDataFrame([], SCHEMA)
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0), (3, "long word " * 40_000, "en", "s", 400_000), (None, "no id", "en", "s", 5)], SCHEMA)
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns, name
    got = docs.collect()
    assert {r.doc_id for r in got} == {1, 3, None}  # the null and the empty text are one group
    assert sum(r.length for r in packing.pack(docs, with_ids=False).collect()) == sum(len(packing.encoder()(r.text or "")) + 1 for r in got)
