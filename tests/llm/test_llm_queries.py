"""The registered queries on a small data folder: columns, types, and what brute force can tell."""

import hashlib
import random
import zlib

import pytest

from tallyspan.llm import queries
from tallyspan.llm.common import fold as fold_column
from tests.llm.test_lm import tokens
from tests.llm.test_pii import brute_spans
from tests.llm.test_pipeline import world
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_wrapper import page


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    docs, labels, bench = world()
    rng = random.Random(9)
    lang = {i: rng.choice(["en", "de"]) for i, *_ in docs}
    docs = [(i, (t + " ünd schön" * 3) if t and i < 300 and lang[i] == "de" else t, lang[i] if i != 5 else None, s, n) for i, t, _, s, n in docs]
    docs.append((400, "some MIT License text\nReleased under the MIT License.", "en", "s", 1))
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    save(docs, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    save(labels, "doc_id long, quality int, toxic int", "labels")
    save(bench, "item_id long, text string", "benchmark")
    save([(n, f"https://h.example.org/{n}", page(n, f"<p>Body {n} {'long text ' * n}</p>")) for n in range(10, 20)] + [(99, None, None)], "page_id long, url string, html string", "pages")
    vec = lambda k: [float(k % 7), 1.0, float(k % 3), 0.5]
    save([(k, vec(k), k % 2) for k in range(40)] + [(77, None, 1)], "vec_id long, embedding array<float>, label int", "embeddings")
    return str(at), {r[0]: r[1] for r in docs}


CONTRACT = {
    "op1_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op2_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op3_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op7_benchmark_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op8_embedding_near_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op12_tokenizer_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op13_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
}


@pytest.fixture(scope="module")
def results(spark, folder):
    held = {}

    def get(name):
        if name not in held:
            df = queries.QUERIES[name](spark, folder[0])
            held[name] = (dict(df.dtypes), df.collect())
        return held[name]

    return get


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(results, folder, name):
    types, rows = results(name)
    assert CONTRACT[name].items() <= types.items()
    if "doc_id" in types and name not in ("op2_best_fit_packing", "op7_benchmark_decontamination"):
        assert sorted(r.doc_id for r in rows) == sorted(folder[1])
    for r in rows:
        if "held_out" in types:
            assert r.held_out == (fold(r.doc_id) == (1 if name == "op6_lm_scoring" else 0))
        if "score" in types and name != "op6_lm_scoring":
            assert 0 <= r.score <= 1


def test_digests_equal_brute_force(results, folder):
    texts = folder[1]
    for r in results("op3_pii")[1]:
        base = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.n_email == sum(s.startswith("email:") for s in base) and set(base) <= set(filter(None, r.spans.split(",")))
    fps = {i: brute_fp(t) for i, t in texts.items()}
    comp = brute_components(fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in results("op5_simhash_near_dedup")[1]} == {i: (f"{f:016x}", comp[i]) for i, f in fps.items()}
    total = sum(len(tokens(t)) for i, t in texts.items() if fold(i) != 1)
    for r in results("op6_lm_scoring")[1]:
        assert (r.n_tokens, r.train_tokens) == (len(tokens(texts[r.doc_id])), total)
    assert {(r.doc_id, r.item_id) for r in results("op7_benchmark_decontamination")[1]} == {(300 + n, n) for n in range(4)}
    lic = {r.doc_id: r for r in results("op9_license_scan")[1]}[400]
    assert (lic.n_base, lic.base_labels, lic.labels) == (2, "mit", "mit,mit-notice")
    assert {r.page_id: r.text for r in results("op1_html_extraction")[1]}[99] == ""
    assert all(r.predicted == int(r.score >= 0.5) for r in results("op4_toxicity")[1])
    assert {r.lang_pred for r in results("op10_language_id")[1] if not texts[r.doc_id]} == {"und"}


def test_learning_leaves_held_out_labels_alone(spark, folder, tmp_path):
    """Labels and languages of held-out rows turned round change no score."""
    src = folder[0]
    docs = spark.read.parquet(f"{src}/documents.parquet")
    turned = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0"
    docs.selectExpr("doc_id", "text", f"if({turned}, 'zz', lang) as lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{src}/labels.parquet").selectExpr("doc_id", "quality", f"if({turned}, 1 - toxic, toxic) as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op4_toxicity", "op10_language_id"):
        one = sorted(map(tuple, queries.QUERIES[name](spark, src).collect()))
        assert one == sorted(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).collect()))


def test_a_document_without_an_id_is_held_out_of_no_fold(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "doc_id long")
    got = [tuple(r) for r in df.select("doc_id", queries.held_out(0), (fold_column() == 0).alias("plain")).collect()]
    assert got[0] == (None, False, None) and all(a == b for _, a, b in got[1:])
