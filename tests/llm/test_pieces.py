import hashlib
import random

import numpy as np
import pytest

from tallyspan.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

ODD = ["", " ", "a", "  a  b ", "▁x", "\x00a", "<s>hi</s><0x0A>\n\t", "﻿�​", "é é ﬁ Ａ", "a" * 100, "ab" * 77, " " * 37, "ha" * 9 + "h", "🙂漢\U00010348字"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def model():
    return pieces.load(pieces.model_path())


def ids_of(model, texts):
    out = []
    for _, _, flat, ends in model.encode(texts):
        out += [flat[a:b].tolist() for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
    return out


def naive(library, text):
    """One merge at a time, the best score first, the leftmost of equals."""
    if not text:
        return []
    syms = list("▁" + text.replace(" ", "▁"))
    known = {library.id_to_piece(i): (library.get_score(i), i) for i in range(259, library.get_piece_size())}
    while True:
        best = min(((-known[a + b][0], n) for n, (a, b) in enumerate(zip(syms, syms[1:], strict=False)) if a + b in known), default=None)
        if best is None:
            break
        syms[best[1] : best[1] + 2] = [syms[best[1]] + syms[best[1] + 1]]
    return [i for s in syms for i in ([known[s][1]] if s in known else [3 + b for b in s.encode()])]


def test_ids_and_texts_equal_the_library(library, model):
    rng = random.Random(4)
    alphabets = ["abcdefghij ", "aeinorst", " \n\tab", "àéüñ漢字かな🙂x ", "0123456789.,", "=-_#*/ ", "hеllо wоrld"]
    vocab = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    texts = list(ODD)
    for _ in range(1500):
        a = rng.choice(alphabets)
        texts.append("".join(rng.choice(a) for _ in range(rng.randint(1, 60))))
        texts.append("".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))))
        w = rng.choice(vocab)
        texts.append(w * rng.randint(2, 9) + rng.choice(vocab) + w * 3)  # repeated places of one word, some unsafe together
    got = ids_of(model, texts)
    assert got == library.encode(texts)
    assert [model.decode(np.array(g, np.int64)) for g in got] == library.decode(got)


def test_rounds_equal_merging_one_by_one(library, model):
    rng = random.Random(8)
    vocab = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 2000)]
    texts = ODD + ["".join(rng.choice(vocab) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    assert ids_of(model, texts) == [naive(library, t) for t in texts]


def test_places_that_would_differ_are_merged_alone(model):
    """A vocabulary whose joined pair outranks the pair that makes it: merging both places at once would be wrong."""
    own = pieces.PieceModel.__new__(pieces.PieceModel)
    names = ["x", "y", "xy", "xyx", "yxy"]
    score = {"xy": 5, "xyx": 1, "yxy": 9}  # a rank: less is better
    own.count, own.prefix = len(names), ""
    own.by_point = np.full(0x110000, -1, np.int32)
    own.by_point[[ord("x"), ord("y")]] = [0, 1]
    pairs = sorted((names.index(p[:k]) << 21 | names.index(p[k:]), score[p], names.index(p)) for p in score for k in range(1, len(p)) if p[:k] in names and p[k:] in names)
    own.pairs, own.ranks, own.joined = (np.array(x, t) for x, t in zip(zip(*pairs, strict=True), (np.int64, np.int32, np.int32), strict=True))
    own.beside = np.array([0 << 21 | 1, 1 << 21 | 0], np.int64)
    ids, size = own.merge(["xyxy", "xyxyxy", "xy"])
    assert [names[i] for i in ids] == ["xyx", "y", "xyx", "yxy", "xy"] and size.tolist() == [2, 2, 1]


def test_ids_that_no_encoder_gives_decode_as_in_the_library(library, model):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(32000), 259, 28705]) for _ in range(rng.randint(0, 8))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_long_texts_chunks_and_memory(library, model, monkeypatch):
    rng = random.Random(3)
    long = "".join(rng.choice("abcde") for _ in range(30_000)) + " " * 5000 + "漢字" * 4000 + "\n" * 3000
    texts = ["x y", None, long, "", "last one"]
    monkeypatch.setattr(pieces, "CHUNK", 1000)
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    want = library.encode([t or "" for t in texts])
    assert ids_of(model, texts) == want and ids_of(model, texts) == want
    assert [n for a, b in pieces.chunks([5, 2000, 1, 1]) for n in range(a, b)] == [0, 1, 2, 3]
    assert list(pieces.chunks([])) == []


def test_columns_nulls_clashing_names_and_round_trip(spark, library):
    rows = [(1, t, "x", 1) for t in ODD] + [(2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, input_ids int")
    got = pieces.encode(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "input_ids"]
    want = sorted(
        (i, len(ids := library.encode(t or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids)
        for i, t, *_ in rows
    )
    assert sorted(map(tuple, got.collect())) == want
    back = sorted(r.text for r in pieces.decode(got).collect())
    assert back == sorted((t or "").replace("▁", " ") if t != "▁x" else " x" for _, t, *_ in rows)
    assert pieces.encode(docs.limit(0)).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(pieces.model_path(), "rb").read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    path = tmp_path / "u.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceModel(str(path))
