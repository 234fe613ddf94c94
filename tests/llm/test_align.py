import hashlib
import random
from collections import Counter

import pytest

from tallyspan.llm import align, pieces

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, n_a string, pair int"


def byte_alphabet():
    """The byte that each character of a byte-level token stands for: printable ones themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    chars = byte_alphabet()

    def tokens(text):
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(chars[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([i - 3]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        return list(zip(ia, ba, strict=True)), list(zip(ib, bb, strict=True))

    return tokens


def brute(texts, tokens):
    rows, held = [], []
    for t in texts:
        a, b = tokens(t) if t else ([], [])
        whole = (" " + t).encode() if t else b""
        if not t or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            rows.append(None)
            held.append([])
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        text, low = [], 0
        for c in common:
            text.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= c) for side in spans))
            low = c
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        rows.append((len(a), len(b), len(common), links, ";".join(text)))
        held.append(set(links))
    count = Counter(p for s in held for p in s)
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if r is None
        else (*r[:3], len(r[3]), sum(count[p] == top[p[0]] for p in r[3]), sum(count[p] for p in r[3]), hashlib.sha256(r[4].encode()).hexdigest())
        for r in rows
    ], count


def texts():
    rng = random.Random(5)
    odd = [None, "", " ", "a", "\n\n  x", "<|endoftext|> and <s>", "▁x", "a▁b", "naïve café 漢字かな🙂", "\x00\x01", "x" * 50, "don't we'll", "0123456789 12,345.67"]
    words = ["alpha", "beta", "tokenization", "überall", "the", "of", "12", "foo_bar", "\t", "…"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    return [*odd, *made, made[0], made[0], "hello"]


def test_equal_to_brute_force_in_blocks_of_any_size(spark, sides):
    rows = texts()
    want, count = brute(rows, sides)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(rows)], SCHEMA).repartition(3)
    for chars in (1, 300, align.BLOCK_CHARS):
        got = align.align(docs, block_chars=chars)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect())) == [(i, *w) for i, w in enumerate(want)]
    pairs = align.pair_counts(align.blocks(docs, block_chars=300), salts=3).collect()
    assert {(r.a_id, r.b_id): r.n_docs for r in pairs} == dict(count)
    assert {(r.a_id, r.b_id) for r in pairs if r.is_best} == {p for p, n in count.items() if n == max(m for q, m in count.items() if q[0] == p[0])}


def test_group_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "hello", "x", 1), (2, None, None, None)], SCHEMA)
    got = {r.doc_id: r for r in align.align(docs, with_groups=True).collect()}
    assert got[1].groups_sha256 == hashlib.sha256(got[1].groups.encode()).hexdigest() and got[1].groups.count(";") + 1 == got[1].n_groups
    assert (got[2].groups, got[2].groups_sha256, got[2].n_links) == ("", "", 0)
    assert align.align(docs.limit(0)).count() == 0
    assert [r.n_links for r in align.align(docs.filter("doc_id = 2")).collect()] == [0]


def test_a_long_text_is_one_block(spark, sides):
    long = "".join(random.Random(1).choice("ab cé\n") for _ in range(20_000))
    ids = sides(long)
    found = align.aligned([long, "z"])
    assert found["n_a"][0] == len(ids[0]) and found["n_b"][0] == len(ids[1])
    assert found["n_links"][0] == found["n_a"][0] + found["n_b"][0] - found["n_groups"][0]
    assert pieces.load(pieces.model_path()).count == 32000
