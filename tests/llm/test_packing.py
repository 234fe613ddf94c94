import random
import zlib

import numpy as np
import pytest

from tallyspan.llm import packing


def ids_of(text):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    t = ids_of.t = getattr(ids_of, "t", None) or tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids


TRICKY = ["", " ", "  \n\n a  ", "don't we'll I'M", "ÄÖ ß é", "日本語テキスト", "😀👩‍👩‍👧", "a" * 3000, "1234567890" * 50, "\t\r\n\x0b\x0c", "x<|endoftext|>y", "<|endoftext|>", "  z", "٣٤٥ १२३", "é", "\x00\x01", "ﬁ ǅ ª º", "​﻿"]


def test_ids_equal_those_of_tokenizers():
    rng = random.Random(2)
    encode = packing.encoder()
    for t in TRICKY:
        assert encode(t) == ids_of(t), t
    for _ in range(400):
        t = "".join(rng.choice(TRICKY) if rng.random() < 0.3 else chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F6FF)])) for _ in range(rng.randint(1, 40)))
        assert encode(t) == ids_of(t), t


def test_pieces_and_places(spark):
    rng = random.Random(3)
    texts = [None, "", *TRICKY] + [" ".join(rng.choice(["the", "Haus", "réel", "x"]) for _ in range(int(rng.choice([3, 40, 700, 2047, 2048, 5000])))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in enumerate(texts)] + [(None, "same", 2, "p"), (None, "same", 2, "p")], "doc_id long, text string, length int, piece string")
    rows = packing.pack(docs).collect()
    own: dict = {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = [*ids_of(t), 0]
        got = sorted(own[i], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        assert [(r.start, r.length) for r in got] == packing.cut(len(ids))
        assert [x for r in got for x in r.input_ids] == ids
        for r in got:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert len(own[None]) == 2
    fill: dict = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= packing.SIZE
    total = sum(r.length for r in rows)
    assert len(fill) <= -(-total // packing.SIZE) * 1.1 + 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_cuts():
    assert packing.cut(1) == [(0, 1)] and packing.cut(2048) == [(0, 2048)] and packing.cut(2049) == [(0, 1), (1, 2048)]
    assert packing.cut(4100) == [(0, 4), (4, 2048), (2052, 2048)]


def test_plan_covers_the_histogram_near_its_bound():
    rng = random.Random(5)
    for counts in ({}, {7: 3}, {1025: 40}, {1000: 10, 1048: 10}, {700: 300, 650: 300, 698: 300}, {rng.randint(1, 2047): rng.randint(1, 500) for _ in range(300)}):
        plan = packing.plan(counts)
        used: dict = {}
        for fill, n in plan:
            assert n > 0 and sum(fill) <= packing.SIZE
            for x in fill:
                used[x] = used.get(x, 0) + n
        assert used == counts
        least = max(-(-sum(x * n for x, n in counts.items()) // packing.SIZE), sum(n for x, n in counts.items() if x > packing.SIZE // 2))
        assert sum(n for _, n in plan) <= least * 1.02 + 1


def size_of(part):
    return sum(n for _, n in part)


def greedy_size(counts):
    need = np.zeros(packing.SIZE + 1, np.int64)
    for x, n in counts.items():
        need[x] = n
    return size_of(packing._best_fit(need, packing.SIZE))


def triplets(seed, kinds, n):
    """Pieces of ``kinds`` sequences, each of three pieces that fill it exactly, ``n`` times each."""
    rng, counts = random.Random(seed), {}
    for _ in range(kinds):
        a, b = rng.randint(520, 800), rng.randint(520, 800)
        for x in (a, b, packing.SIZE - a - b):
            counts[x] = counts.get(x, 0) + n
    return counts


def mixed(seed, distinct, most):
    rng = random.Random(seed)
    return {min(2047, int(rng.paretovariate(0.9) * 40)): rng.randint(1, most) for _ in range(distinct)}


@pytest.mark.parametrize("seed", range(3))
def test_columns_carry_the_plan_and_reach_the_bound_of_hard_histograms(seed):
    counts = triplets(seed, 40, 200)
    columns, rest, low = packing.plan_parts(counts)
    assert low == pytest.approx(8000) and greedy_size(counts) > 8200
    assert size_of(columns) + size_of(rest) <= 8000 * 1.002 and size_of(columns) > 0.99 * 8000


@pytest.mark.parametrize("seed", range(3))
def test_most_sequences_come_from_columns_and_never_more_than_best_fit(seed):
    for counts in (mixed(seed, 900, 60), mixed(seed + 9, 400, 5)):
        columns, rest, low = packing.plan_parts(counts)
        assert low <= size_of(columns) + size_of(rest) <= greedy_size(counts)
        assert size_of(columns) > 0.5 * (size_of(columns) + size_of(rest))


def test_prices_bound_the_program_from_below():
    """Pairs of pieces just over a third: the bound is half their number, far above sum / size."""
    need = np.zeros(packing.SIZE + 1, np.int64)
    need[[690, 700, 720]] = 40, 60, 100
    columns, low = packing.solve(need, rounds=200, rate=0.05)
    assert 99 < low <= 100.0001 and sum(a for _, a in columns) == pytest.approx(100)


def test_ranks_of_a_hot_length_are_gapless(spark):
    rows = spark.range(3000).selectExpr("id as k", "case when id % 3 = 0 then id % 50 + 1 else 77 end as v", "rand(1) as __salt")
    counts = {r["v"]: r["count"] for r in rows.groupBy("v").count().collect()}
    got: dict = {}
    for r in packing.ranked(rows, "v", ["k"], counts).collect():
        got.setdefault(r.v, []).append(r["__rank"])
    assert all(sorted(x) == list(range(len(x))) for x in got.values()) and len(got[77]) == counts[77]
