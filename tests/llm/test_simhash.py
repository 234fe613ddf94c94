import random

import xxhash
from pyspark.sql import functions as F

from tallyspan.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component_id string, u int"


def brute_fp(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode()
    words = words.split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """fps: {id: fingerprint}; smallest id reachable over links of at most 3 bits."""
    out, seen = {}, set()
    for i in sorted(fps):
        if i in seen:
            continue
        todo, comp = [i], {i}
        while todo:
            a = todo.pop()
            for b in fps:
                if b not in comp and (fps[a] ^ fps[b]).bit_count() <= 3:
                    comp.add(b)
                    todo.append(b)
        seen |= comp
        out |= dict.fromkeys(comp, i)
    return out


def test_masks_cover_every_pair_within_radius():
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks()]
    assert len(masks) == 15
    for a in range(64):
        for b in range(a, 64):
            for c in range(b, 64):
                assert any(not m & (1 << a | 1 << b | 1 << c) for m in masks)


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one Two", "ÄB c d", "x " * 70000]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint(t) & (1 << 64) - 1 == brute_fp(t)


def test_links_in_hot_buckets_equal_brute_force(spark):
    rng = random.Random(2)
    fps = {0}
    base = rng.getrandbits(64)
    while len(fps) < 160:  # a dense ball and strays, so that many buckets pass the limit of 4
        x = base
        for b in rng.sample(range(64), rng.randint(0, 7)):
            x ^= 1 << b
        fps.add(x if rng.random() < 0.8 else rng.getrandbits(64))
    ids = dict(enumerate(sorted(fps, key=lambda _: rng.random())))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(i, signed(x)) for i, x in ids.items()], "doc_id long, fp long")
    expect = brute_components(ids)
    for limit in (4, 64, 1000):
        got = {r.doc_id: r.component_id for r in simhash.components(df, bucket_rows=limit).collect()}
        assert got == expect


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "a", "b", 1), (2, "", None, None, None), (3, "One two three", None, "x", 1), (3, "One two three", None, "x", 1), (None, "one two THREE", None, None, 2), (7, "quite different words stand here", None, None, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, 3), (1, 1), (2, 1), (3, 3), (3, 3), (7, 7)]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]
    unnamed = spark.createDataFrame([(None, "no key at all here", None, "s", 1)] * 3 + rows, SCHEMA)
    assert sorted(r.doc_id or -1 for r in simhash.keep_first(unnamed).collect()) == [-1, 1, 3, 7]
    assert simhash.keep_first(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.filter(F.col("doc_id") == 7)).collect()[0].component_id == 7
