import random

import numpy as np

from tallyspan.llm import embed


def brute(rows, threshold=embed.THRESHOLD):
    ok = [n for n, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    vec = {n: np.array(rows[n][1], np.float32).astype(np.float64) for n in ok}
    near = {n: set() for n in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(vec[a]) == len(vec[b]):
                if vec[a] @ vec[b] / (np.linalg.norm(vec[a]) * np.linalg.norm(vec[b])) >= threshold:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for n in range(len(rows)):
        comp, todo = {n}, [n]
        while todo:
            for b in near[todo.pop()] - comp:
                comp.add(b)
                todo.append(b)
        out.append((rows[n][0], len(near[n]), min(rows[c][0] for c in comp)))
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        label = int(rng.integers(0, 3))
        base = np.random.default_rng(100 + int(rng.integers(0, 12))).normal(size=16)
        v = (base + rng.normal(size=16) * float(rng.choice([0.0, 0.15, 0.3]))).astype(np.float32).tolist()
        rows.append((i, v, label if i % 17 else None))
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, [], 1), (305, [float("inf")] + [1.0] * 15, 1), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links int, node string")
    for tile in (7, 512):
        got = sorted(tuple(r) for r in embed.near_duplicates(df, tile=tile).collect())
        assert got == brute(rows)
    assert embed.near_duplicates(df.limit(0)).count() == 0


def test_bound_never_misses_and_saves_work():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(300, 64))
    b = np.concatenate([a[:50] + rng.normal(size=(50, 64)) * 0.25, rng.normal(size=(250, 64))])
    i, j, again = ([*x] for x in zip(*embed.tile_links(a, b, 0.93, block=64), strict=True))
    i, j, again = np.concatenate(i), np.concatenate(j), sum(again)
    cos = a @ b.T / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
    assert set(zip(i, j, strict=True)) == set(zip(*np.nonzero(cos >= 0.93), strict=True))
    assert again < 0.02 * a.shape[0] * b.shape[0]


def test_extreme_components_and_a_tile_of_near_copies(spark):
    rows = [(0, [1e200, 2e200], 1), (1, [1e-200, 2e-200], 1), (2, [1.0, 2.0], 1), (3, [-1e300, 1e300], 1), (4, [5e-324, 5e-324], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (0, 3), 4: (3, 0)}
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    near = [(n, (base + rng.normal(size=8) * 1e-3).tolist(), 0) for n in range(700)]
    got = embed.near_duplicates(spark.createDataFrame(near, "vec_id long, embedding array<double>, label int"), tile=200).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(699, 0)}
