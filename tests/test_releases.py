import io
import random
import zipfile

import pytest

from tallyspan.functions import folding
from tallyspan.operators import releases, sketches
from tallyspan.sources import archives


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string").repartition(3)


def test_one_row_costs_one_bucket_and_one_line(spark, tmp_path):
    rows = [(i, f"v{i}") for i in range(200)] + [(7, "again")]
    r = releases.Releases(spark, str(tmp_path / "r"), "k", 40)
    a, all_ = r.publish(frame(spark, rows))
    b, none = r.publish(frame(spark, rows[::-1]), a)
    assert len(all_) > 30 and none == [] and r.changelog(a, b).count() == 0
    changed = [(k, "other" if k == 5 else v) for k, v in rows]
    c, one = r.publish(frame(spark, changed), b)
    assert len(one) == 1 and [tuple(x) for x in r.changelog(b, c).collect()] == [(5, "changed")]
    assert sorted(map(tuple, r.rows(c).collect())) == sorted(changed) and sorted(map(tuple, r.rows(a).collect())) == sorted(rows)
    d, _ = r.publish(frame(spark, [x for x in changed if x[0] != 9] + [(1000, None), (7, "third")]), c)
    assert sorted(map(tuple, r.changelog(c, d).collect())) == [(7, "changed"), (9, "removed"), (1000, "added")]
    written = sorted(p.name for p in (tmp_path / "r" / "data" / f"release={c}").glob("bucket=*"))
    assert written == [f"bucket={one[0]}"]
    e, gone = r.publish(frame(spark, []), d)
    assert r.rows(e).count() == 0 and len(gone) == len(all_) and {x.change for x in r.changelog(d, e).collect()} == {"removed"}


def test_digests_ignore_order_and_see_every_value(spark):
    rows = [(i, None if i % 5 else "x") for i in range(60)]
    root = lambda x: releases.digest_tree(frame(spark, x), "k", 20).filter("level = 2").first().digest
    assert root(rows) == root(rows[::-1]) != root([*rows, (1, "x")])
    assert root([(1, None)]) != root([(1, "-")]) != root([(1, "")])


def test_least_hashes_under_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(s, rng.randrange(500)) for s in ("a", "b") for _ in range(900)] + [("c", 1), ("c", 1), ("c", None), ("d", None)]
    df = spark.createDataFrame(rows, "s string, x int")
    got = [sorted(map(tuple, sketches.bottom_k(df.repartition(n), ["s"], "x", 40, "z", salts).collect())) for n, salts in ((1, 1), (3, 7), (8, 32))]
    assert got[0] == got[1] == got[2]
    import hashlib

    h = lambda x: int(hashlib.md5(f"z:{x}".encode()).hexdigest()[:13], 16)
    for s in "abc":
        want = sorted((h(x), x) for x in {x for t, x in rows if t == s and x is not None})[:40]
        assert [(r[2], r[3]) for r in got[0] if r[0] == s] == want
    sk = sketches.bottom_k(df, ["s"], "x", 40, "z")
    size = {r.s: (r.n_items, r.is_exact) for r in sketches.sizes(sk, ["s"], 40).collect()}
    true = {s: len({x for t, x in rows if t == s and x is not None}) for s in "ab"}
    assert size["c"] == (1.0, True) and all(abs(size[s][0] / true[s] - 1) < 0.5 for s in "ab")
    union = sketches.merged(sk.selectExpr("'u' as t", "hash", "item"), ["t"], 40).collect()
    assert [r.item for r in sorted(union, key=lambda r: r["rank"])] == [x for _, x in sorted((h(x), x) for x in {x for _, x in rows if x is not None})[:40]]
    pair = {(r.a, r.b): r.jaccard for r in sketches.overlaps(sk, "s", 40).collect()}
    a, b = ({x for t, x in rows if t == s} for s in "ab")
    assert abs(pair["a", "b"] - len(a & b) / len(a | b)) < 0.3


def zipped(path, members):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    path.write_bytes(body.getvalue())


def test_members_are_partitions_and_torn_ones_are_kept_out(spark, tmp_path):
    good = lambda n: "<D><V>1</V>" + "".join(f"<M><ID>{i}</ID><N><A>x{i}</A><A>y</A></N> </M>" for i in range(n)) + "</D>"
    zipped(tmp_path / "one.zip", {f"m{i}.xml": good(i) for i in range(6)})
    zipped(tmp_path / "two.zip", {"long.xml": good(5000), "torn.xml": good(4000)[:-9], "empty.xml": ""})
    (tmp_path / "three.zip").write_bytes(b"no archive")
    zipped(tmp_path / "note.txt", {"m.xml": good(1)})
    records, members = archives.read_master_data(spark, str(tmp_path), "M")
    state = {(r.archive.rsplit("/", 1)[1], r.member): (r.state, r.sha256) for r in members.collect()}
    assert {k for k, (s, _) in state.items() if s == "torn"} == {("two.zip", "torn.xml"), ("two.zip", "empty.xml"), ("three.zip", "")} and len(state) == 10
    import hashlib

    assert state["one.zip", "m3.xml"] == ("whole", hashlib.sha256(good(3).encode()).hexdigest())
    n = {(r.archive.rsplit("/", 1)[1], r.member): r["count"] for r in records.groupBy("archive", "member").count().collect()}
    assert n == {("one.zip", f"m{i}.xml"): i for i in range(1, 6)} | {("two.zip", "long.xml"): 5000}
    assert dict(records.filter("member = 'm3.xml' and no = 2").first().fields) == {"ID": "1", "N/A": "x1"}
    assert len(archives._Reader({"archives": f"{tmp_path}/one.zip\n{tmp_path}/two.zip", "record": "M"}).partitions()) == 9


def test_many_small_members_share_partitions(spark, tmp_path):
    for a in range(40):
        zipped(tmp_path / f"a{a:02}.zip", {f"m{i}.xml": f"<D><M><ID>{a}-{i}</ID></M></D>"[: 12 if i == 3 else None] for i in range(20)})
    (tmp_path / "no.zip").write_bytes(b"no archive")
    paths = sorted(tmp_path.glob("*.zip"))
    options = {"archives": "\n".join(map(str, paths)), "record": "M", "parts": 8}
    for lengths in ({}, {"lengths": "\n".join(str(p.stat().st_size) for p in paths)}):
        parts = archives._Reader(options | lengths).partitions()
        assert 8 <= len(parts) <= 16
        rows = [r for p in parts for r in archives._Reader(options).read(p)]
        assert sorted(r[3]["ID"] for r in rows if r[2]) == sorted(f"{a}-{i}" for a in range(40) for i in range(20) if i != 3)
        assert sum(r[2] is None for r in rows) == 801 and sum(r[5] is not None for r in rows) == 41
    # a large archive is cut at its members
    lengths = {"lengths": "\n".join(str(10**9 if p.name == "a00.zip" else 100) for p in paths)}
    parts = archives._Reader(options | lengths).partitions()
    assert sum(any(a.endswith("a00.zip") for a, _ in p.items) for p in parts) > 1
    records, members = archives.read_master_data(spark, str(tmp_path), "M")
    assert (records.count(), members.count(), members.filter("state = 'torn'").count()) == (40 * 19, 801, 41)


@pytest.mark.parametrize("a,b", [("Müller", "MÜLLER"), ("café", "cafe"), ("Straße", "STRASSE")])
def test_spellings_meet(spark, a, b):
    from pyspark.sql import functions as F

    left, right = spark.createDataFrame([(a,), ("zz",)], "x string"), spark.createDataFrame([(b,), ("yy",)], "y string")
    assert [tuple(r) for r in left.join(right, folding.folded(F.col("x")) == folding.folded(F.col("y"))).collect()] == [(a, b)]
    assert left.select(folding.group_tokens(F.lit("Die B-Gruppe/A, b"), ("die",))).first()[0] == "a b gruppe"
