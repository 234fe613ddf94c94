"""SimHash fingerprints and near-duplicate components by covering LSH.

Fingerprints that differ in at most three bits are linked. The masks form a
covering family: every bit position i carries a non-zero vector phi(i) of
GF(2)^4, and mask v (15 non-zero vectors) holds the positions with
<phi(i), v> = 1. Three differing positions span at most three dimensions, so
some v is orthogonal to all of them, and the pair agrees under that mask: no
pair within the radius is ever missed.

Equal fingerprints are one node. A bucket of up to ``bucket_rows`` nodes is
joined with itself on its key. The nodes of larger buckets meet exactly and in
linear size instead: each sends itself to all fingerprints within two bits;
whoever reaches one of these within one bit is within three bits of all others
there, and conversely every pair within three bits meets at such a place.

Null texts and texts without words have fingerprint zero and are linked like
any other. Very long texts are hashed whole, in parts. Ties: a bit set in exactly
half the hashes is 0. Repeated rows and repeated doc_ids stay, one result row
each; a null doc_id is never a component id unless its whole component has none.
An empty table gives an empty result. Only the key and the text are read
(``keep_first`` carries all columns along), so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import map_texts
from tallyspan.operators.graph import connected_components
from tallyspan.session import materialize

RADIUS = 3
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(g, SEED) for g in grams])
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), _CHUNK):
        ones += np.unpackbits(rows[at : at + _CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``(key, fp)``: the fingerprint of every row as a signed 64-bit number."""
    return map_texts(docs, lambda texts: {"fp": [fingerprint(t, width) for t in texts]}, "fp long", [key], text)


def covering_masks() -> list[int]:
    """The 15 masks of the covering family for radius 3, as signed numbers."""
    phi = [i % 15 + 1 for i in range(64)]
    masks = [sum(1 << i for i in range(64) if (phi[i] & v).bit_count() & 1) for v in range(1, 16)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _ball() -> list[tuple[int, int]]:
    """(distance, xor) of all 2,081 points within two bits of the origin."""
    wrap = lambda m: m - (1 << 64) if m >> 63 else m
    one = [(1, wrap(1 << i)) for i in range(64)]
    two = [(2, wrap(1 << i | 1 << j)) for i in range(64) for j in range(i)]
    return [(0, 0), *one, *two]


def links(nodes: DataFrame, bucket_rows: int = 64) -> DataFrame:
    """``(src, dst)`` links between distinct fingerprints ``fp`` of ``nodes``.

    Every link has distance at most three, and every pair within distance
    three is connected by the links. Buckets above ``bucket_rows`` take the
    linear exact way; no pair is capped or dropped.
    """
    keyed = nodes.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in covering_masks()])).alias("t", "k"),
    )
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = materialize(keyed.join(sizes.hint("merge"), ["t", "k"]), "simhash-buckets")
    small = member.filter(F.col("n") <= bucket_rows)
    a, b = small.select("t", "k", F.col("fp").alias("src")), small.select("t", "k", F.col("fp").alias("dst"))
    near = a.join(b.hint("merge"), ["t", "k"]).filter("src < dst and bit_count(src ^ dst) <= 3").select("src", "dst")
    large = member.filter(F.col("n") > bucket_rows).select("fp").distinct()
    ball = _ball()
    reach = F.array(*[F.lit(m) for _, m in ball])
    spread = large.select("fp", F.posexplode(reach).alias("at", "m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("z"), (F.col("at") <= 64).alias("inner")
    )
    hubs = spread.groupBy("z").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.filter("hub is not null and n > 1").select("z", "hub")
    star = spread.join(hubs.hint("merge"), "z").filter("fp <> hub").select(F.least("fp", "hub").alias("src"), F.greatest("fp", "hub").alias("dst"))
    return near.unionByName(star).distinct()


def components(marked: DataFrame, key: str = "doc_id", bucket_rows: int = 64) -> DataFrame:
    """``(key, fp, component_id)`` for rows ``(key, fp)``; the id is the smallest key reachable."""
    return marked.join(_named(marked, key, bucket_rows).hint("merge"), "fp").select(key, "fp", "component_id")


def _named(marked: DataFrame, key: str, bucket_rows: int) -> DataFrame:
    """``(fp, root, component_id)`` for each fingerprint; the root is a fingerprint of the component."""
    nodes = materialize(marked.groupBy("fp").agg(F.min(key).alias("low")), "simhash-nodes")
    comp = connected_components(links(nodes, bucket_rows))
    # merge joins: these tables grow with the corpus and are never broadcast
    tied = nodes.join(comp.hint("merge"), nodes["fp"] == comp["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    tied = materialize(tied, "simhash-roots")
    ids = tied.groupBy("root").agg(F.min("low").alias("component_id"))
    return tied.join(ids.hint("merge"), "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = 64) -> DataFrame:
    """``(key, fp, component_id)``, one row per input row."""
    return components(materialize(fingerprints(docs, key, text), "simhash"), key, bucket_rows)


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, the one whose key is its id.

    Where rows repeat a key, one of those that bear the component's stays. A
    row without a key stays only where its whole component has none, one of it.
    """
    marked = materialize(fingerprints(docs, key, text), "simhash")
    named = materialize(_named(marked, key, 64), "simhash-named")
    found = materialize(marked.filter(F.col(key).isNotNull()).join(named.hint("merge"), "fp").select(key, "component_id"), "simhash-found")
    gone = found.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.filter(F.col(key).isNotNull()).join(gone.hint("merge"), key, "left_anti").select(*columns)
    again = materialize(found.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "simhash-again")
    if not again.isEmpty():
        kept = materialize(kept, "simhash-kept")
        once = kept.join(again.hint("merge"), key, "left_anti").select(*columns)
        kept = once.unionByName(kept.join(again.hint("merge"), key, "left_semi").dropDuplicates([key]).select(*columns))
    if marked.filter(F.col(key).isNull()).isEmpty():
        return kept
    row = docs.filter(F.col(key).isNull()).select(F.struct(*columns).alias("__row"), F.col(text).alias(text))
    without = map_texts(row, lambda texts: {"fp": [fingerprint(t) for t in texts]}, "fp long", ["__row"], text)
    without = without.join(named.filter("component_id is null").hint("merge"), "fp").dropDuplicates(["root"]).select("__row.*")
    return kept.unionByName(without)
