"""Embedding near-duplicates by int8 tile products with error bounds.

Equal vectors of a label are one node with a count, known by two hashes of the
vector. The nodes of a label are dealt to tiles; every two tiles of a label
meet once, in a task of their own choice of partition, so a label with a third
of all rows is spread like any other. Tiles grow with the label up to
``MAX_TILE`` rows, since each travels to half of the others. A tile's vectors
are scaled to length one and quantised to int8; since
u.v - u'.v' = (u - u').v' + u.(v - v'), the true cosine of unit vectors lies
within e(u)|v'| + e(v) of the int8 product, where e is the length of the
quantisation error. Only pairs whose bound reaches the threshold are computed
again in double precision, and these alone decide. Products are made in blocks
of ``BLOCK`` rows and their links are added up at once, so that even a tile
whose rows are all linked stays small. A tile product returns one row per
linked node: the vectors it is linked with there, and the smallest node of its
part, which is enough for the components.

Vectors that are null, empty or zero, hold null or non-finite components, or
have a null label link with nothing: no links, their own component. Components
of any finite size, very large and very small ones too, are compared after
division by the largest. Vectors of unequal length never link. Ties: a cosine
equal to the threshold links. Repeated rows are vectors of their own; a
repeated id takes its smallest component like any id. An empty table gives an
empty result. Only key, vector and label are read, so other columns may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import text_batches
from tallyspan.operators.graph import connected_components
from tallyspan.session import materialize

THRESHOLD = 0.93
#: Rows of a tile: at least so many (a small label is one tile), and at most; between, a label has LABEL_TILES tiles.
TILE, MAX_TILE, LABEL_TILES = 512, 8_192, 16
BLOCK = 1_024
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rounding of double arithmetic that the bound allows for.
SLACK = 1e-9


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit rows, the scale of each row, and the length of its quantisation error."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1) + SLACK


def _int_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of int8 rows; float32 holds the sums of up to 1,024 dimensions exactly."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        out += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; division by the largest component first keeps extreme rows from overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, block: int = BLOCK, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Row pairs of ``a`` and ``b`` with cosine >= threshold, and the number recomputed in full precision, block by block; if ``same``, each pair once."""
    a, b = unit(a), unit(b)
    (qa, sa, ea), (qb, sb, eb) = quantise(a), quantise(b)
    lb = np.linalg.norm(qb.astype(np.float64), axis=1) * sb
    for x in range(0, len(a), block):
        for y in range(x if same else 0, len(b), block):
            p, q = slice(x, x + block), slice(y, y + block)
            upper = _int_product(qa[p], qb[q]) * np.outer(sa[p], sb[q]) + np.outer(ea[p], lb[q]) + eb[None, q]
            i, j = np.nonzero(upper >= threshold)
            i, j = i + x, j + y
            if same:
                i, j = i[i < j], j[i < j]
            cos = np.concatenate([np.einsum("ij,ij->i", a[i[s : s + 65536]], b[j[s : s + 65536]]) for s in range(0, len(i), 65536)] or [np.empty(0)])
            keep = cos >= threshold
            yield i[keep], j[keep], len(i)


def _roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each of ``n`` nodes' part under the links (i, j)."""
    low = ids.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, new[i])
        if (new == low).all():
            return low
        low = new


def _tile_rows(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        nodes, links, roots = [], [], []
        for dim, same, ia, ma, va, ib, mb, vb in zip(*(b.column(k) for k in range(8)), strict=True):
            d = dim.as_py()
            ids, count = ([np.array(x.values.to_numpy()) for x in (p, q)] for p, q in ((ia, ib), (ma, mb)))
            a, c = (np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64).reshape(-1, d) for x in (va, vb))
            one = bool(same.as_py())
            own, weight, shift = (ids[0], count[0], 0) if one else (np.concatenate(ids), np.concatenate(count), len(a))
            total, stars = np.zeros(len(own)), []
            for i, j, _ in tile_links(a, c, threshold, same=one):
                j = j + shift
                total += np.bincount(i, weights=weight[j], minlength=len(own)) + np.bincount(j, weights=weight[i], minlength=len(own))
                if len(i):
                    at, back = np.unique(np.concatenate([i, j]), return_inverse=True)
                    root = _roots(len(at), back[: len(i)], back[len(i) :], np.arange(len(at)))
                    stars.append((at, at[root]))
            i, j = (np.concatenate([s[k] for s in stars] or [np.empty(0, np.int64)]) for k in (0, 1))
            low, hit = _roots(len(own), i, j, own), np.flatnonzero(total)
            nodes.append(own[hit])
            links.append(total[hit].astype(np.int64))
            roots.append(low[hit])
        cols = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (nodes, links, roots)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "links", "root"])


def near_duplicates(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """``(key, n_links, component_id)``, one row per input row."""
    spark = rows.sparkSession
    text_batches(spark)
    src = rows.select(F.col(key).alias(key), F.col(vector).alias("__v"), F.col(label).alias("__l"))
    fit = F.coalesce(
        F.col("__l").isNotNull()
        & (F.size("__v") > 0)
        & F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("__v", lambda x: x != 0),
        F.lit(False),
    )
    marked = src.withColumn("__ok", fit)
    good = marked.filter("__ok").withColumn("__h", F.struct(F.xxhash64("__v"), F.xxhash64(F.lit("b"), "__v"))).drop("__ok")
    classes = good.groupBy("__l", "__h").agg(F.min(key).alias("low"), F.count(F.lit(1)).alias("m"), F.first("__v").alias("__v"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("__v")), "embed-classes")
    tiles = F.greatest(F.ceil(F.col("n") / MAX_TILE), F.least(F.lit(LABEL_TILES), F.ceil(F.col("n") / tile))).cast("int")
    tiles_of = classes.groupBy("__l", "dim").agg(F.count(F.lit(1)).alias("n")).select("__l", "dim", tiles.alias("nt"))
    dealt = classes.join(tiles_of, ["__l", "dim"]).withColumn("i", F.pmod(F.xxhash64("node"), F.col("nt")).cast("int"))
    tiles = dealt.groupBy("__l", "dim", "nt", "i").agg(F.collect_list(F.struct("node", "m", "__v")).alias("r"))
    tiles = materialize(tiles.select("__l", "dim", "nt", "i", F.col("r.node").alias("ids"), F.col("r.m").alias("m"), F.flatten("r.__v").alias("v")), "embed-tiles")
    steps = tiles.withColumn("d", F.explode(F.sequence(F.lit(0), (F.col("nt") / 2).cast("int")))).filter("2 * d <> nt or i < d")
    left = steps.select("__l", "dim", F.pmod(F.col("i") + F.col("d"), F.col("nt")).alias("j"), (F.col("d") == 0).alias("same"), "ids", "m", "v")
    right = tiles.select("__l", "dim", F.col("i").alias("j"), F.col("ids").alias("ids2"), F.col("m").alias("m2"), F.col("v").alias("v2"))
    pairs = left.join(right.hint("shuffle_hash"), ["__l", "dim", "j"]).select("dim", "same", "ids", "m", "v", "ids2", "m2", "v2")
    found = pairs.mapInArrow(lambda bs: _tile_rows(bs, threshold), "node long, links long, root long")
    rows_before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, "1")  # a row is two tiles
    found = materialize(found, "embed-links")
    spark.conf.set(BATCH, rows_before)
    comp = connected_components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("__l", "__h", "node", "low", "m").join(sums, "node", "left").join(comp, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(ids, "component").select("__l", "__h", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    linked = good.drop("__v").join(named, ["__l", "__h"]).select(key, "n_links", "component_id")
    alone = marked.filter("not __ok").select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return linked.unionByName(alone)
