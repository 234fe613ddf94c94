"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both tokenizers read a space and the text. Token byte lengths summed up are
token ends; ends that both share cut the text into groups, and every pair of
tokens whose byte ranges overlap is a link. All texts of a block (some million
characters) are aligned at once in numpy: common ends by ``intersect1d``, group
labels by ``searchsorted``, links by repeating each token of the one side for
the run of tokens of the other side that it meets.

How many documents hold a pair of ids linked is counted over all documents: a
block adds up its own documents, a first shuffle sums by (pair, salt), a second
by pair. Counts come back to a block once for each pair that it holds, however
many of its documents do, and stand beside its documents there.

Null and empty texts, and texts whose joined tokens are not a space and the text
(such as those with U+2581), have no tokens: zeros and an empty group text. Very
long texts are aligned whole, in a block of their own; memory grows with one
text. Ties for an id's highest count all count as best. Repeated documents count
and return each for itself; an empty table gives no row. Only key and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyspan.llm import pieces
from tallyspan.llm.common import text_batches
from tallyspan.session import materialize

BYTE_MODEL = "byte_bpe_50k"
#: Characters of a block.
BLOCK_CHARS = 2_000_000
#: Salts of the first counting shuffle.
SALTS = 16
#: Bits of the second id in a pair.
_BITS = 20
_ARRAYS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "ends": "long"}


@lru_cache(2)
def byte_model(name: str = BYTE_MODEL):
    """The byte-level encoder and the bytes of its ids; strings of special tokens are plain text.

    The vocabulary is published as JSON for ``tokenizers`` and as ranks for
    ``tiktoken``, which gives equal ids in less time (the tests compare them).
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    entries = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        entries[rank] = token
    return encoding, pieces.ByteTable(entries)


@lru_cache(1)
def _listed(count: int) -> pieces.ByteTable:
    """Decimal ids followed by a comma, then those followed by a bar, then by a semicolon."""
    return pieces.ByteTable([b"%d%c" % (i, sep) for sep in b",|;" for i in range(count)])


def _sums(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that end at ``ends``."""
    return np.diff(np.r_[0, np.cumsum(values)][ends], prepend=0)


def tokenized(texts: list[str | None], model: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bool]]:
    """(A's ids, where each text's end, B's ids, where each text's end, whether a text has tokens) of all texts."""
    encoding, table = byte_model()
    own = pieces.load(pieces.model_path(model))
    raw = [b" " + t.encode() if t else b"" for t in texts]
    a = [encoding.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) if t else np.zeros(0, np.int64) for t in texts]
    b = []
    for _, _, flat, ends in own.encode(texts):
        b += np.split(flat.astype(np.int64), ends[:-1])
    whole = b"".join(raw)
    valid = [bool(r) for r in raw]
    joined = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b)]
    if table.gather(joined[0]) != whole or own.surface.gather(joined[1]) != whole:
        valid = [bool(r) and table.gather(x) == r and own.surface.gather(y) == r for r, x, y in zip(raw, a, b, strict=True)]
        a, b = ([x if v else x[:0] for x, v in zip(side, valid, strict=True)] for side in (a, b))
        joined = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b)]
    return joined[0], np.cumsum([len(x) for x in a]), joined[1], np.cumsum([len(x) for x in b]), valid


def aligned(texts: list[str | None], model: str = pieces.MODEL, with_groups: bool = False) -> dict[str, np.ndarray | list]:
    """The alignment of a block of texts.

    Per text: token, group and link counts and the digest of its groups, and
    ``ends``, where its entries end in ``at`` and ``times``: which of the
    block's ``pairs`` it holds linked, and how often. ``docs`` says how many
    texts hold each pair.
    """
    ids_a, last_a, ids_b, last_b, valid = tokenized(texts, model)
    ends_a = byte_model()[1].ends(ids_a)
    ends_b = pieces.load(pieces.model_path(model)).surface.ends(ids_b)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    starts_a = np.r_[0, ends_a[:-1]] if len(ends_a) else ends_a
    first, last = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(ends_b, ends_a)
    width = last - first + 1
    link_a = np.repeat(np.arange(len(ids_a)), width)
    link_b = np.repeat(first - (np.cumsum(width) - width), width) + np.arange(len(link_a))
    doc_a = np.repeat(np.arange(len(texts)), np.diff(last_a, prepend=0))
    doc = doc_a[link_a]
    count = lambda which: np.bincount(which, minlength=len(texts))
    entry, times = np.unique(doc << (2 * _BITS) | ids_a[link_a] << _BITS | ids_b[link_b], return_counts=True)
    pairs, at, docs = np.unique(entry & ((1 << 2 * _BITS) - 1), return_inverse=True, return_counts=True)
    listed = _groups(ids_a, group_a, ids_b, group_b, np.cumsum(np.diff(last_a, prepend=0) + np.diff(last_b, prepend=0)))
    groups = [g if v else b"" for g, v in zip(listed, valid, strict=True)]
    out = {
        "n_a": np.diff(last_a, prepend=0),
        "n_b": np.diff(last_b, prepend=0),
        "n_groups": count(doc_a[np.searchsorted(ends_a, cuts)]),
        "n_links": count(doc),
        "groups_sha256": [hashlib.sha256(g).hexdigest() if v else "" for g, v in zip(groups, valid, strict=True)],
        "ends": np.cumsum(count(entry >> (2 * _BITS))),
        "pairs": pairs,
        "docs": docs,
        "at": at,
        "times": times,
    }
    return out | ({"groups": [g.decode() for g in groups]} if with_groups else {})


def _groups(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The group text of each document, whose tokens (of both sides) end at ``ends``."""
    size = int(max(group_a.max(initial=-1), group_b.max(initial=-1))) + 1
    each_a, each_b = np.bincount(group_a, minlength=size), np.bincount(group_b, minlength=size)
    base = 1 + int(max(ids_a.max(initial=0), ids_b.max(initial=0)))
    base = max(base, 1 << 16)
    merged = np.zeros(len(ids_a) + len(ids_b), np.int64)
    closes = lambda g: np.r_[g[1:] != g[:-1], np.ones(min(1, len(g)), bool)]
    merged[np.arange(len(ids_a)) + (np.cumsum(each_b) - each_b)[group_a]] = ids_a + base * closes(group_a)
    merged[np.arange(len(ids_b)) + np.cumsum(each_a)[group_b]] = ids_b + 2 * base * closes(group_b)
    table = _listed(base)
    text, cut = table.gather(merged), np.r_[0, table.ends(merged)]
    return [text[cut[i] : cut[j]][:-1] for i, j in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]


def blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = pieces.MODEL, block_chars: int = BLOCK_CHARS, with_groups: bool = False) -> DataFrame:
    """One row for each block of about ``block_chars`` characters: its keys and its alignment (see ``aligned``)."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    kind = source.schema["__key"].dataType
    arrays = _ARRAYS | {"pairs": "long", "docs": "int", "at": "int", "times": "int"} | ({"groups": "string"} if with_groups else {})
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    own = pa.list_(to_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        keys, texts, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal made, keys, texts, held
            found = aligned(texts, model, with_groups)
            columns = [pa.array([part << 32 | made], pa.int64()), pa.array([keys], own), *[pa.array([found[n]], pa.list_(types[t])) for n, t in arrays.items()]]
            made, keys, texts, held = made + 1, [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=["block", "keys", *arrays])

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n = len(t or "")
                if keys and held + n > block_chars:
                    yield close()
                keys.append(k)
                texts.append(t)
                held += n
        if keys:
            yield close()

    schema = f"block long, keys array<{kind.simpleString()}>, " + ", ".join(f"{n} array<{t}>" for n, t in arrays.items())
    return source.mapInArrow(run, schema)


def pair_counts(made: DataFrame, salts: int = SALTS) -> DataFrame:
    """``(pair, a_id, b_id, n_docs, is_best)``: in how many documents each pair of ids is linked; best are the highest of an A id."""
    each = _exploded(made)
    some = each.groupBy("pair", F.pmod("block", F.lit(salts)).alias("salt")).agg(F.sum("n").alias("n"))
    pairs = some.groupBy("pair").agg(F.sum("n").alias("n_docs"))
    pairs = materialize(pairs.select("pair", F.shiftright("pair", _BITS).cast("int").alias("a_id"), F.col("pair").bitwiseAND((1 << _BITS) - 1).cast("int").alias("b_id"), "n_docs"), "align-pairs")
    most = pairs.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return pairs.join(most, "a_id").select("pair", "a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def _exploded(made: DataFrame) -> DataFrame:
    """``(block, i, pair, n)``: the pairs of each block."""
    zipped = made.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("i", "x"))
    return zipped.select("block", "i", F.col("x.pairs").alias("pair"), F.col("x.docs").cast("long").alias("n"))


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = pieces.MODEL, block_chars: int = BLOCK_CHARS, salts: int = SALTS, with_groups: bool = False) -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups])`` of every row.

    ``n_best`` are the links whose pair's count is the highest of its A id,
    ``count_sum`` adds up the counts of all links. ``groups`` is the text of
    which ``groups_sha256`` is taken: ``a1,a2|b1;a3|b2,b3``.
    """
    made = materialize(blocks(docs, key, text, model, block_chars, with_groups), "align-blocks")
    counts = pair_counts(made, salts)
    known = _exploded(made).select("block", "i", "pair").join(counts.select("pair", "n_docs", "is_best"), "pair")
    replies = known.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("i", "n_docs", "is_best"))).alias("r"))
    replies = replies.select("block", F.col("r.n_docs").alias("n_docs"), F.col("r.is_best").alias("is_best"))
    kept = ["keys", *_ARRAYS, *(["groups"] if with_groups else [])]
    joined = made.join(replies, "block", "left").select(*kept, "at", "times", "n_docs", "is_best")
    kind = joined.schema["keys"].dataType.elementType.simpleString()
    own = [n for n in kept[1:] if n not in ("ends", "groups_sha256", "groups")]
    tail = ["groups_sha256", *(["groups"] if with_groups else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                get = lambda name: b.column(b.schema.get_field_index(name))[row].values  # noqa: B023, E731
                ends, at, times = (get(n).to_numpy() for n in ("ends", "at", "times"))
                if len(at):
                    n_docs, best = get("n_docs").to_numpy(), get("is_best").to_numpy(zero_copy_only=False)
                    sums, bests = _sums(ends, times * n_docs[at]), _sums(ends, times * best[at])
                else:
                    sums = bests = np.zeros(len(ends), np.int64)
                columns = [get("keys"), *[get(n) for n in own], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), *[get(n) for n in tail]]
                yield pa.RecordBatch.from_arrays(columns, names=["k", *own, "n_best", "count_sum", *tail])

    schema = f"k {kind}, " + ", ".join(f"{n} long" for n in [*own, "n_best", "count_sum"]) + "".join(f", {n} string" for n in tail)
    return joined.mapInArrow(run, schema).withColumnRenamed("k", key)
