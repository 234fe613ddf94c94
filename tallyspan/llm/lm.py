"""Language-model scoring with a log-frequency Bloom filter.

Tokens are words after A-Z to a-z, then one end token for each text. Words are
known by a 64-bit hash of their bytes. Counting: every task sends the counts of
its own tokens and word pairs, and Spark adds them up; all training texts take
part.

The model. A count c has the level 1 + floor(log2(c / floor)), and 0 below
``floor``, which is 1 for words and 2 for pairs (a pair seen once says no more
than its words), however large the corpus. A blocked Bloom filter holds
(gram, 1) ... (gram, level) of every gram; a reader probes the levels in turn
until one is missing, and so gets the count to within a factor of two. A level
read too high needs a false positive at the very next level, so errors stay
small. A filter is broadcast and has at most ``MAX_BITS``. If the grams need
more, they are split by hash into parts of that size; each part is broadcast in
a pass of its own over the texts, and the levels that the passes read are put
together for each different text.

The probability of word b after a is w c(a, b) / c(a) + (1 - w) p(b), with counts
read from the filter and p(b) = (c(b) + 0.5) / (N + 0.5 (V + 1)). A token thus
depends on three levels only, and a text on how often each triple of levels
occurs in it. The weight w depends on the level of c(a); it is the best of a
grid for all training texts, whose own pairs are taken out of the counts by one
each (deleted interpolation, so that a pair seen once is no evidence for itself).

The base score is exact: the most frequent tokens (at most 2^17 can make up
2^-17 of all) are broadcast with their counts, and the others meet theirs in a
join, which then has no hot key.

Null texts are empty: one end token. Very long texts and words are hashed whole,
in bounded memory. Ties: of equally good weights the smallest is taken. Repeated
rows are scored and counted each. Without training rows N and V are 0 and all
words are unknown; an empty table gives an empty result. Only the key, the text
and the training condition are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import text_batches
from tallyspan.session import materialize

MAX_BITS = 1 << 29
BITS_PER_ENTRY = 10
PROBES = 5
BLOCK = 512
SEGMENTS = 256
FREQUENT = 1 << 17
#: The least counts of words and of pairs that have a level.
FLOORS = (1, 2)
#: Levels take six bits of a code.
LEVELS = 64
GRID = np.linspace(0, 0.95, 20)
#: Texts are hashed in groups of about so many bytes.
GROUP_BYTES = 1 << 20
FLUSH_TOKENS = 2_000_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all bits before."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_POWERS = np.array([pow(_ODD, i + 1, 1 << 64) for i in range(4096)], np.uint64)
#: The powers of places 4,096 and 2^24 apart, for the coefficients of long words.
_STEPS = tuple(np.array([pow(_ODD, i << shift, 1 << 64) for i in range(4096)], np.uint64) for shift in (12, 24))
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
END = np.uint64(2)
START = np.uint64(4)


def coefficients(place: np.ndarray) -> np.ndarray:
    """A power of its own for each place in a word, however long the word."""
    out = _POWERS[place & 4095]
    far = np.flatnonzero(place > 4095)
    if len(far):
        out[far] *= _STEPS[0][place[far] >> 12 & 4095] * _STEPS[1][place[far] >> 24]
    return out


def hash_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens of the texts in order, tokens of each text); hashes are even numbers."""
    data = np.frombuffer(b" ".join(texts).translate(_LOWER) + b" ", np.uint8)
    space = _SPACE[data]
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    edges = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(begins, edges)
    size = np.diff(upto, prepend=0) + 1
    out = np.full(len(begins) + len(texts), END, np.uint64)
    if len(begins):
        place = np.arange(len(data)) - np.repeat(np.concatenate([[0], begins]), np.diff(np.concatenate([[0], begins, [len(data)]])))
        values = _VALUES[data] * coefficients(place)
        values[space] = 0
        hashed = mix(np.add.reduceat(values, begins) + (ends - begins).astype(np.uint64)) & ~np.uint64(1)
        at = np.ones(len(out), bool)
        at[np.cumsum(size) - 1] = False
        out[at] = hashed
    return out, size


def hash_pairs(tokens: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the token before each token, a hash of both); pair hashes are odd numbers."""
    before = np.concatenate([[START], tokens[:-1]]).astype(np.uint64)
    before[np.concatenate([[0], np.cumsum(size)[:-1]])] = START
    return before, mix(before * np.uint64(_ODD) + mix(tokens + np.uint64(0x5851F42D4C957F2D))) | np.uint64(1)


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, texts as bytes) in groups of about ``GROUP_BYTES``."""
    own: list[bytes] = []
    first = total = 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if own and total + len(b) > GROUP_BYTES:
            yield first, own
            own, first, total = [], i, 0
        own.append(b)
        total += len(b)
    if own:
        yield first, own


def gram_counts(texts: DataFrame, text: str = "text", pairs: bool = True) -> DataFrame:
    """``(h, n)``: counts of all words (even h) and, unless left out, of all word pairs (odd h)."""
    text_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "n"])

        for b in batches:
            for _, own in groups(b.column(0).to_pylist()):
                tokens, size = hash_tokens(own)
                held += [tokens, hash_pairs(tokens, size)[1]] if pairs else [tokens]
                n += (1 + pairs) * len(tokens)
                if n >= FLUSH_TOKENS:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    return texts.select(F.col(text).cast("string")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class LogBloom:
    """Levels of grams in a blocked Bloom filter: every gram has one block for all of its levels."""

    def __init__(self, bits: int, floors: tuple[int, int], data: np.ndarray | None = None):
        self.blocks = bits // BLOCK
        self.floors = floors
        self.data = np.zeros(bits // 8, np.uint8) if data is None else data

    def level(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The level of count ``n`` of each gram."""
        floor = np.where(h & np.uint64(1), self.floors[1], self.floors[0])
        return np.where(n >= floor, np.floor(np.log2(np.maximum(n, 1) / floor)).astype(np.int64) + 1, 0)

    def count(self, h: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The middle of the counts of a level, 0 for level 0."""
        floor = np.where(h & np.uint64(1), self.floors[1], self.floors[0])
        return np.where(level > 0, (1.5 * 2.0 ** (level - 1) - 0.5) * floor, 0.0)

    def block(self, h: np.ndarray) -> np.ndarray:
        return (mix(h * np.uint64(3)) >> np.uint64(11)) % np.uint64(self.blocks)

    @staticmethod
    def places(h: np.ndarray, level: np.ndarray | int) -> list[np.ndarray]:
        """The bits in its block of (gram, level)."""
        x = mix(h + np.uint64(_ODD) * np.asarray(level, np.uint64))
        return [(x >> np.uint64(9 * p)) & np.uint64(BLOCK - 1) for p in range(PROBES)]

    def add(self, h: np.ndarray, n: np.ndarray, first_block: int = 0) -> None:
        level = self.level(h, n)
        for at in range(1, int(level.max(initial=0)) + 1):
            h, level = h[level >= at], level[level >= at]
            base = (self.block(h) - np.uint64(first_block)) * np.uint64(BLOCK)
            for p in self.places(h, at):
                bit = base + p
                np.bitwise_or.at(self.data, bit >> np.uint64(3), np.left_shift(np.uint8(1), (bit & np.uint64(7)).astype(np.uint8)))

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each gram, by probing level after level until one is missing."""
        out = np.zeros(len(h), np.int64)
        live = np.arange(len(h))
        base = self.block(h) * np.uint64(BLOCK)
        at = 1
        while len(live):
            hit = np.ones(len(live), bool)
            for p in self.places(h[live], at):
                bit = base[live] + p
                hit &= (self.data[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            live = live[hit]
            out[live] = at
            at += 1
        return out


def _level_column(floors: tuple[int, int]) -> Column:
    floor = F.when(F.col("h").bitwiseAND(1) == 1, floors[1]).otherwise(floors[0])
    return F.when(F.col("n") >= floor, F.floor(F.log2(F.col("n") / floor)) + 1).otherwise(0)


def _level_counts(counts: DataFrame) -> list:
    """Grams by kind and by floor(log2) of their counts."""
    odd = F.col("h").bitwiseAND(1)
    return counts.groupBy(odd.alias("odd"), F.floor(F.log2("n")).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram when the filter is split."""
    return (mix(h * np.uint64(5)) >> np.uint64(11)) % np.uint64(parts)


def filter_parts(counts: DataFrame, max_bits: int = MAX_BITS) -> int:
    """Filters of ``max_bits`` that all grams with all their levels need."""
    n = sum(r["n"] * max(0, r["l"] - int(math.log2(FLOORS[r["odd"]])) + 1) for r in _level_counts(counts))
    return max(1, math.ceil(n * BITS_PER_ENTRY / max_bits))


def part_counts(counts: DataFrame, part: int, parts: int) -> DataFrame:
    """The grams of one part."""
    if parts == 1:
        return counts

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[part_of(f["h"].to_numpy().view(np.uint64), parts) == part]

    return counts.select("h", "n").mapInPandas(own, "h long, n long")


def build_filter(counts: DataFrame, max_bits: int = MAX_BITS, raise_floors: bool = True) -> LogBloom:
    """The filter of all grams of ``counts``, made in segments by the executors; the driver joins the segments.

    Where they need more than ``max_bits``, floors rise if ``raise_floors``; else ``FLOORS`` hold and grams share bits.
    """
    hist = _level_counts(counts)
    floors = [0, 1]  # as powers of two
    entries = lambda: sum(r["n"] * max(0, r["l"] - floors[r["odd"]] + 1) for r in hist)
    while (n := entries()) * BITS_PER_ENTRY > max_bits and raise_floors:
        own = [sum(r["n"] * (r["l"] >= floors[k]) for r in hist if r["odd"] == k) for k in (0, 1)]
        floors[int(own[1] >= own[0])] += 1
    bits = min(max_bits, max(BLOCK * SEGMENTS, 1 << math.ceil(math.log2(max(1, n * BITS_PER_ENTRY)))))
    made = LogBloom(bits, (2 ** floors[0], 2 ** floors[1]), np.zeros(0, np.uint8))
    share = made.blocks // SEGMENTS

    def marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(seg=(made.block(f["h"].to_numpy().view(np.uint64)) // np.uint64(share)).astype(np.int32))

    def segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = LogBloom(bits, made.floors, np.zeros(share * BLOCK // 8, np.uint8))
        own.add(rows["h"].to_numpy().view(np.uint64), rows["n"].to_numpy(), int(key[0]) * share)
        return pd.DataFrame({"seg": [key[0]], "bits": [own.data.tobytes()]})

    live = counts.filter(_level_column(made.floors) > 0)
    parts = live.mapInPandas(marked, "h long, n long, seg int").groupBy("seg").applyInPandas(segment, "seg int, bits binary")
    data = np.zeros(bits // 8, np.uint8)
    width = share * BLOCK // 8
    for r in parts.toLocalIterator():
        data[r["seg"] * width : (r["seg"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    made.data = data
    return made


def exact_counts(known: np.ndarray, uniq: np.ndarray) -> np.ndarray:
    """The counts of the broadcast tokens (rows of hash and count, in order of hash), 0 for others."""
    if not len(known):
        return np.zeros(len(uniq), np.int64)
    held = known[:, 0].view(np.uint64)
    i = np.minimum(np.searchsorted(held, uniq), len(held) - 1)
    return np.where(held[i] == uniq, known[:, 1][i], 0)


def read_levels(bloom: LogBloom, h: np.ndarray, part: int = 0, parts: int = 1) -> np.ndarray:
    """The levels of grams as one part of the filter tells them, 0 for grams of other parts."""
    if parts == 1:
        return np.minimum(bloom.levels(h), LEVELS - 1).astype(np.uint8)
    out = np.zeros(len(h), np.uint8)
    mine = np.flatnonzero(part_of(h, parts) == part)
    out[mine] = np.minimum(bloom.levels(h[mine]), LEVELS - 1)
    return out


def level_codes(word: np.ndarray, pair: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, times, first code of each text and the end): the triples (context, pair, word level) of each text.

    A text starts where another ended, so its first context is its own end token.
    """
    ends = np.cumsum(size)
    starts = ends - size
    ctx = np.concatenate([[0], word[:-1]]).astype(np.int64)
    ctx[starts] = word[ends - 1]
    code = (ctx * LEVELS + pair) * LEVELS + word
    both, times = np.unique(np.repeat(np.arange(len(size)), size) * LEVELS**3 + code, return_counts=True)
    return (both % LEVELS**3).astype(np.int32), times.astype(np.int32), np.searchsorted(both // LEVELS**3, np.arange(len(size) + 1))


def code_scores(codes: np.ndarray, times: np.ndarray, all_tokens: float) -> np.ndarray:
    """log10 of the probability behind each code, by weights that are best for training tokens with these codes."""
    made = LogBloom(BLOCK, FLOORS)
    level = np.arange(LEVELS)
    of_word, of_pair = (made.count(np.full(LEVELS, k, np.uint64), level) for k in (0, 1))
    gain = np.zeros((LEVELS, len(GRID)))
    for at in range(0, len(codes), 1 << 14):
        c, n = codes[at : at + (1 << 14)], times[at : at + (1 << 14)]
        ctx = c // LEVELS**2
        seen, p1 = of_word[ctx], (of_word[c % LEVELS] + 0.5) / all_tokens
        ratio = np.maximum(np.minimum(of_pair[c // LEVELS % LEVELS], seen) - 1, 0) / np.maximum(seen - 1, 1)
        np.add.at(gain, ctx, n[:, None] * np.log(GRID[None, :] * ratio[:, None] + (1 - GRID[None, :]) * p1[:, None]))
    weights = GRID[gain.argmax(1)]
    weights[0] = 0.0
    seen, both = of_word[:, None], np.minimum(of_pair[None, :], of_word[:, None])
    told = weights[:, None] * both / np.maximum(seen, 1)
    return np.log10(told[:, :, None] + (1 - weights[:, None, None]) * (of_word + 0.5)[None, None, :] / all_tokens).ravel()


def _lists(x: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    return [x[i:j] for i, j in zip(cut, cut[1:], strict=False)]


def part_levels(source: DataFrame, bloom, part: int, parts: int) -> DataFrame:
    """``(digest, levels)``: the levels of all words and then of all pairs of each text, as far as they lie in one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, own in groups(b.column(1).to_pylist()):
                tokens, size = hash_tokens(own)
                uniq, back = np.unique(tokens, return_inverse=True)
                cut = np.concatenate([[0], np.cumsum(size)])
                word = _lists(read_levels(bloom.value, uniq, part, parts)[back], cut)
                pair = _lists(read_levels(bloom.value, hash_pairs(tokens, size)[1], part, parts), cut)
                out += [x.tobytes() + y.tobytes() for x, y in zip(word, pair, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["digest", "levels"])

    return source.select("digest", "__text").mapInArrow(run, "digest string, levels binary")


def split_codes(source: DataFrame, counts: DataFrame, max_bits: int, parts: int) -> DataFrame:
    """``(digest, codes, code_times)`` of each different text, one pass over the texts for each part of the filter."""
    spark = source.sparkSession
    read = None
    for part in range(parts):
        bloom = spark.sparkContext.broadcast(build_filter(part_counts(counts, part, parts), max_bits, raise_floors=False))
        one = materialize(part_levels(source, bloom, part, parts), "lm-levels")
        bloom.destroy()
        read = one if read is None else read.unionAll(one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, times = [], []
            for x in b.column(1):
                both = np.bitwise_or.reduce([np.frombuffer(y.as_py(), np.uint8) for y in x.values])
                n = len(both) // 2
                c, t, _ = level_codes(both[:n], both[n:], np.array([n]))
                codes.append(c)
                times.append(t)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes, kind), pa.array(times, kind)], names=["digest", "codes", "code_times"])

    # copies of a text have equal levels, which the set holds once
    return read.groupBy("digest").agg(F.collect_set("levels").alias("levels")).mapInArrow(run, "digest string, codes array<int>, code_times array<int>")


def code_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(codes, times) over all ``rows (codes, code_times)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(LEVELS**3, np.int64)
        for b in batches:
            np.add.at(held, b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy())
        code = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), pa.array(held[code])], names=["code", "n"])

    sums = rows.select("codes", "code_times").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    both = np.array(sorted((r["code"], r["n"]) for r in sums.collect()), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def score(docs: DataFrame, training: DataFrame | Column, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, base_only: bool = False) -> DataFrame:
    """``(key, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs``.

    ``training`` is a table of its own, or a condition on ``docs``, whose texts are then read once less.
    With ``base_only`` no pairs are counted and no filter is built; ``score`` is null.
    """
    spark = docs.sparkSession
    text_batches(spark)
    within = isinstance(training, Column)
    columns = lambda df, k, live, train: df.select(k.alias(key), live.alias("live"), train.alias("train"), F.col(text).cast("string").alias("__text"))
    source = columns(docs, F.col(key), F.lit(True), F.coalesce(training, F.lit(False)) if within else F.lit(False))
    kind = source.schema[key].dataType.simpleString()
    if not within:
        source = source.unionAll(columns(training, F.lit(None).cast(kind), F.lit(False), F.lit(True)))
    counts = materialize(gram_counts(docs.filter(training) if within else training, text, not base_only).filter("h & 1 = 0 or n > 1"), "lm-counts")
    vocab = counts.filter("h & 1 = 0")
    sums = vocab.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, kinds = sums["n"] or 0, sums["v"]
    floor = total // FREQUENT
    top = vocab.filter(F.col("n") > floor) if total else vocab.limit(0)  # fewer than FREQUENT tokens can be above it
    common = np.array([(r["h"], r["n"]) for r in top.toLocalIterator()], np.int64).reshape(-1, 2)
    common = common[np.argsort(common[:, 0].view(np.uint64))]
    parts = 1 if base_only else filter_parts(counts, max_bits)
    shared = spark.sparkContext.broadcast((build_filter(counts, max_bits, raise_floors=False) if parts == 1 and not base_only else None, common))
    digest = F.md5(F.coalesce(F.col("__text"), F.lit("")).cast("binary")) if parts > 1 else F.lit(None).cast("string")
    source = source.select(key, "live", "train", digest.alias("digest"), "__text")
    all_tokens = total + 0.5 * (kinds + 1)
    all_log = math.log10(all_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, known = shared.value
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for _, own in groups(b.column(4).to_pylist()):
                tokens, size = hash_tokens(own)
                starts = np.concatenate([[0], np.cumsum(size)[:-1]])
                doc = np.repeat(np.arange(len(own)), size)
                uniq, back = np.unique(tokens, return_inverse=True)
                exact = exact_counts(known, uniq)[back]
                base = np.where(exact > 0, np.log10(exact + 0.5), 0.0)
                rare = exact == 0
                code, times = np.unique(doc[rare].astype(np.int64) * len(uniq) + back[rare], return_counts=True)
                cut = np.searchsorted(code // len(uniq), np.arange(len(own) + 1))
                out[0] += size.tolist()
                out[1] += np.add.reduceat((exact > 0).astype(np.int64), starts).tolist()
                out[2] += np.add.reduceat(base, starts).tolist()
                out[3] += _lists(uniq[code % len(uniq)].view(np.int64), cut)
                out[4] += _lists(times.astype(np.int32), cut)
                if bloom is None:
                    out[5] += [None] * len(own)
                    out[6] += [None] * len(own)
                else:
                    codes, n, cut = level_codes(read_levels(bloom, uniq)[back], read_levels(bloom, hash_pairs(tokens, size)[1]), size)
                    out[5] += _lists(codes, cut)
                    out[6] += _lists(n, cut)
            types = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(4)], *[pa.array(c, t) for c, t in zip(out, types, strict=True)]],
                names=[key, "live", "train", "digest", "n_tokens", "known", "base", "rare", "times", "codes", "code_times"],
            )

    schema = f"`{key}` {kind}, live boolean, train boolean, digest string, n_tokens long, known long, base double, rare array<long>, times array<int>, codes array<int>, code_times array<int>"
    read = materialize(source.mapInArrow(run, schema).withColumn("__rid", F.monotonically_increasing_id()), "lm-rows")
    coded = read
    if parts > 1:
        coded = read.drop("codes", "code_times").join(materialize(split_codes(source, counts, max_bits, parts), "lm-codes"), "digest")
    table = None if base_only else spark.sparkContext.broadcast(code_scores(*code_counts(coded.filter("train")), all_tokens))
    rows = read.filter("live")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, n = b.column(4), b.column(5)
            size = np.array([len(x) for x in c], np.int64)
            each = table.value[c.flatten().to_numpy()] * n.flatten().to_numpy()
            sums = np.add.reduceat(each, np.cumsum(size) - size) if len(size) else each
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(4)], b.column(6), pa.array(sums)], names=["__rid", key, "n_tokens", "known", "base", "score"])

    schema = f"__rid long, `{key}` {kind}, n_tokens long, known long, base double, score double"
    if base_only:
        scored = rows.select("__rid", key, "n_tokens", "known", "base", F.lit(None).cast("double").alias("score"))
    else:
        scored = coded.filter("live").select("__rid", key, "n_tokens", "known", "codes", "code_times", "base").mapInArrow(add, schema)
    each = rows.select("__rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("__rid", F.col("x.rare").alias("h"), F.col("x.times").alias("t"))
    met = each.join(vocab, "h", "left").groupBy("__rid").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("t")).otherwise(0)).alias("more"),
        F.sum(F.col("t") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rest"),
    )
    done = scored.join(met, "__rid", "left")
    return done.select(
        key,
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        "score",
    )
