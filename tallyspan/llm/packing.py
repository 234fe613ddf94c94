"""Best-fit packing by a configuration linear program.

Texts become token ids and an end id; only texts above the sequence length are
cut, into full pieces behind a shorter first one. Full pieces fill a sequence
each. All others are counted by length: that histogram has at most
``size - 1`` bins however many documents there are, and it is all that the
plan needs.

The plan is a configuration LP: choose how often each combination of lengths
that fits a sequence is used, so that all pieces are covered with as few
sequences as possible. Multiplicative weights solve it: each round prices the
lengths, knapsack dynamic programs find the combinations of the highest price,
and the prices of lengths rise by the room that their combinations waste. The
solution is rounded to whole sequences, the knapsack makes more of the pieces
left over, and best fit places the last ones; ``solve`` also gives a proven
lower bound.

Ranks within a length come from salted counts, so that a length which a third
of all pieces have is no task of its own.

Null texts are empty and give one piece with only the end id. Very long texts
are encoded whole and cut into pieces of their own. Ties: pieces of equal
length are dealt by a stored random number, so which of them share a sequence
may differ between runs, the number of sequences may not. Repeated rows are
packed as rows of their own. An empty table gives no piece. Only the key and
the text are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import text_batches
from tallyspan.session import materialize

SIZE = 2048
END_ID = 0
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
#: Rows that one rank bucket holds on average, until a length has MAX_BUCKETS buckets; then they grow.
BUCKET_ROWS = 100
MAX_BUCKETS = 1 << 16
#: The power of a length that is its first price.
LONGER = 1.05
#: Shares of the columns, in order of use, that are tried before best fit takes over.
SHARES = (1.0, 0.98, 0.95, 0.9, 0.8)


@lru_cache(1)
def encoder(name: str = "byte_bpe_50k"):
    """ids of a text under the public byte BPE, as ``tokenizers`` gives them.

    The same vocabulary is published as JSON for ``tokenizers`` and as ranks
    for ``tiktoken``; both give equal ids (the tests compare them), and the
    ranks are read here because that encoder takes a quarter of the CPU time.
    The end-of-text mark is one id, as in the JSON's list of added tokens.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL not in text:
            return plain.encode_ordinary(text)
        head, *rest = text.split(SPECIAL)
        ids = plain.encode_ordinary(head)
        for part in rest:
            ids.append(SPECIAL_ID)
            ids += plain.encode_ordinary(part)
        return ids

    return encode


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first may be shorter, all others are full."""
    first = n % size or size
    return [(0, min(first, n)), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """``(key, piece, start, length, ids_crc32[, input_ids])``: the pieces of every row."""
    text_batches(docs.sparkSession)
    source = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("__text"))
    kind = source.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", input_ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for b in batches:
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for n, x in enumerate(b.column(1)):
                own = np.array([*encode(x.as_py() or ""), END_ID], "<u4")
                for p, (s, m) in enumerate(cut(len(own), size)):
                    at.append(n)
                    piece.append(p)
                    start.append(s)
                    length.append(m)
                    crc.append(zlib.crc32(own[s : s + m].tobytes()))
                    if with_ids:
                        ids.append(own[s : s + m].astype(np.int32))
            cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("input_ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return source.mapInArrow(run, schema)


def _knapsack(price: np.ndarray, items: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(highest total price within each capacity, the first length taken there; 0 for none) over the sorted lengths ``items``."""
    best, take = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    worth, upto = price[items], np.searchsorted(items, np.arange(size + 1), "right")
    for c in range(int(items[0]), size + 1):
        k = upto[c]
        gain = worth[:k] + best[c - items[:k]]
        i = int(gain.argmax())
        if gain[i] > best[c - 1]:
            best[c], take[c] = gain[i], items[i]
        else:
            best[c] = best[c - 1]
    return best, take


def _columns(price: np.ndarray, items: np.ndarray, size: int, near: float) -> Iterator[tuple[tuple[int, ...], dict[int, int]]]:
    """The combinations that one knapsack table gives, each with its lengths counted.

    For each length the best one that holds it, as far as its price comes
    within ``near`` of the highest; the highest comes first.
    """
    best, take = _knapsack(price, items, size)
    total = price[items] + best[size - items]
    seen = set()
    for first in items[np.argsort(-total, kind="stable")][: int((total >= (1 - near) * total.max()).sum())]:
        fill, c = [int(first)], size - int(first)
        while c > 0:
            if take[c]:
                fill.append(int(take[c]))
                c -= int(take[c])
            else:
                c -= 1
        key = tuple(sorted(fill, reverse=True))
        if key not in seen:
            seen.add(key)
            yield key, {x: fill.count(x) for x in set(fill)}


def _cover(need: np.ndarray, price: np.ndarray, size: int, near: float, whole: bool) -> tuple[list[tuple[tuple[int, ...], float]], np.ndarray, float]:
    """(columns with their amounts, what is left, highest price of a column while all lengths are there).

    Columns are priced over the lengths that are left and used until one of
    their lengths is used up, so the amounts cover ``need`` exactly; if
    ``whole``, only in whole numbers, which may leave something.
    """
    left, used, top = need.astype(float), [], 0.0
    while len(items := np.flatnonzero(left >= (1 if whole else 1e-9))):
        before = len(used)
        for key, times in _columns(price, items, size, near):
            top = top or sum(price[x] * t for x, t in times.items())
            amount = min(left[x] / t for x, t in times.items())
            if whole:
                amount = float(int(amount))
            if amount > 1e-9:
                used.append((key, amount))
                for x, t in times.items():
                    left[x] -= amount * t
        if len(used) == before:
            break
    return used, left, top


def solve(need: np.ndarray, size: int = SIZE, rounds: int = 12, rate: float = 0.01, near: float = 0.01, gap: float = 0.0005) -> tuple[list[tuple[tuple[int, ...], float]], float]:
    """(columns of the configuration LP with their amounts, a proven lower bound of its value).

    Prices begin a little above proportion to the lengths, so that short pieces
    are kept to fill what long ones leave. In each round the knapsack
    prices columns until all lengths are covered, and the price of a length is
    multiplied by exp(rate * waste), where waste is the share of room that its
    columns leave empty, set against the highest such share. The prices of any round bound the LP from below: no
    column is worth more than the highest, so the worth of all lengths takes at
    least so many. Columns within ``near`` of the highest price are taken
    together, less in later rounds. Rounds end when bound and value are within
    ``gap``.
    """
    items = np.flatnonzero(need)
    price = np.zeros(size + 1)
    price[items] = (items / size) ** LONGER
    best, low = (math.inf, []), float((need * np.arange(size + 1)).sum()) / size
    for r in range(rounds):
        used, _, top = _cover(need, price, size, near / (1 + r), False)
        low = max(low, float((price * need).sum()) / top)
        value = sum(amount for _, amount in used)
        if value < best[0]:
            best = (value, used)
        if best[0] <= low * (1 + gap):
            break
        waste = np.zeros(size + 1)
        for key, amount in used:
            for x in key:
                waste[x] += amount * (1 - sum(key) / size)
        waste[items] /= need[items]
        if not waste.any():
            break
        price[items] *= np.exp(rate / (1 + r / 5) * waste[items] / waste.max())
    return best[1], low


def _best_fit(left: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """Whole runs of equal sequences: the longest piece, then always the longest that still fits."""
    plan = []
    while len(have := np.flatnonzero(left)):
        fill, room, own = [], size, left.copy()
        while room and len(fit := have[: np.searchsorted(have, room, "right")]):
            fit = fit[own[fit] > 0]
            if not len(fit):
                break
            x = int(fit[-1])
            fill.append(x)
            own[x] -= 1
            room -= x
        sizes, uses = np.unique(fill, return_counts=True)
        times = int((left[sizes] // uses).min())
        left[sizes] -= uses * times
        plan.append((fill, times))
    return plan


def _use(left: np.ndarray, chosen: dict[tuple[int, ...], int], key: tuple[int, ...], n: int) -> None:
    """Take ``n`` sequences of ``key``, or as many as the pieces ``left`` allow."""
    lengths, times = np.unique(key, return_counts=True)
    n = min(n, int((left[lengths] // times).min()))
    if n > 0:
        left[lengths] -= times * n
        chosen[key] = chosen.get(key, 0) + n


def _rounded(need: np.ndarray, amounts: dict[tuple[int, ...], float], upto: float) -> tuple[dict[tuple[int, ...], int], np.ndarray]:
    """(whole numbers of sequences of the first columns, ``upto`` in all; what is left): rounded down, then the largest remainders up."""
    left, chosen, taken = need.copy(), {}, []
    for key, amount in amounts.items():
        if upto <= 0:
            break
        taken.append((key, min(amount, upto)))
        upto -= amount
    for key, amount in taken:
        _use(left, chosen, key, int(amount + 1e-6))
    for key, amount in sorted(taken, key=lambda x: (int(x[1] + 1e-6) - x[1], x[0])):
        if amount - int(amount + 1e-6) >= 0.5:
            _use(left, chosen, key, 1)
    return chosen, left


def plan_parts(counts: dict[int, int], size: int = SIZE) -> tuple[list[tuple[list[int], int]], list[tuple[list[int], int]], float]:
    """(sequences from priced columns, sequences from best fit, lower bound); together they cover the histogram exactly.

    The LP's amounts are rounded down, then those with the largest remainders
    up as far as pieces are left; further whole columns are priced for what is
    left then, and best fit places the rest. The last columns of a round are
    made of what others left, so best fit may also take over earlier (``SHARES``);
    the smallest plan wins, the one with most columns of equal ones. Should
    best fit alone need fewer sequences still, it is the plan.
    """
    need = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        need[length] += n
    if not need.any():
        return [], [], 0.0
    used, low = solve(need, size)
    amounts: dict[tuple[int, ...], float] = {}
    for key, amount in used:
        amounts[key] = amounts.get(key, 0.0) + amount
    total = lambda p: sum(n for _, n in p)
    whole, best = sum(amounts.values()), None
    for share in SHARES:
        chosen, left = _rounded(need, amounts, share * whole)
        if share == 1:
            for key, amount in _cover(left, np.arange(size + 1.0), size, 0.0, True)[0]:
                _use(left, chosen, key, int(amount))
        rest = _best_fit(left, size)
        made = [(list(key), n) for key, n in chosen.items()], rest, low
        if best is None or total(made[0]) + total(rest) < total(best[0]) + total(best[1]):
            best = made
    greedy = _best_fit(need.copy(), size)
    return best if total(best[0]) + total(best[1]) <= total(greedy) else ([], greedy, low)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """``[(lengths in one sequence, number of such sequences)]`` covering the histogram exactly."""
    columns, rest, _ = plan_parts(counts, size)
    return columns + rest


def _places(chosen: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted ``length << 40 | first rank`` of each slot, with its first sequence and offset; the number of sequences."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for fill, times in chosen:
        offset = 0
        for x in fill:
            rows.append((x << 40 | used.get(x, 0), base, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), base


def ranked(rows: DataFrame, by: str, order: list[str], counts: dict[int, int]) -> DataFrame:
    """``rows`` with ``__rank``: 0, 1, ... within each value of ``by``.

    A value with n rows is dealt to 1 + n // BUCKET_ROWS buckets (MAX_BUCKETS at
    most) by the stored ``__salt`` in [0, 1); ranks are the bucket's first rank
    and the place in it.
    """
    spark = rows.sparkSession
    salts = spark.createDataFrame([(k, min(MAX_BUCKETS, 1 + n // BUCKET_ROWS)) for k, n in counts.items()], f"`{by}` long, __salts long")
    dealt = rows.join(F.broadcast(salts), by).withColumn("__bucket", F.floor(F.col("__salt") * F.col("__salts"))).drop("__salt", "__salts")
    sizes = dealt.groupBy(by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(by, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    own = F.row_number().over(Window.partitionBy(by, "__bucket").orderBy(*order)) - 1
    numbered = dealt.withColumn("__own", own).join(starts, [by, "__bucket"])
    return numbered.withColumn("__rank", F.col("__first") + F.col("__own")).drop("__first", "__own", "__bucket")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """``(key, piece, start, length, ids_crc32[, input_ids], sequence_id, offset)``: one row per piece.

    The driver holds the length histogram (at most ``size`` numbers) and the
    plan made from it, whose slots are bounded by ``size`` too; both are broadcast.
    """
    spark = docs.sparkSession
    made = materialize(pieces(docs, key, text, size, with_ids).withColumn("__salt", F.rand(7)), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toLocalIterator() if r["length"] < size}
    places = _places(plan(counts, size))
    table = spark.sparkContext.broadcast(places)
    names = [c for c in made.columns if c != "__salt"]
    full = made.filter(F.col("length") == size).select(
        *names, (F.monotonically_increasing_id() + F.lit(places[3])).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema.fields)
    length_at, rank_at = names.index("length"), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, base, offset, _ = table.value
        for b in batches:
            code = b.column(length_at).to_numpy() << 40 | b.column(rank_at).to_numpy()
            i = np.searchsorted(first, code, "right") - 1
            cols = [b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(base[i] + code - first[i]), pa.array(offset[i])], names=[*names, "sequence_id", "offset"])

    short = ranked(made.filter(F.col("length") < size), "length", [key, "piece"], counts)
    return full.unionByName(short.select(*names, F.col("__rank").cast("long")).mapInArrow(run, out))
