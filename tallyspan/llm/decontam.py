"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ from a passage by k = floor(rate * m)
edits. Cut into k + 1 pieces, at least one piece of it must stand unchanged in
any passage within that distance. An Aho-Corasick automaton over all pieces
finds these places in one pass over each text; Myers' bit-parallel algorithm
then gives the exact distance of the best passage around every hit, so nothing
within the budget is missed and nothing beyond it is reported.

Letters of all scripts are lower-cased (those whose lower case is longer stay)
and each white space counts as a space; offsets are code points of the
original text. Null and blank items match
nothing; null texts hold nothing. Very long texts are read whole; memory grows
with one text. Ties: of places of equal distance the first counts. Repeated
documents each give their own result rows; items that share an item_id are one
item with several wordings. An empty table of documents or items gives no row.
Only keys and texts are read (``drop_contaminated`` carries all columns along),
so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyspan.llm.common import filter_texts, text_batches
from tallyspan.session import materialize

RATE = 0.05
#: Characters of items that one pass over the texts holds in its automaton; more items mean more passes.
BLOCK_CHARS = 2_000_000
_SPACES = "\t\n\x0b\x0c\r\x85\xa0"


def fold_text(text: str) -> str:
    """Case and white space folded, one character for each character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for c in _SPACES:
        if c in low:
            low = low.replace(c, " ")
    return low


def pieces(item: str, rate: float = RATE) -> tuple[int, list[tuple[int, str]]]:
    """(error budget, [(start, piece)]): budget + 1 pieces of nearly equal length."""
    k = int(len(item) * rate)
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, limit: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of ``pattern`` in ``text``, the first of equals; None above ``limit``."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score, best, end = full, 0, m, limit + 1, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp, hn = vn | (~(d0 | vp) & full), vp & d0
        score += bool(hp & top) - bool(hn & top)
        hp, hn = hp << 1 & full, hn << 1 & full
        vp, vn = hn | (~(d0 | hp) & full), hp & d0
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= limit else None


class Matcher:
    """Finds every item within its error budget in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items = [(i, t, *pieces(t, rate)) for i, x in items if x and (t := fold_text(x).strip(" "))]
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for n, (_, _, _, cut) in enumerate(self.items):
            for start, piece in cut:
                by_piece.setdefault(piece, []).append((n, start))
        self.auto = ahocorasick.Automaton()
        for piece, places in by_piece.items():
            self.auto.add_word(piece, (len(piece), places))
        if by_piece:
            self.auto.make_automaton()
        self.empty = not by_piece

    def find(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best passage in each group of overlapping hits."""
        if self.empty or not text:
            return
        flat = fold_text(text)
        hits: dict[int, set[int]] = {}
        for last, (size, places) in self.auto.iter(flat):
            for n, start in places:
                hits.setdefault(n, set()).add(last + 1 - size - start)
        for n, starts in sorted(hits.items()):
            item_id, item, k, _ = self.items[n]
            spans: list[list[int]] = []
            for s in sorted(starts):
                lo, hi = max(0, s - k), min(len(flat), s + len(item) + k)
                if spans and lo <= spans[-1][1] - len(item):
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
            for lo, hi in spans:
                if exact := flat.find(item, lo, hi) + 1:
                    yield item_id, 0, exact - 1, exact - 1 + len(item)
                elif got := myers(item, flat[lo:hi], k):
                    end = lo + got[1]
                    size = myers(item[::-1], flat[max(lo, end - len(item) - k) : end][::-1], k)[1]
                    yield item_id, got[0], end - size, end


def item_blocks(items: DataFrame, key: str, text: str, block_chars: int) -> Iterator[tuple[bool, list[tuple]]]:
    """(whether it is the last, the items of a block): about ``block_chars`` characters each, one block in the driver at a time."""
    n = items.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    count = 1 + n // block_chars
    for b in range(count):
        part = items if count == 1 else items.filter(F.pmod(F.xxhash64(key), F.lit(2 * count)).isin(2 * b, 2 * b + 1))
        yield b == count - 1, [(r[0], r[1]) for r in part.select(key, text).orderBy(key, text).toLocalIterator()]


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(key, item_id, n_places, distance, start, end)``: every item within its budget in every text.

    One row for each document row and item; the distance and offsets are those
    of the best place, the first of equals. Documents without one give no row.
    """
    spark = docs.sparkSession
    text_batches(spark)
    source = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("__text"))
    kind = source.schema[key].dataType.simpleString()
    own = items.schema[item_key].dataType
    schema = f"`{key}` {kind}, item_id {own.simpleString()}, n_places int, distance int, start int, end int"
    item_kind, out = to_arrow_type(own), None
    blocks = item_blocks(items, item_key, item_text, block_chars)
    for last, block in blocks:
        matcher = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], block=matcher) -> Iterator[pa.RecordBatch]:
            found = Matcher(block.value, rate)
            for b in batches:
                rows: list[tuple] = []
                for n, x in enumerate(b.column(1)):
                    best: dict[int, list] = {}
                    for item, distance, start, end in found.find(x.as_py()):
                        old = best.get(item)
                        if old is None:
                            best[item] = [1, distance, start, end]
                        else:
                            old[0] += 1
                            if distance < old[1]:
                                old[1:] = [distance, start, end]
                    rows += [(n, item, *v) for item, v in best.items()]
                cols = list(zip(*rows, strict=True)) if rows else [()] * 6
                kinds = [item_kind, *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(cols[0], pa.int64())), *[pa.array(c, t) for c, t in zip(cols[1:], kinds, strict=True)]],
                    names=[key, "item_id", "n_places", "distance", "start", "end"],
                )

        part = source.mapInArrow(run, schema)
        if not last or out is not None:  # several blocks: one at a time in memory
            part = materialize(part, "decontam")
            matcher.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``docs`` without the rows whose text holds an item within its budget."""
    for _, block in item_blocks(items, item_key, item_text, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        held: list[Matcher] = []

        def keep(texts: list[str | None], shared=shared, held=held) -> list[bool]:
            if not held:
                held.append(Matcher(shared.value, rate))
            return [next(held[0].find(t), None) is None for t in texts]

        docs = filter_texts(docs, keep, text)
    return docs
