"""Language identification by prediction by partial matching.

For each language a byte context tree of order ``ORDER`` is counted once and
then frozen. A byte costs -log2 of its probability in the longest context that
was seen; contexts that never saw the byte pay their escape probability and
hand down to the next shorter one, to the uniform distribution over all 256
bytes at last (escapes of method C: distinct symbols against all). The language
of the shortest code wins. Order and alphabet are the same whatever the number
of languages; A-Z count as a-z.

The trees are kept sparsely: for each order the sorted grams that any language
has seen, with their costs under all languages, so their size follows the
bounded training sample and not the alphabet. Scoring looks up each byte with
its context and goes down only where no language has seen it.

Training takes about ``sample_docs`` different texts of each language by a hash
of the text, at least one: the bounded, documented sample. Null texts and texts
without a letter are ``und`` with score 0, as is everything if nothing can be
learned. Very long texts are read whole, a part at a time. Ties between
languages go to the first in alphabetical order. Repeated rows get equal
results; in training they count once. An empty table gives an empty result.
Only key, language and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import map_texts, text_batches

SAMPLE_DOCS = 400
ORDER = 3
#: Bytes of a text that are looked up together.
PART = 1 << 16
_LETTER = re.compile(r"[^\W\d_]")
_PAD = b"   "
_TEMPER = 0.05


def sample(docs: DataFrame, lang: str, text: str, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` different texts of each language, those of the least hashes; at least one."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"))
    known = known.withColumn("h", F.xxhash64("text"))
    pick = lambda h: F.pmod(h, F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = known.groupBy("lang").agg((F.lit(float(sample_docs)) / F.approx_count_distinct("h")).alias("share"), F.min_by("h", pick(F.col("h"))).alias("least"))
    taken = known.join(F.broadcast(share), "lang").filter((pick(F.col("h")) < F.col("share")) | (F.col("h") == F.col("least")))
    return taken.dropDuplicates(["lang", "h"]).select("lang", "text")


def gram_counts(texts: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: how often each byte stands behind its three bytes of context; a text begins behind three spaces."""
    text_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(0).to_pylist()
            for lang in sorted(set(langs)):
                own = [x.as_py().encode("utf-8", "surrogatepass").lower() for at, x in zip(langs, b.column(1), strict=True) if at == lang]
                gram, n = np.unique(np.concatenate([windows(t) for t in own]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return texts.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def windows(data: bytes) -> np.ndarray:
    """Each byte of a text behind its three bytes of context, as one number."""
    raw = np.frombuffer(_PAD + data, np.uint8).astype(np.uint32)
    return raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]


class ContextTree:
    """The frozen costs of all languages, for each order over the grams and contexts that were seen."""

    def __init__(self, counts: list[tuple[str, int, int]], order: int = ORDER):
        self.langs = sorted({x[0] for x in counts})
        self.rows = [(self.langs.index(a), g, n) for a, g, n in counts]
        self.order = order
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"levels": None}

    def build(self) -> None:
        """Costs of all orders; done once in each worker."""
        lang, gram, n = (np.array(x, np.int64) for x in zip(*self.rows, strict=True))
        self.levels = []
        for order in range(self.order + 1):
            keys, at = np.unique(gram & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            seen = np.zeros((len(keys), len(self.langs)))
            np.add.at(seen, (at, lang), n)
            contexts, own = np.unique(keys >> 8, return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(self.langs)))
            np.add.at(total, own, seen)
            np.add.at(kinds, own, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                all_bits = np.log2(total + kinds)
                escape = np.where(total > 0, all_bits - np.log2(kinds), 0.0)
                lower = 8.0 if not order else self.levels[-1][1][np.searchsorted(self.levels[-1][0], keys & ((1 << 8 * order) - 1))]
                cost = np.where(seen > 0, all_bits[own] - np.log2(seen), escape[own] + lower)
            self.levels.append((keys, cost.astype(np.float32), contexts, escape.astype(np.float32)))

    def costs(self, gram: np.ndarray) -> np.ndarray:
        """Bits of each byte (rows) in its context under each language (columns)."""
        out = np.zeros((len(gram), len(self.langs)), np.float32)
        live = np.arange(len(gram))
        for order in range(self.order, -1, -1):
            keys, cost, contexts, escape = self.levels[order]
            own = gram[live] & np.uint32((1 << 8 * (order + 1)) - 1)
            i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[i] == own
            if order == self.order and hit.all():
                return cost[i]
            out[live[hit]] += cost[i[hit]]
            live, own = live[~hit], own[~hit] >> np.uint32(8)
            if not len(live):
                break
            i = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            known = contexts[i] == own
            out[live[known]] += escape[i[known]]
        out[live] += np.float32(8)
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) under each language (columns)."""
        if self.levels is None:
            self.build()
            for k, (keys, cost, contexts, escape) in enumerate(self.levels):
                self.levels[k] = (keys.astype(np.uint32), cost, contexts.astype(np.uint32), escape)
        out = np.zeros((len(texts), len(self.langs)))
        for k, t in enumerate(texts):
            gram = windows(t.lower())
            for at in range(0, len(gram), PART):
                out[k] += self.costs(gram[at : at + PART]).sum(0, dtype=np.float64)
        return out


def train(docs: DataFrame, lang: str = "lang", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> ContextTree:
    """The context trees of all languages of ``docs``; the driver gets the grams of the bounded sample only."""
    rows = gram_counts(sample(docs, lang, text, sample_docs)).toLocalIterator()
    return ContextTree(sorted((r["lang"], r["gram"], r["n"]) for r in rows))


def identify(docs: DataFrame, model: ContextTree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score, bits)``: the language of the shortest code, its share of belief, its code length."""
    tree = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(texts: list[str | None]) -> dict[str, list]:
        own = tree.value
        live = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if own.langs else []
        langs, score, bits = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
        if live:
            cost = own.bits([texts[i].encode("utf-8", "surrogatepass") for i in live])
            best = cost.argmin(1)
            belief = np.exp2(_TEMPER * (cost.min(1, keepdims=True) - cost))
            belief /= belief.sum(1, keepdims=True)
            for n, i in enumerate(live):
                langs[i], score[i], bits[i] = own.langs[best[n]], float(belief[n, best[n]]), float(cost[n, best[n]])
        return {"lang_pred": langs, "score": score, "bits": bits}

    return map_texts(docs, kernel, "lang_pred string, score double, bits double", [key], text)
