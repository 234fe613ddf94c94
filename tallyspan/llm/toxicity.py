"""Toxicity by compression distance between two zstandard dictionaries.

Learning. A bounded sample of labelled rows is thinned to one text of each
group of near copies (texts with the same least hash of their three-word
shingles). The calibration is cross-fitted: each fifth of the sample is scored
with dictionaries that the other four fifths trained, so that no text
calibrates what it helped to train; the dictionaries in use come from all of it.

zstandard trains the ordinary dictionary on word windows of ordinary texts.
Toxic texts share most of their wording with ordinary ones, so a dictionary
trained on them whole learns the language and not the toxicity (README has the
figures). The toxic dictionary is therefore trained on contrast samples: of
each toxic text, the stretches made of byte grams that stand in more toxic than
ordinary texts, by a likelihood ratio beyond what chance shows among all grams
seen and by a factor of ``LEAST_LIFT`` at least. It extends the ordinary one,
so that what both hold costs the same with both.

Scoring. A text is cut at word borders into windows of ``WINDOW`` words. Each
is compressed with both dictionaries; the gain is how many bytes the toxic one
saves. A logistic curve over the number, density and size of the gains gives
the probability; the windows are those of the whole text, whatever its length.

Null texts, empty texts and texts without letters have no window and get the
curve's value at no gain, as do texts without a gain. Very long texts take
time in proportion and memory for one text. Ties: equal texts get equal scores,
repeated rows too; of near copies in the sample the text first in order stands
for all. An empty table gives an empty result. Without labelled rows of both
kinds every score is the share of toxic rows (0 without any label). Only the
key, the text and the label are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import filter_texts, map_texts, text_batches
from tallyspan.session import materialize

#: Labelled rows of each kind that training takes, chosen by a hash of the id.
TOXIC_DOCS, ORDINARY_DOCS = 4_000, 12_000
#: Words of a window, bytes of a gram, and bytes that the dictionaries may have.
WINDOW, GRAM = 8, 6
ORDINARY_BYTES, TOXIC_BYTES = 1 << 15, 1 << 12
#: Windows of ordinary texts that train their dictionary.
TRAIN_WINDOWS = 80_000
#: A gram of the toxic samples must be so many times as frequent in toxic texts.
LEAST_LIFT = 4.0
MIN_DOCS = 4
#: Bytes of marked stretches that make a text a contrast sample.
LEAST_SAMPLE = 16
#: Parts of the sample for the cross-fitted calibration.
FOLDS = 5
LEVEL = 3
GAINS = (2, 3, 4, 5)
_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
#: The end of a trained dictionary's header (its three repeat offsets), behind which its content stands.
_HEADER_END = b"\1\0\0\0\4\0\0\0\x08\0\0\0"


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters; every byte outside ASCII counts as a letter."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def windows(own: list[bytes], size: int = WINDOW) -> list[bytes]:
    """The windows of a text, end to end; no word is cut."""
    return [b" %s " % b" ".join(own[i : i + size]) for i in range(0, len(own), size)]


def grams(word: bytes) -> list[bytes]:
    """The byte grams of a word with its borders; a shorter word is its own gram."""
    w = b" %s " % word
    return [w[i : i + GRAM] for i in range(max(1, len(w) - GRAM + 1))]


def stretches(own: list[bytes], marked: frozenset[bytes]) -> bytes:
    """The parts of a text's words that consist of marked grams, one after the other."""
    out = []
    for word in own:
        w, end = b" %s " % word, 0
        for i, g in enumerate(grams(word)):
            if g in marked:
                out.append(w[max(i, end) : i + GRAM])
                end = i + GRAM
    return b"".join(out)


def least_shingle(own: list[bytes]) -> int:
    """The least checksum of the three-word shingles; near copies mostly share it."""
    return min((zlib.crc32(b" ".join(own[i : i + 3])) for i in range(max(1, len(own) - 2))), default=0)


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary that zstandard trains on ``samples``; empty if they are too few for it."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes().split(_HEADER_END, 1)[-1]
    except zstandard.ZstdError:
        return b""


@dataclass
class CompressionModel:
    """Two dictionaries and the calibration of their gains."""

    ordinary: bytes
    toxic: bytes
    weights: list[float] = field(default_factory=list)
    prior: float = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def gains(self, own: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window of a text."""
        if not hasattr(self, "_pair"):
            self._pair = []
            for content in (self.ordinary, self.ordinary + self.toxic):
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=LEVEL)
                self._pair.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        plain, extended = self._pair
        return np.array([len(plain(w)) - len(extended(w)) for w in windows(own)], np.int64)

    def features(self, text: str | None) -> list[float]:
        """Number, density and size of the gains of one text."""
        own = self.gains(words(text)) if self.toxic else np.empty(0)
        if not len(own):
            own = np.zeros(1)
        out = [1.0]
        for g in GAINS:
            n = int((own >= g).sum())
            out += [math.log1p(n), math.log1p(1000 * n / len(own))]
        top = np.minimum(np.sort(own)[-3:], 15)
        return [*out, float(top[-1]) / 5, float(top.sum()) / 15]

    def probability(self, features: list[float]) -> float:
        if not self.weights:
            return self.prior
        x = sum(a * b for a, b in zip(self.weights, features, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 40) -> list[float]:
    """Weights of a ridge-penalised logistic curve by Newton's method; the first column is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        move = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), grad)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return [float(v) for v in w]


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, toxic_docs: int, ordinary_docs: int) -> DataFrame:
    """``(text, toxic, shingle)``: about so many rows of each kind, of near copies one; the labels taken are few, and broadcast."""
    own = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in own.filter("toxic in (0, 1)").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = F.pmod(F.xxhash64(key), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.when(F.col("toxic") == 1, toxic_docs / max(1, n.get(1, 0))).when(F.col("toxic") == 0, ordinary_docs / max(1, n.get(0, 0))).otherwise(0.0)
    taken = own.filter(pick < share)
    joined = docs.select(F.col(key), F.col(text).cast("string").alias("text")).filter("text is not null").join(F.broadcast(taken), key)
    marked = map_texts(joined, lambda texts: {"shingle": [least_shingle(words(t)) for t in texts]}, "shingle long", ["toxic", "text"])
    return marked.groupBy("shingle", "toxic").agg(F.min("text").alias("text")).select("text", "toxic", "shingle")


def gram_counts(sample: DataFrame) -> DataFrame:
    """``(gram, fold, a, b)``: the toxic and the ordinary texts of each fold that hold each byte gram."""
    text_batches(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, int], list[int]] = {}
        for b in batches:
            for t, y, f in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for g in {g for w in set(words(t.as_py())) for g in grams(w)}:
                    seen.setdefault((g, f), [0, 0])[y] += 1
        cols = [pa.array([k[0] for k in seen], pa.binary()), pa.array([k[1] for k in seen], pa.int32()), *(pa.array([v[y] for v in seen.values()], pa.int64()) for y in (1, 0))]
        yield pa.RecordBatch.from_arrays(cols, names=["gram", "fold", "a", "b"])

    found = sample.select("text", "toxic", "fold").mapInArrow(run, "gram binary, fold int, a long, b long")
    return found.groupBy("gram", "fold").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def marked_grams(counts: DataFrame, sizes: dict[int, tuple[int, int]], without: list[int]) -> list[frozenset[bytes]]:
    """For each fold left out, the grams that stand in more toxic texts of the others than chance allows.

    ``sizes`` holds the ordinary and the toxic texts of each fold; -1 leaves
    out none. Marked grams are few of all grams of the bounded sample.
    """
    x = lambda c: F.when(c > 0, c * F.log(c)).otherwise(0.0)
    each = [F.sum(F.when(F.col("fold") != k, F.col(c)).otherwise(0)).cast("double").alias(f"{c}{i}") for i, k in enumerate(without) for c in "ab"]
    wide = counts.groupBy("gram").agg(*each)
    limit = 2 * math.log(max(2, wide.count()))
    flags = []
    for i, k in enumerate(without):
        ordinary, toxic = (float(sum(n[y] for f, n in sizes.items() if f != k)) for y in (0, 1))
        n, a, b = toxic + ordinary, F.col(f"a{i}"), F.col(f"b{i}")
        if not toxic or not ordinary:
            flags.append(F.lit(False))
            continue
        inner = x(a) + x(b) + x(toxic - a) + x(ordinary - b)
        margins = x(a + b) + x(n - a - b) + F.lit(toxic * math.log(toxic) + ordinary * math.log(ordinary) - n * math.log(n))
        lift = (a + 0.5) / (toxic + 1) * (ordinary + 1) / (b + 0.5)
        flags.append((a + b >= MIN_DOCS) & (lift >= LEAST_LIFT) & (2 * (inner - margins) > limit))
    found = wide.select("gram", F.array(*flags).alias("in")).filter(F.array_contains("in", True))
    rows = [(bytes(r["gram"]), r["in"]) for r in found.toLocalIterator()]
    return [frozenset(g for g, own in rows if own[i]) for i in range(len(without))]


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    toxic_docs: int = TOXIC_DOCS,
    ordinary_docs: int = ORDINARY_DOCS,
) -> CompressionModel:
    """Dictionaries and calibration from a bounded sample of labelled rows.

    The driver holds about ``TRAIN_WINDOWS`` windows and the marked stretches
    of the sample's toxic texts, which zstandard trains on.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, key, text, label, toxic_docs, ordinary_docs)
    sample = materialize(sample.withColumn("fold", F.pmod(F.hash("shingle"), F.lit(FOLDS)).cast("int")), "toxic-sample")
    sizes: dict[int, tuple[int, int]] = {f: (0, 0) for f in range(FOLDS)}
    for r in sample.groupBy("fold").agg(F.count_if(F.col("toxic") == 0).alias("o"), F.count_if(F.col("toxic") == 1).alias("t")).collect():
        sizes[r["fold"]] = (r["o"], r["t"])
    both = [sum(n[y] for n in sizes.values()) for y in (0, 1)]
    if not all(both):
        return CompressionModel(b"", b"", [], float(both[1] > 0))
    without = [*range(FOLDS), -1]
    marked = spark.sparkContext.broadcast(marked_grams(materialize(gram_counts(sample), "toxic-grams"), sizes, without))
    toxic = map_texts(sample.filter("toxic = 1"), lambda texts: {"s": [[stretches(own, m) for m in marked.value] for own in map(words, texts)]}, "s array<binary>", ["fold", "shingle"])
    toxic = sorted((r["shingle"], r["fold"], [bytes(s) for s in r["s"]]) for r in toxic.toLocalIterator())
    each = max(1, TRAIN_WINDOWS // both[0])

    def some(texts: list[str | None]) -> dict[str, list]:
        out = []
        for t in texts:
            own = windows(words(t))
            out.append(random.Random(len(own)).sample(own, min(each, len(own))))
        return {"w": out}

    plain = map_texts(sample.filter("toxic = 0"), some, "w array<binary>", ["fold", "shingle"])
    plain = sorted((r["shingle"], r["fold"], [bytes(w) for w in r["w"]]) for r in plain.toLocalIterator())
    models = []
    for i, k in enumerate(without):
        contrast = [s[i] for _, f, s in toxic if f != k and len(s[i]) >= LEAST_SAMPLE]
        ordinary = trained([w for _, f, ws in plain if f != k for w in ws], ORDINARY_BYTES, 32)
        # zstandard takes no fewer samples than it needs for statistics; so few stretches are the dictionary themselves
        models.append(CompressionModel(ordinary, trained(contrast, TOXIC_BYTES, 16) or b"".join(contrast)[:TOXIC_BYTES]))
    shared = spark.sparkContext.broadcast(models)
    rows = sample.select("text", F.struct("fold", "toxic", "shingle").alias("k"), "fold")

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [shared.value[f].features(t) for t, f in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.list_(pa.float64()))], names=["k", "x"])

    seen = sorted((tuple(r["k"]), r["x"]) for r in rows.mapInArrow(held_out, "k struct<fold:int,toxic:int,shingle:bigint>, x array<double>").toLocalIterator())
    y = np.array([k[1] for k, _ in seen], float)
    model = models[-1]
    model.weights = fit_logistic(np.array([x for _, x in seen]), y)
    model.prior = float(y.mean())
    true = labels.filter(F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"]
    # the sample thins the kinds unevenly; the intercept takes the true share back in
    shift = lambda p: math.log(p / (1 - p))
    if 0 < true < 1:
        model.weights[0] += shift(true) - shift(model.prior)
    return model


def score(docs: DataFrame, model: CompressionModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, n_toxic_windows)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(texts: list[str | None]) -> dict[str, list]:
        own = shared.value
        made = [own.features(t) for t in texts]
        return {"score": [own.probability(x) for x in made], "n_toxic_windows": [round(math.expm1(x[3])) for x in made]}

    return map_texts(docs, kernel, "score double, n_toxic_windows long", [key], text)


def drop_toxic(docs: DataFrame, model: CompressionModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_texts(docs, lambda texts: [shared.value.probability(shared.value.features(t)) < threshold for t in texts], text)
