"""License scans: exact phrases and an exact set-similarity join with license texts.

Words are runs of ASCII letters and digits (A-Z lower-cased) and all other
non-ASCII characters. Phrases are found word by word in the whole text.

The join. Blocks are half-overlapping windows over the words of the whole text;
line ends are no border. A template of n words may be spread over a passage of
twice as many; its blocks are windows of twice such a passage (rounded up to a
power of two, so that templates of like size share theirs), hence every passage
lies whole in some block, however long the text. A block matches a template
when it holds at least ``THRESHOLD`` of the template's distinct words. Tokens
are put in one global order, rarest in the corpus first. With
a = ceil(THRESHOLD * |T|), a match must share one of the first |T| - a + 1
tokens of the template (prefix filter), have a tokens at least (length filter),
and be able to reach a tokens from the place of the first shared one on
(positional filter). What is left is compared in full, so the join is exact.
The templates are fixed, hence their index is a small constant and is
broadcast; blocks are exploded into their prefix tokens only.

Null and empty texts have no words and no labels. Ties: blocks of equal
containment count once, by their highest; labels are sorted. Repeated rows give
equal rows of their own; an empty table gives an empty result. Only the key and
the text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import text_batches
from tallyspan.session import materialize

#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Well-known license wording, and labels of our own for it.
TEMPLATES = {
    "mit-notice": "Released under the MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software"
    ),
    "mit-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-grant": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or any later version"
    ),
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. "
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "bsd-3-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
}
THRESHOLD = 0.8
#: A template may be spread over so many words at least.
LEAST_PASSAGE = 16
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(data: bytes) -> list[bytes]:
    return _WORD.findall(data.translate(_LOWER))


def template_sets(templates: dict[str, str] = TEMPLATES) -> dict[str, frozenset[bytes]]:
    return {k: frozenset(words(v.encode())) for k, v in templates.items()}


def needed(size: int, threshold: float) -> int:
    """Tokens that a block must share with a template of ``size`` tokens."""
    return max(1, math.ceil(threshold * size - 1e-9))


def phrase_places(own: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    out = []
    for phrase, label in PHRASES.items():
        want = phrase.encode().split()
        at = -1
        while True:
            try:
                at = own.index(want[0], at + 1)
            except ValueError:
                break
            if own[at : at + len(want)] == want:
                out.append((at, label))
    return sorted(out)


def passage(words_of: int) -> int:
    """The longest run of words that a template of so many may be spread over: twice as many, rounded up to a power of two."""
    return max(LEAST_PASSAGE, 1 << (2 * words_of - 1).bit_length())


def size_classes(templates: dict[str, str] = TEMPLATES) -> dict[int, dict[str, str]]:
    """The templates by the passage that they may be spread over."""
    out: dict[int, dict[str, str]] = {}
    for name, text in templates.items():
        out.setdefault(passage(len(words(text.encode()))), {})[name] = text
    return out


def windows(own: list[bytes], half: int) -> Iterator[list[bytes]]:
    """Half-overlapping windows of 2 * ``half`` words; each run of ``half`` words lies whole in one of them."""
    for at in range(0, max(1, len(own) - half), half):
        yield own[at : at + 2 * half]


def vocabulary(templates: dict[str, str] = TEMPLATES) -> dict[bytes, int]:
    """A number for each word of the templates."""
    return {w: i for i, w in enumerate(sorted(set().union(*template_sets(templates).values())))}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base_labels, blocks)``; a block is ``(half, tokens)``: half its window, and the numbers of the words it shares with templates of that passage."""
    text_batches(docs.sparkSession)
    vocab = vocabulary(templates)
    classes = []
    for half, own in sorted(size_classes(templates).items()):
        sets = template_sets(own)
        classes.append((half, frozenset().union(*sets.values()), min(needed(len(x), threshold) for x in sets.values())))
    source = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("__text"))
    kind = source.schema[key].dataType.simpleString()
    starts = {p.split()[0].encode() for p in PHRASES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, base, first, last, labels, found = [], [], [], [], [], []
            for x in b.column(1):
                data = (x.as_py() or "").encode("utf-8", "surrogatepass").translate(_LOWER)
                own = _WORD.findall(data)
                places = phrase_places(own) if any(s in data for s in starts) else []
                n.append(len(own))
                base.append(len(places))
                first.append(places[0][0] if places else None)
                last.append(places[-1][0] if places else None)
                labels.append(sorted({label for _, label in places}))
                held, all_words = [], set(own)
                for half, known, least in classes:
                    if len(known & all_words) >= least:
                        hits = (known.intersection(block) for block in windows(own, half))
                        held += [{"half": half, "tokens": sorted(vocab[w] for w in h)} for h in hits if len(h) >= least]
                found.append(held)
            block = pa.struct([("half", pa.int32()), ("tokens", pa.list_(pa.int32()))])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(block)]
            cols = [pa.array(c, t) for c, t in zip((n, base, first, last, labels, found), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[key, "n_words", "n_base", "first_word", "last_word", "base", "blocks"])

    return source.mapInArrow(run, f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base array<string>, blocks array<struct<half:int,tokens:array<int>>>")


def similarity_join(rows: DataFrame, row: str, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(row, template, containment)`` of all matching blocks of ``rows (row, blocks)``."""
    spark = rows.sparkSession
    vocab = vocabulary(templates)
    each = rows.select(row, F.posexplode("blocks").alias("block", "b")).select(row, "block", "b.half", "b.tokens")
    counted = {r["token"]: r["n"] for r in each.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    rank = {t: i for i, t in enumerate(sorted(vocab.values(), key=lambda t: (counted.get(t, 0), t)))}
    index, full, least = [], [], {}
    for half, own in sorted(size_classes(templates).items()):
        for name, tokens in sorted(template_sets(own).items()):
            order = sorted(rank[vocab[w]] for w in tokens)
            a = needed(len(order), threshold)
            least[half] = min(least.get(half, a), a)
            index += [(token, half, name, i, len(order), a) for i, token in enumerate(order[: len(order) - a + 1])]
            full.append((name, order))
    index = spark.createDataFrame(index, "token int, half int, template string, i int, size int, need int")
    full = spark.createDataFrame(full, "template string, words array<int>")
    ranks = F.create_map(*[F.lit(x) for pair in sorted(rank.items()) for x in pair])
    fewest = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
    ordered = each.withColumn("own", F.array_sort(F.transform("tokens", lambda t: F.element_at(ranks, t)))).drop("tokens")
    prefix = ordered.select(row, "half", "own", F.posexplode(F.slice("own", 1, F.size("own") - F.element_at(fewest, F.col("half")) + 1)).alias("j", "token"))
    reach = 1 + F.least(F.col("size") - F.col("i") - 1, F.size("own") - F.col("j") - 1)
    pairs = prefix.join(F.broadcast(index), ["token", "half"]).filter((F.size("own") >= F.col("need")) & (reach >= F.col("need")))
    pairs = pairs.select(row, "own", "template", "size", "need").join(F.broadcast(full), "template")
    hit = pairs.withColumn("shared", F.size(F.array_intersect("own", "words"))).filter("shared >= need")
    return hit.groupBy(row, "template").agg(F.max(F.col("shared") / F.col("size")).alias("containment"))


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base, found, containment)``, one row per row of ``docs``."""
    made = materialize(scan(docs, key, text, templates, threshold).withColumn("__row", F.monotonically_increasing_id()), "license")
    matched = similarity_join(made.filter(F.size("blocks") > 0).select("__row", "blocks"), "__row", templates, threshold)
    per_row = matched.groupBy("__row").agg(F.collect_set("template").alias("found"), F.max("containment").alias("containment"))
    out = made.drop("blocks").join(per_row, "__row", "left").drop("__row")
    none = F.array().cast("array<string>")
    return out.withColumn("found", F.array_sort(F.coalesce("found", none))).withColumn("containment", F.coalesce("containment", F.lit(0.0)))
