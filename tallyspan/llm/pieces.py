"""SentencePiece encoding and decoding by vectorised merge rounds.

A byte-pair model of the sentencepiece library merges, again and again, the
pair of neighbouring symbols whose joined piece has the best score, the
leftmost of equals. Here all words of a batch lie in flat numpy arrays. A round
takes the least pair rank of each word by a segmented minimum, merges its
leftmost places that don't overlap at the same time, and compacts the arrays,
until no word holds a pair. Places of one word are merged together only where
none of the pairs they bring has a rank as good as theirs; otherwise the round
merges the first alone. So the result is that of merging one by one.

Words end where no piece of the vocabulary goes on: before a space mark that
follows another character (if no piece holds such a place), and within a word
between characters that stand side by side in no piece. Characters without a
piece become the ids of their UTF-8 bytes.

Nulls and empty texts have no ids and decode to the empty text. Very long texts
are read whole; memory grows with one text (some 200 bytes a character of a
text without spaces). Ties of score go to the left. Repeated documents give
their row again; an empty table gives none. Only key and text are read, so
other columns may have any name. A model with another algorithm, a normaliser
of its own, user-defined or unused pieces, or no byte pieces is refused by a
``ValueError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyspan.llm.common import map_texts

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Surface of the unknown id, as the library prints it.
UNKNOWN = " ⁇ "
#: Characters (or ids) that one numpy pass holds, texts and words being whole.
CHUNK = 1 << 20
#: Ids of remembered words in a worker; beyond it the memory starts anew.
REMEMBERED = 1 << 22
_NONE = np.iinfo(np.int32).max
_SHIFT = 21


class ByteTable:
    """A byte string for each id; looks many of them up at once."""

    def __init__(self, entries: list[bytes]):
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def gather(self, ids: np.ndarray) -> bytes:
        """The joined entries of ``ids``."""
        parts = []
        for i in range(0, len(ids), CHUNK):
            own = ids[i : i + CHUNK]
            size = self.size[own]
            place = np.repeat((self.start[own] - (np.cumsum(size) - size)).astype(np.int32), size)
            place += np.arange(len(place), dtype=np.int32)
            parts.append(self.flat[place].tobytes())
        return b"".join(parts)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Where the entry of each id ends in ``gather(ids)``."""
        return np.cumsum(self.size[ids])


def chunks(sizes: Iterable[int], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Slices (from, to) of about ``most`` in sum; one larger item stands alone."""
    first = end = held = 0
    for n in sizes:
        if end > first and held + n > most:
            yield first, end
            first, held = end, 0
        end, held = end + 1, held + n
    if end > first:
        yield first, end


class PieceModel:
    """Encoder and decoder of one byte-pair sentencepiece model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
        odd = [
            model.trainer_spec.model_type != proto.TrainerSpec.BPE,
            not model.trainer_spec.byte_fallback,
            model.trainer_spec.treat_whitespace_as_suffix,
            bool(norm.precompiled_charsmap),
            norm.remove_extra_whitespaces,
            not norm.escape_whitespaces,
            any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces),
        ]
        if any(odd):
            raise ValueError(f"{path}: only byte-pair models with byte pieces, identity normaliser and plain pieces are encoded here")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        names = [p.piece for p in model.pieces]
        plain = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.count = len(names)
        self.byte_ids = np.zeros(256, np.int32)
        self.is_byte = np.zeros(self.count, bool)
        surface, special = [], []
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = i
                self.is_byte[i] = True
                surface.append(bytes([int(p.piece[3:-1], 16)]))
            else:
                surface.append(b"" if p.type == kinds.CONTROL else UNKNOWN.encode() if p.type == kinds.UNKNOWN else p.piece.replace(SPACE, " ").encode())
            special.append(p.type in (kinds.CONTROL, kinds.UNKNOWN))
        self.surface, self.special = ByteTable(surface), np.array(special)
        self.decimals = ByteTable([b"%d," % i for i in range(self.count)])
        symbols = dict(plain)
        for c in sorted(set("".join(plain))):  # characters that only stand inside pieces still merge
            symbols.setdefault(c, self.count + len(symbols))
        self.by_point = np.full(0x110000, -1, np.int32)
        for c, s in symbols.items():
            if len(c) == 1:
                self.by_point[ord(c)] = s
        ranks = np.unique(-np.array([p.score for p in model.pieces], np.float64), return_inverse=True)[1]
        pairs = [(symbols[p[:k]] << _SHIFT | symbols[p[k:]], int(ranks[i]), i) for p, i in plain.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        self.pairs, self.ranks, self.joined = (np.array(x, t) for x, t in zip(zip(*sorted(pairs), strict=True), (np.int64, np.int32, np.int32), strict=True))
        self.beside = np.array(sorted({symbols[a] << _SHIFT | symbols[b] for p in plain for a, b in zip(p, p[1:], strict=False)}), np.int64)
        inside = any(b == SPACE != a for p in plain for a, b in zip(p, p[1:], strict=False))
        self.splits = not inside
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or _NONE, joined symbol) of pairs of symbols."""
        key = left.astype(np.int64) << _SHIFT | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], _NONE), self.joined[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each); no word is empty."""
        points = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32)
        n = len(points)
        first = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))[:-1])
        symbol = self.by_point[points]
        border = np.ones(n, bool)
        if n > 1:
            key = symbol[:-1].astype(np.int64) << _SHIFT | symbol[1:]
            at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
            border[1:] = (self.beside[at] != key) | (symbol[:-1] < 0) | (symbol[1:] < 0)
        border[first] = True
        done = np.full(n, -2, np.int32)  # -2: merged into the symbol before it
        place, seg = np.arange(n), np.cumsum(border) - 1
        rank, to = self._ranked(symbol, seg)
        while len(place):
            starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            size = np.diff(np.r_[starts, len(seg)])
            least = np.repeat(np.minimum.reduceat(rank, starts), size)
            live = least < _NONE
            if not live.all():
                done[place[~live]] = symbol[~live]
                place, seg, symbol, rank, to, least = (x[live] for x in (place, seg, symbol, rank, to, least))
                if not len(place):
                    break
            take = self._places(symbol, seg, rank, to, rank == least)
            symbol = symbol.copy()
            symbol[take] = to[take]
            kept = np.ones(len(symbol), bool)
            kept[take + 1] = False
            now = (np.cumsum(kept) - 1)[take]
            place, seg, symbol, rank, to = (x[kept] for x in (place, seg, symbol, rank, to))
            stale = np.zeros(len(symbol), bool)
            stale[now] = stale[np.maximum(now - 1, 0)] = True
            self._rerank(np.flatnonzero(stale), symbol, seg, rank, to)
        kept = done != -2
        symbol, points = done[kept], points[kept]
        width = np.where((symbol >= 0) & (symbol < self.count), 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        bare = (symbol < 0) | (symbol >= self.count)
        ids = np.repeat(symbol, width)
        if bare.any():
            raw = points[bare].astype("<u4").tobytes().decode("utf-32-le").encode()
            ids[np.repeat(bare, width)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        total = np.zeros(n, np.int64)
        total[kept] = width
        return ids, np.add.reduceat(total, np.r_[0, first]) if len(words) else np.zeros(0, np.int64)

    def _ranked(self, symbol: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, to = np.full(len(symbol), _NONE, np.int32), np.zeros(len(symbol), np.int32)
        self._rerank(np.arange(len(symbol)), symbol, seg, rank, to)
        return rank, to

    def _rerank(self, at: np.ndarray, symbol: np.ndarray, seg: np.ndarray, rank: np.ndarray, to: np.ndarray) -> None:
        """Ranks of the pairs that begin at ``at``, in place; the last symbol of a segment begins none."""
        rank[at] = _NONE
        at = at[at + 1 < len(symbol)]
        at = at[seg[at] == seg[at + 1]]
        rank[at], to[at] = self._look(symbol[at], symbol[at + 1])

    def _places(self, symbol: np.ndarray, seg: np.ndarray, rank: np.ndarray, to: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Places to merge in this round: every second of a run of overlapping ones; the first alone where more would differ."""
        at = np.flatnonzero(low)
        fresh = np.r_[True, np.diff(at) > 1]
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - begin) % 2 == 0]
        same = seg[at[1:]] == seg[at[:-1]]
        if not same.any():
            return at
        many = np.r_[same, False] | np.r_[False, same]
        own, unsafe = at[many], []
        made, limit = to[own], rank[own]
        left, right = np.maximum(own - 1, 0), np.minimum(own + 2, len(symbol) - 1)
        unsafe.append((own > 0) & (seg[left] == seg[own]) & (self._look(symbol[left], made)[0] <= limit))
        unsafe.append((own + 2 < len(symbol)) & (seg[right] == seg[own]) & (self._look(made, symbol[right])[0] <= limit))
        touch = np.r_[False, (np.diff(own) == 2) & (seg[own[1:]] == seg[own[:-1]])]
        unsafe.append(touch & (self._look(np.r_[0, made[:-1]], made)[0] <= limit))
        bad = np.unique(seg[own[np.logical_or.reduce(unsafe)]])
        if not len(bad):
            return at
        later = np.r_[False, same]
        return at[~(later & np.isin(seg[at], bad))]

    def _cut(self, texts: list[str | None]) -> tuple[pa.StringArray, np.ndarray]:
        """(all words of the texts, number of words of each); space marks are spaces here."""
        raw = [(self.prefix + t).replace(SPACE, " ").encode() if t else b"" for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = b"".join(raw)
        first = (np.cumsum(size) - size)[size > 0]
        if self.splits:
            space = np.frombuffer(data, np.uint8) == 0x20
            begins = space.copy()
            begins[1:] &= ~space[:-1]
            begins[first] = True
            first = np.flatnonzero(begins)
        ends = np.searchsorted(first, np.cumsum(size))
        words = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.r_[first, len(data)].astype(np.int32)), pa.py_buffer(data))
        return words, np.diff(ends, prepend=0)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, ids, ends): ids of texts[from:to] in one array, and where those of each text end."""
        for lo, hi in chunks(len(t or "") + 1 for t in texts):
            words, count = self._cut(texts[lo:hi])
            coded = words.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if len(self.ids) > REMEMBERED:
                self._forget()
            if new := [w for w in distinct if w not in self.index]:
                made = [self.merge(new[a:b]) for a, b in chunks(map(len, new))]
                self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
                self.ids = np.concatenate([self.ids, *(m[0] for m in made)])
                self.sizes = np.concatenate([self.sizes, *(m[1] for m in made)])
                self.starts = np.cumsum(self.sizes) - self.sizes
            known = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
            at = known[coded.indices.to_numpy()]
            size = self.sizes[at]
            last = np.cumsum(size)
            place = np.repeat(self.starts[at] - (last - size), size)
            place += np.arange(len(place))
            yield lo, hi, self.ids[place], np.r_[0, last][np.cumsum(count)]

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of many lists of ids, which lie in one array and end at ``ends``."""
        raw, cut = self.surface.gather(ids), np.r_[0, self.surface.ends(ids)]
        odd = np.r_[0, np.cumsum(self.special[ids])]
        out = []
        for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
            own = raw[cut[a] : cut[b]]
            try:
                if b > a and (odd[b] > odd[a] or self.is_byte[ids[a]]):
                    out.append(self._decode_odd(ids[a:b]))
                else:
                    out.append((own[1:] if self.prefix and own[:1] == b" " else own).decode())
            except UnicodeDecodeError:
                out.append(self._decode_odd(ids[a:b]))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become a replacement character each."""
        ids = np.asarray(ids, np.int64)
        return self.decode_all(ids, np.array([len(ids)]))[0]

    def _decode_odd(self, ids: np.ndarray) -> str:
        """Ids that no encoder gives: runs of byte pieces are read character by character."""
        out, run, opening = [], b"", True

        def close() -> None:
            nonlocal run
            while run:
                for n in range(min(4, len(run)), 0, -1):
                    try:
                        char = run[:n].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(char) == 1:
                        out.append(char)
                        break
                else:
                    n = 1
                    out.append("�")
                run = run[n:]

        for i in ids.tolist():
            piece = self.surface.gather(np.array([i]))
            if self.is_byte[i]:
                run += piece
                continue
            close()
            if opening and not self.special[i] and not any(out):
                opening = False
                if self.prefix and piece[:1] == b" ":
                    piece = piece[1:]
            out.append(piece.decode())
        close()
        return "".join(out)


@lru_cache(4)
def load(path: str) -> PieceModel:
    """The model of a file on this machine; one of each worker process."""
    return PieceModel(path)


def model_path(name: str = MODEL) -> str:
    """Where this machine keeps a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, with_ids: bool = True) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256[, input_ids])`` of every row.

    ``ids_sha256`` is taken of the decimal ids joined by commas,
    ``decoded_sha256`` of the UTF-8 of the text that the ids decode to.
    """

    def kernel(texts: list[str | None]) -> dict[str, list]:
        own = load(model_path(model))
        count, digest, decoded, ids = [], [], [], []
        for _, _, flat, ends in own.encode(texts):
            listed, cut = own.decimals.gather(flat), np.r_[0, own.decimals.ends(flat)]
            for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
                count.append(b - a)
                digest.append(hashlib.sha256(listed[cut[a] : cut[b]][:-1]).hexdigest())
                if with_ids:
                    ids.append(flat[a:b].tolist())
            decoded += [hashlib.sha256(t.encode()).hexdigest() for t in own.decode_all(flat, ends)]
        return {"n_tokens": count, "ids_sha256": digest, "decoded_sha256": decoded} | ({"input_ids": ids} if with_ids else {})

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", input_ids array<int>" * with_ids
    return map_texts(docs, kernel, schema, [key], text)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "input_ids", model: str = MODEL) -> DataFrame:
    """``(key, text)``: the text of every list of ids; null lists give the empty text."""

    def kernel(lists: list[list[int] | None]) -> dict[str, list]:
        own = load(model_path(model))
        return {"text": [own.decode(np.array(x or [], np.int64)) for x in lists]}

    return map_texts(encoded, kernel, "text string", [key], ids, "array<int>")
