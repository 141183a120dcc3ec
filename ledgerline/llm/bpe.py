"""Byte-level BPE by an index from pairs to their positions.

The distinct new pre-tokens of a batch are laid out in one sequence. Every
mergeable pair has a list of its positions in it; the active ranks are taken in
ascending order from a heap, all positions of a rank are merged at once, and the
pairs that arise beside them are added to the lists of their own ranks.
"""

from __future__ import annotations

import copy
import heapq
import json
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import apply_arrow, as_texts
from .pretokens import WordCache, pieces, split_bytes

_GAP, _GONE = -1, -2
# From so many positions on, a rank is merged with array operations.
_BLOCK = 20
# Pre-tokens in each of the two generations of a task's cache, and characters that are split and encoded at a time.
CACHE, PART = 200_000, 1 << 20


def _byte_letters() -> dict[str, int]:
    """The visible character that stands for each byte in the vocabulary file."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, cache: int = CACHE):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = _byte_letters()
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.left = [vocab[a] for a, _ in merges]
        self.right = [vocab[b] for _, b in merges]
        self.merged = [vocab[a + b] for a, b in merges]
        self.rank = {(a << 20) | b: r for r, (a, b) in enumerate(zip(self.left, self.right))}
        born = dict(zip(self.merged, range(len(merges))))
        if any(born.get(x, -1) >= r for r, pair in enumerate(zip(self.left, self.right)) for x in pair):
            raise ValueError(f"{path}: a merge comes before one that makes its parts")
        self.pairs = np.array(sorted(self.rank), np.int64)
        self.pair_rank = np.array([self.rank[p] for p in self.pairs.tolist()], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(max(vocab.values()), *self.special.values(), 0) + 1
        self.table = [b""] * size
        for token, i in vocab.items():
            self.table[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.special.items():
            self.table[i] = token.encode()
        self.limit = cache
        self.cache = WordCache(self.encode_words, cache)

    def fresh(self) -> ByteBpe:
        """The same tables with an empty cache."""
        other = copy.copy(self)
        other.cache = WordCache(self.encode_words, self.limit)
        return other

    def encode_words(self, words: Sequence[str]) -> list[bytes]:
        """Ids of each pre-token, as little-endian 32-bit integers."""
        raw = [w.encode() for w in words]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        laid = np.insert(self.first[np.frombuffer(b"".join(raw), np.uint8)], ends, _GAP)
        laid = np.concatenate(([_GAP], laid))
        pair = (laid[:-1] << 20) | laid[1:]
        pair[(laid[:-1] < 0) | (laid[1:] < 0)] = -1
        slot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        where = np.flatnonzero(self.pairs[slot] == pair)
        ranks = self.pair_rank[slot[where]]
        few: dict[int, list[int]] = {}
        many: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(ranks: np.ndarray, at: np.ndarray) -> None:
            """Add positions to the lists of their ranks."""
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cut = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
            for s, e in zip(cut, cut[1:]):
                r = int(ranks[s])
                if r not in few:
                    few[r], many[r] = [], []
                    heapq.heappush(heap, r)
                if e - s < 8:
                    few[r] += at[s:e].tolist()
                else:
                    many[r].append(at[s:e])

        if len(where):
            note(ranks, where)
        sym, nxt, prv = laid, np.arange(1, len(laid) + 1), np.arange(-1, len(laid) - 1)
        symbol, after, before = memoryview(sym), memoryview(nxt), memoryview(prv)
        rank_of = self.rank.get
        while heap:
            rank = heapq.heappop(heap)
            a, b, new = self.left[rank], self.right[rank], self.merged[rank]
            places, blocks = few.pop(rank), many.pop(rank)
            if a != b and len(places) + sum(map(len, blocks)) >= _BLOCK:
                at = np.concatenate([*blocks, np.array(places, np.int64)])
                at = at[(sym[at] == a) & (sym[nxt[at]] == b)]
                j = nxt[at]
                k = nxt[j]
                sym[at], sym[j] = new, _GONE
                nxt[at], prv[k] = k, at
                h = prv[at]
                x, y = sym[h], sym[k]
                lefts, rights = (x >= 0) & (x != new), y >= 0
                pair = np.concatenate((x[lefts] << 20 | new, new << 20 | y[rights]))
                at = np.concatenate((h[lefts], at[rights]))
                slot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                known = self.pairs[slot] == pair
                if known.any():
                    note(self.pair_rank[slot[known]], at[known])
                continue
            for block in blocks:
                places += block.tolist()
            for i in sorted(places) if a == b else places:
                j = after[i]
                if symbol[i] != a or symbol[j] != b:
                    continue
                symbol[i], symbol[j] = new, _GONE
                k = after[j]
                after[i], before[k] = k, i
                h = before[i]
                for x, p, at in ((symbol[h], symbol[h] << 20 | new, h), (symbol[k], new << 20 | symbol[k], i)):
                    if x >= 0 and (r := rank_of(p)) is not None:
                        if r not in few:
                            few[r], many[r] = [at], []
                            heapq.heappush(heap, r)
                        else:
                            few[r].append(at)
        done = sym[sym != _GONE]
        gaps = np.flatnonzero(done == _GAP)
        ids = done.astype("<u4").tobytes()
        cut = (gaps * 4).tolist()
        return [ids[s + 4 : e] for s, e in zip(cut, cut[1:])]

    def _parts(self, text: str) -> list[str]:
        """Text between special strings at even places, the strings at odd ones; the leftmost, then longest, counts."""
        out, start = [], 0
        while True:
            found = [(i, -len(s), s) for s in self.special if (i := text.find(s, start)) >= 0]
            if not found:
                return [*out, text[start:]]
            i, _, s = min(found)
            out += [text[start:i], s]
            start = i + len(s)

    def _split(self, text: str) -> list[str]:
        return split_bytes(text) if len(text) <= 1 << 20 else [w for p in pieces(text) for w in split_bytes(p)]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        if any(s in t for s in self.special for t in texts):
            out = []
            for t in texts:
                parts = self._parts(t)
                made = self._encode_plain(parts[::2])
                marks = [self.special[s].to_bytes(4, "little") for s in parts[1::2]] + [b""]
                out.append(b"".join(x for pair in zip(made, marks) for x in pair))
            return out
        return self._encode_plain(texts)

    def _encode_plain(self, texts: Sequence[str]) -> list[bytes]:
        out: list[bytes] = []
        while len(out) < len(texts):
            size, end = 0, len(out)
            while end < len(texts) and (end == len(out) or size + len(texts[end]) <= PART):
                size += len(texts[end])
                end += 1
            splits = [self._split(t) for t in texts[len(out) : end]]
            ids = self.cache.ready(splits)
            out += [b"".join(map(ids, s)) for s in splits]
        return out

    def decode(self, ids: Iterable[bytes]) -> list[str]:
        piece = self.table.__getitem__
        return [b"".join(map(piece, np.frombuffer(i, "<u4").tolist())).decode("utf-8", "replace") for i in ids]


_LOADED: dict[tuple, object] = {}


def worker_bpe(path: str, cache: int = CACHE) -> ByteBpe:
    """The worker's own encoder, kept between tasks; a task that caches takes a ``fresh`` one, so that its words go with it."""
    if (path, cache) not in _LOADED:
        _LOADED[path, cache] = ByteBpe(path, cache)
    return _LOADED[path, cache]


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, cache: int = CACHE) -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` to every row.

    Null and empty texts have no ids. The strings of special tokens inside a text
    become their ids. Repeated rows stay; columns of the same names are replaced.
    """

    def make():
        bpe = worker_bpe(path, cache).fresh()

        def work(texts):
            ids = bpe.encode(as_texts(texts))
            return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]

        return work

    return apply_arrow(docs, [text], "ids binary, n_tokens long", make, keep)


def decode(docs: DataFrame, path: str, ids: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``decoded``, the text of the ids; null ids give an empty text."""

    def make():
        bpe = worker_bpe(path)
        return lambda column: [pa.array(bpe.decode(column.fill_null(b"").to_pylist()), pa.string())]

    return apply_arrow(docs, [ids], "decoded string", make, keep)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, cache: int = CACHE) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts."""

    def make():
        bpe = worker_bpe(path, cache).fresh()

        def work(texts):
            ids = bpe.encode(as_texts(texts))
            counts = [len(i) // 4 for i in ids]
            return [pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), pa.array(bpe.decode(ids), pa.string())]

        return work

    return apply_arrow(docs, [text], "ids binary, n_tokens long, decoded string", make, keep)
