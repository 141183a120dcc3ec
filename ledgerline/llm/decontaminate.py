"""Benchmark decontamination by a broadcast set of test n-grams.

Each word of the test items has a number. A document is turned into these
numbers (0 for any other word), a rolling hash runs over its windows, and hits
in the set are verified number by number.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apply_arrow, as_bytes, lower_az, named, packed, stored, unpacked, WORD_TABLE

WINDOW = 10
# Windows held by one broadcast set; more of them are scanned set after set.
SET_WINDOWS = 1_000_000
_ODD = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


class NgramSet:
    """The windows of some items and the items each belongs to."""

    def __init__(self, items: Sequence[tuple[object, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], list] = defaultdict(list)
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                held = owners[tuple(ids[i : i + window])]
                if not held or held[-1] != item:
                    held.append(item)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        for length in sorted({len(w) for w in owners}):
            windows = [w for w in owners if len(w) == length]
            ids = np.array(windows, np.uint64)
            hashes = self._roll(ids.ravel(), length)[::length]
            order = np.argsort(hashes, kind="stable")
            self.by_length[length] = (hashes[order], ids[order], [owners[windows[k]] for k in order])

    @staticmethod
    def _roll(ids: np.ndarray, length: int) -> np.ndarray:
        total = np.zeros(len(ids) - length + 1, np.uint64)
        for j in range(length):
            total = total * np.uint64(_ODD) + ids[j : len(ids) - length + 1 + j]
        return total ^ (total >> np.uint64(29))

    def find(self, texts: Sequence[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[set]]:
        """Per text: number of words, merged hit spans (from, to) in words, items."""
        splits = [words_of(t) for t in texts]
        counts = [len(s) for s in splits]
        get = self.numbers.get
        # a 0 between documents keeps windows inside them
        ids = np.fromiter((get(w, 0) for s in splits for w in (*s, b"")), np.uint64, sum(counts) + len(counts))
        starts = np.cumsum([0, *(c + 1 for c in counts)])
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        for length, (hashes, windows, owners) in self.by_length.items():
            if len(ids) < length:
                continue
            rolled = self._roll(ids, length)
            slot = np.searchsorted(hashes, rolled)
            at = np.flatnonzero(hashes[np.minimum(slot, len(hashes) - 1)] == rolled)
            for i in at.tolist():
                seen = ids[i : i + length]
                k = int(slot[i])
                while k < len(hashes) and hashes[k] == rolled[i]:
                    if (windows[k] == seen).all():
                        doc = int(np.searchsorted(starts, i, "right")) - 1
                        spans[doc].append((i - int(starts[doc]), i - int(starts[doc]) + length))
                        items[doc].update(owners[k])
                        break
                    k += 1
        return counts, [merge(s) for s in spans], items


def merge(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut_spans(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode()
    flat = raw.translate(WORD_TABLE)
    bounds, at = [], 0
    for word in flat.split():
        at = flat.index(word, at)
        bounds.append((at, at + len(word)))
        at += len(word)
    out, start = [], 0
    for first, last in spans:
        out.append(raw[start : bounds[first][0]])
        start = bounds[last - 1][1]
    return b"".join([*out, raw[start:]]).decode()


def find_overlap(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    set_windows: int = SET_WINDOWS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``n_words``, ``spans`` (hit words as [from, to)), ``n_hit`` and ``items`` to every row.

    An item is cut into windows of ``window`` words; a shorter one, unless empty,
    is one window. Null texts have no words, null items no windows; a null item id
    is the empty string. Repeated rows stay; columns of these names are replaced;
    without items nothing is hit. Repeated items count once. Items of at most
    ``set_windows`` words in all (32 bytes counting as a word at least) are broadcast
    as they are; more are cut into their distinct windows, which are spread by hash
    over sets of about that size, and the documents pass once through each set. So
    neither copies of an item nor one very long item make a set larger.
    """
    bench = benchmark.select(
        F.coalesce(named(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(named(item_text), F.lit("")).alias("text")
    )
    bench = bench.distinct()
    words = F.array_remove(F.split(lower_az(F.col("text")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    size = F.greatest(F.size(words), F.ceil(F.octet_length("text") / 32))
    total = bench.agg(F.sum(size)).first()[0] or 0
    sets = max(1, -(-int(total) // set_windows))
    if sets > 1:
        # a window is an item of its own here, under its item's id
        last = F.greatest(F.size("_words") - window, F.lit(0))
        cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("_words", i + 1, window), " "))
        split = bench.select("item", words.alias("_words")).where(F.size("_words") > 0)
        bench = stored(split.select("item", F.explode(cut).alias("text")).distinct(), "windows")
    fields = "n_words long, spans array<struct<first: int, last: int>>, items array<string>"
    taken = {"n_words", "spans", "items", "n_hit"}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    rows = docs.select(*[named(c) for c in dict.fromkeys([*names, text])])
    for k in range(sets):
        part = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(sets)) == k) if sets > 1 else bench
        ngrams = docs.sparkSession.sparkContext.broadcast(NgramSet([(r.item, r.text.encode()) for r in part.collect()], window))
        before = [] if k == 0 else ["spans", "items"]

        def make(ngrams=ngrams, before=before):
            def work(texts, *earlier):
                counts, spans, items = ngrams.value.find(as_bytes(texts))
                if earlier:
                    spans = [merge([*s, *((x["first"], x["last"]) for x in o)]) for s, o in zip(spans, earlier[0].to_pylist())]
                    items = [i | set(o) for i, o in zip(items, earlier[1].to_pylist())]
                shaped = [[{"first": a, "last": b} for a, b in s] for s in spans]
                kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
                return [
                    pa.array(counts, pa.int64()),
                    pa.array(shaped, kind),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ]

            return work

        rows = apply_arrow(rows, [text, *before], fields, make, keep=names if k == sets - 1 else [*names, *([text] if text not in names else [])])
        if k < sets - 1:
            rows = stored(rows, "overlap")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return rows.withColumn("n_hit", hit)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", max_share: float = 0.0, window: int = WINDOW
) -> DataFrame:
    """Rows free of test windows, with their own columns.

    A document in which more than ``max_share`` of the words are hit goes; from
    the others the hit spans are cut out of the text.
    """
    found = find_overlap(packed(docs, text=text), benchmark, "text", window=window, keep=["row", "text"])
    clean = found.where(F.col("n_hit") <= max_share * F.col("n_words"))
    if max_share <= 0:
        return clean.select(*unpacked(docs.columns))

    def make():
        def work(texts, spans):
            pairs = zip(texts.to_pylist(), spans.to_pylist())
            cut = [cut_spans(t, [(s["first"], s["last"]) for s in x]) if x else t for t, x in pairs]
            return [pa.array(cut, pa.string())]

        return work

    return apply_arrow(clean, ["text", "spans"], "cut string", make, ["row"]).select(*unpacked(docs.columns, **{text: F.col("cut")}))
