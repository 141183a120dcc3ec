"""Token counts by a two-tier lookup on the map side.

Tier one is a table of the most frequent pre-tokens and their token counts,
packed into three arrays and broadcast. Tier two is the cache of each worker: a
pre-token in neither is encoded there. Pre-tokens are never shuffled; only those
of a bounded sample of rows are counted to choose tier one, which decides how
fast the rest runs and never what it gives.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteBpe, worker_bpe
from .common import apply_arrow, as_bytes, as_texts, named
from .pretokens import WordCache

# Bounds of tier one: entries and the bytes of one pre-token, so at most 2 MB are broadcast.
ENTRIES, ENTRY_BYTES, SAMPLE_ROWS = 32_768, 48, 2_000


def pack(words: Sequence[str], counts: Sequence[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    raw = [w.encode() for w in words]
    return b"".join(raw), np.array([len(r) for r in raw], np.uint8), np.array(counts, np.uint16)


def unpack(packed: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    blob, lengths, counts = packed
    ends = np.cumsum(lengths, dtype=np.int64)
    return {blob[e - n : e].decode(): c for e, n, c in zip(ends.tolist(), lengths.tolist(), counts.tolist())}


def frequent_pretokens(docs: DataFrame, path: str, text: str = "text", rows: int = SAMPLE_ROWS, entries: int = ENTRIES):
    """The packed table of the most frequent pre-tokens of about ``rows`` sampled rows."""
    total = docs.count()
    if not total:
        return pack([], [])
    sample = docs.select(named(text).alias("text")).sample(min(1.0, rows / total), seed=7)

    def run(batches):
        bpe = worker_bpe(path)
        for batch in batches:
            seen: Counter = Counter()
            for t in as_texts(batch.column(0)):
                for part in bpe._parts(t)[::2]:
                    seen.update(bpe._split(part))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    counted = sample.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.where(F.octet_length("word") <= ENTRY_BYTES).orderBy(F.desc("n"), "word").limit(entries)
    words = [r.word for r in top.select("word").collect()]
    return pack(words, [len(i) // 4 for i in ByteBpe(path, 0).encode_words(words)]) if words else pack([], [])


class Counts:
    """Counts the tokens of texts; one per worker and broadcast."""

    def __init__(self, path: str, tier_one: dict[str, int], cache: int):
        self.bpe = worker_bpe(path)
        self.cache = WordCache(lambda words: [len(i) // 4 for i in self.bpe.encode_words(words)], cache, tier_one)

    def __call__(self, texts: Sequence[str]) -> list[int]:
        bpe = self.bpe
        marked = [bpe._parts(t) for t in texts]
        splits = [[w for p in parts[::2] for w in bpe._split(p)] if len(parts) > 1 else bpe._split(parts[0]) for parts in marked]
        length = self.cache.ready(splits)
        return [sum(map(length, s)) + len(parts) // 2 for s, parts in zip(splits, marked)]


_COUNTS: dict[tuple, Counts] = {}


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, cache: int = 500_000, limit: int = 512
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` to every row.

    A null text counts as empty. The string of a special token counts as one
    token. Repeated rows stay; columns of the same names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent_pretokens(docs, path, text))

    def make():
        key = (path, sent.id if hasattr(sent, "id") else id(sent), cache)
        if key not in _COUNTS:
            _COUNTS.clear()
            _COUNTS[key] = Counts(path, unpack(sent.value), cache)
        count = _COUNTS[key]

        def work(texts):
            n = count(as_texts(texts))
            sizes = pa.array([len(b) for b in as_bytes(texts)], pa.int64())
            return [sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]

        return work

    return apply_arrow(docs, [text], "n_bytes long, n_tokens long, over_limit boolean", make, keep)
