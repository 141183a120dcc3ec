"""Token ids in files that open single documents without reading their neighbours.

A dataset is a folder with two parquet tables.

* ``dictionary``: the dictionary's SHA-256 and bytes (one row; both null if too
  little was there to train one), the width of an id in bytes, the end id.
* ``segments``: runs of documents in ascending id order. Each row has its range
  number, its place in the range, the ids before it in the range, the dictionary
  hash, the document ids, their token counts, the offsets of their frames, and the
  frames one after the other. A frame is one document's ids, little-endian,
  compressed on its own with the shared dictionary.
"""

from __future__ import annotations

import hashlib
import unicodedata
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from ..plans.session import checkpoint_folder
from .common import BATCHES, apply_arrow, as_texts, named, ordered_parts
from .pretokens import WordCache, split_words

# Bounds of the training sample: documents, and tokens of each (longer ones are not drawn).
SAMPLE_DOCS, SAMPLE_TOKENS, DICTIONARY_BYTES = 2_000, 2_000, 65_536
SEGMENT_BYTES = 1 << 20
LEVEL = 3


class WordBpe:
    """Ids by the tokenizers library, asked once for each new word.

    Normalising and splitting follow the file's own steps; words not in the cache
    go to the library together, and their ids are told apart by the end-of-word
    mark that closes each.
    """

    def __init__(self, path: str, cache: int = 500_000):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.size = self.whole.get_vocab_size()
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.no_truncation()
        self.plain.no_padding()
        vocab = self.plain.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.type = "<u2" if self.size <= 1 << 16 else "<u4"
        self.cache = WordCache(self._encode_words, cache)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.plain.encode(" ".join(words), add_special_tokens=False).ids, np.int64)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not close every word")
        raw, width = ids.astype(self.type).tobytes(), int(self.type[2])
        cuts = [0, *(ends * width).tolist()]
        return [raw[s:e] for s, e in zip(cuts, cuts[1:])]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text in the width of the file."""
        out: list[bytes | None] = [None] * len(texts)
        easy = [i for i, t in enumerate(texts) if not any(s in t for s in self.special)]
        splits = []
        for i in easy:
            text = texts[i]
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            splits.append(split_words(text.lower()))
        ids = self.cache.ready(splits)
        for i, words in zip(easy, splits):
            out[i] = b"".join(map(ids, words))
        for i, made in enumerate(out):
            if made is None:
                out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, self.type).tobytes()
        return out


_LOADED: dict[tuple, WordBpe] = {}


def worker_words(path: str, cache: int = 500_000) -> WordBpe:
    if (path, cache) not in _LOADED:
        _LOADED[path, cache] = WordBpe(path, cache)
    return _LOADED[path, cache]


def train_dictionary(docs: DataFrame, path: str, text: str = "text", end_id: int = 2, rows: int = SAMPLE_DOCS) -> bytes | None:
    """A zstandard dictionary from the id arrays of a bounded sample of short documents."""
    total = docs.count()
    if not total:
        return None
    sample = docs.select(named(text).alias("text")).sample(min(1.0, 2 * rows / total), seed=5)

    def make():
        words = worker_words(path)
        width = int(words.type[2])
        end = end_id.to_bytes(width, "little")

        def work(texts):
            made = [i + end for i in words.encode(as_texts(texts))]
            return [pa.array([i if len(i) <= width * SAMPLE_TOKENS else None for i in made], pa.binary())]

        return work

    drawn = apply_arrow(sample, ["text"], "ids binary", make, []).where("ids is not null")
    samples = [bytes(r.ids) for r in drawn.limit(rows).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else None
    except zstandard.ZstdError:
        return None


def write_tokens(
    docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, parts: int | None = None
) -> str:
    """Write all documents in ascending id order and return the folder.

    Null ids come first; rows of one id follow each other; null and empty texts
    hold the end id alone; other columns are not written; an empty table gives an
    empty dataset.
    """
    spark = docs.sparkSession
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    raw = train_dictionary(docs, path, text, end_id)
    digest = hashlib.sha256(raw).hexdigest() if raw else None
    width = int(worker_words(path).type[2])
    spark.createDataFrame([(digest, raw, width, end_id)], "hash string, bytes binary, width int, end_id int").coalesce(1).write.parquet(f"{folder}/dictionary")
    sent = spark.sparkContext.broadcast(raw)
    rows = ordered_parts(docs.select(named(doc_id).alias("id"), named(text).alias("text")), ["id"], parts).select("_part", "id", "text")
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"part int, place int, before long, dictionary string, ids array<{kind}>, tokens array<long>, offsets array<long>, frames binary"
    )

    def run(batches):
        words = worker_words(path)
        end = end_id.to_bytes(width, "little")
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(sent.value) if sent.value else None)
        part, place, before = 0, 0, 0
        ids: list = []
        tokens: list[int] = []
        offsets, frames, held = [0], [], 0
        id_type = None

        def segment():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([place], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([digest], pa.string()),
                    pa.array([ids], pa.list_(id_type)),
                    pa.array([tokens], pa.list_(pa.int64())),
                    pa.array([offsets], pa.list_(pa.int64())),
                    pa.array([b"".join(frames)], pa.binary()),
                ],
                names=["part", "place", "before", "dictionary", "ids", "tokens", "offsets", "frames"],
            )

        for batch in batches:
            id_type = batch.column(1).type
            if len(batch):
                part = batch.column(0)[0].as_py()
            for one, made in zip(batch.column(1).to_pylist(), words.encode(as_texts(batch.column(2)))):
                frame = press.compress(made + end)
                if ids and held + len(frame) > SEGMENT_BYTES:
                    yield segment()
                    place, before = place + 1, before + sum(tokens)
                    ids, tokens, offsets, frames, held = [], [], [0], [], 0
                ids.append(one)
                tokens.append(len(made) // width + 1)
                frames.append(frame)
                held += len(frame)
                offsets.append(held)
        if ids:
            yield segment()

    rows.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/segments")
    return folder


def read_tokens(spark: SparkSession, folder: str, doc_id: str = "doc_id", wanted: Sequence | None = None) -> DataFrame:
    """(id, start, n_tokens, ids) from the files; ids are little-endian unsigned 32-bit integers.

    start is the number of ids of all documents before. ``wanted`` ids are found by
    the index, and only their frames are opened.
    """
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    head = spark.read.parquet(f"{folder}/dictionary").first()
    segments = spark.read.parquet(f"{folder}/segments")
    totals = segments.groupBy("part").agg(F.max(F.col("before") + F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    chosen = segments
    if wanted is not None:
        chosen = chosen.where(F.arrays_overlap("ids", F.array(*[F.lit(i) for i in wanted])))
    # one row per range, whose number the writer fixed
    rows = chosen.join(F.broadcast(bases), "part").select("base", "before", "dictionary", "ids", "tokens", "offsets", "frames")
    kind = segments.schema["ids"].dataType.elementType.simpleString()
    raw, digest, width = head["bytes"], head["hash"], head["width"]
    if raw is not None and hashlib.sha256(raw).hexdigest() != digest:
        raise ValueError(f"{folder}: the dictionary does not have its hash")
    sent = spark.sparkContext.broadcast(bytes(raw) if raw is not None else None)
    only = set(wanted) if wanted is not None else None

    def run(batches):
        opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(sent.value) if sent.value else None)
        for batch in batches:
            id_type = batch.column(3).type.value_type
            for row in range(len(batch)):
                base, before, used, ids, tokens, offsets, frames = (c[row].as_py() for c in batch.columns)
                if used != digest:
                    raise ValueError(f"{folder}: a segment was written with another dictionary")
                starts = (base + before + np.cumsum(tokens) - np.array(tokens)).tolist()
                at = [i for i, one in enumerate(ids) if only is None or one in only]
                opened = [opener.decompress(frames[offsets[i] : offsets[i + 1]]) for i in at]
                for s in range(0, len(at), 1000):
                    part = at[s : s + 1000]
                    wide = [np.frombuffer(x, f"<u{width}").astype("<u4").tobytes() for x in opened[s : s + 1000]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[i] for i in part], id_type),
                            pa.array([starts[i] for i in part], pa.int64()),
                            pa.array([tokens[i] for i in part], pa.int64()),
                            pa.array(wide, pa.binary()),
                        ],
                        names=[doc_id, "start", "n_tokens", "ids"],
                    )

    return rows.mapInArrow(run, f"`{doc_id}` {kind}, start long, n_tokens long, ids binary")


def token_folder(spark: SparkSession) -> str:
    """A new folder for a dataset under the shared one."""
    return f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"
