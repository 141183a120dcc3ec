"""SimHash fingerprints and links by pigeonring filtering.

The bits of a fingerprint form a ring of boxes. If two fingerprints differ in at
most ``budget`` bits, some box starts a chain of consecutive boxes whose
cumulative differences never exceed the proportional share of the budget. Where
that share is below one for the first boxes, these must be equal, which makes
them a join key; the rest of the chain is checked on the pairs that meet, and
the full Hamming distance on those that are left. Where the budget is too wide
for equal boxes of bits, chains run over boxes of sampled shingles instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ngram_join
from .common import apply_arrow, as_bytes, named, packed, row_key, stored, unpacked
from .graph import components

# The exact search: 64 bits, at most 2 differ. Chains of the first two boxes must then be equal.
BOXES = (13, 13, 13, 13, 12)
BUDGET = 2
# Up to so many fingerprints with one chain are compared pair by pair; more of them by single-bit variants.
BUCKET = 8
# The search by similarity: 64-bit lanes of the fingerprint, boxes of the sample ring and equal boxes of a chain.
WIDE_LANES, RING_BOXES, RING_CHAIN = 32, 32, 3
# Sets of fewer shingles skip the bit filter, whose error bounds need many; more differ by no more than so many standard errors.
FILTERED_FROM, ERRORS = 64, 6
# Up to so many keys are broadcast to take rows out; more are joined.
MOST_SENT = 1 << 20
_MIX = np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RING_MIX = np.random.default_rng(21).integers(1, 2**63, RING_BOXES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 255


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle; of the whole sequence if it is shorter; none without words."""
    split = text.lower().split()
    if len(split) >= words:
        joined = map(b" ".join, zip(*(split[i:] for i in range(words))))
    else:
        joined = [b" ".join(split)] if split else []
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(s, 42) for s in joined]), ">u8").astype(np.uint64)


def _majority(hashes: np.ndarray, lanes: int) -> bytes:
    """A bit is 1 if set in over half the hashes; further lanes are remixed hashes."""
    n, width = len(hashes), lanes * 64
    totals = np.zeros(width, np.int64)
    for start in range(0, n, _BLOCK * 16):
        part = hashes[start : start + _BLOCK * 16, None]
        if lanes > 1:
            part = part * _MIX[None, :lanes]
            part = part ^ (part >> np.uint64(32))
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(len(part), -1), axis=1)
        for k in range(0, len(bits), _BLOCK):
            totals += bits[k : k + _BLOCK].sum(axis=0, dtype=np.uint8)
    return np.packbits(totals * 2 > n).tobytes()


def _sample_chains(hashes: np.ndarray) -> np.ndarray:
    """One key for each start on the ring: what ``RING_CHAIN`` consecutive boxes hold there.

    A box holds the fingerprint of one sampled shingle, the lowest under the box's
    own mixing, so two sets are equal in a box with the probability of their
    similarity, however many texts there are.
    """
    lowest = np.full(RING_BOXES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _BLOCK * 16):
        part = hashes[start : start + _BLOCK * 16, None] * _RING_MIX[None, :]
        part ^= part >> np.uint64(32)
        np.minimum(lowest, part.min(axis=0), out=lowest)
    key = np.arange(RING_BOXES, dtype=np.uint64)
    for k in range(RING_CHAIN):
        key = (key ^ np.roll(lowest, -k)) * _MIX[k]
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``fp``, the fingerprint as 8 bytes, to every row.

    Words are runs without ASCII blanks, A-Z lower-cased; repeated shingles count
    as often as they occur. A null text, like one without words, has all bits zero.
    """

    def make():
        def work(texts):
            made = (shingle_hashes(t, words) for t in as_bytes(texts))
            return [pa.array([_majority(h, 1) if len(h) else bytes(8) for h in made], pa.binary())]

        return work

    return apply_arrow(docs, [text], "fp binary", make, keep)


def _as_long(fp: str) -> Column:
    """64 bits as a signed long."""
    return F.conv(F.hex(fp), 16, -10).cast("long")


def _offsets() -> list[int]:
    return [sum(BOXES[:i]) for i in range(len(BOXES))]


def _box(value: Column, i: int) -> Column:
    at = _offsets()[i % len(BOXES)]
    return F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << BOXES[i % len(BOXES)]) - 1))


def chain_length(boxes: int, budget: int) -> int:
    """Leading boxes of a chain that must be equal: those whose share of the budget is below one."""
    return math.ceil(boxes / budget) - 1


def _chain_holds(differs: Column, start: Column) -> Column:
    """The chain from ``start`` stays within its share of the budget at every length."""
    n = len(BOXES)
    out = F.lit(False)
    for s in range(n):
        total, fits = F.lit(0), start == s
        for step in range(1, n):
            total = total + F.bit_count(_box(differs, s + step - 1))
            fits = fits & (total <= step * BUDGET // n)
        out = out | fits
    return out


def near_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints at most ``BUDGET`` bits apart, directly or through others.

    ``nodes`` holds distinct longs ``v``. Fingerprints that share a chain with few
    others are compared in pairs. Where a chain is common, each of its
    fingerprints stands for itself and its 64 single-bit variants: two are within
    two bits exactly if they share a variant, so each variant links its
    fingerprints to the smallest of them, without forming pairs.
    """
    equal = chain_length(len(BOXES), BUDGET)
    keys = [
        F.struct(F.lit(s).alias("start"), sum((_box(F.col("v"), s + k) * (1 << 16 * k) for k in range(1, equal)), _box(F.col("v"), s)).alias("bits"))
        for s in range(len(BOXES))
    ]
    chained = nodes.select("v", F.explode(F.array(*keys)).alias("k")).select("v", "k.start", "k.bits")
    shared = chained.groupBy("start", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = stored(chained.join(shared, ["start", "bits"]), "chains")
    few = met.where(F.col("n") <= BUCKET).select("start", "bits", "v")
    other = few.select("start", "bits", F.col("v").alias("w"))
    differs = F.col("v").bitwiseXOR(F.col("w"))
    pairs = (
        few.join(other, ["start", "bits"])
        .where((F.col("v") < F.col("w")) & _chain_holds(differs, F.col("start")) & (F.bit_count(differs) <= BUDGET))
        .select(F.col("w").alias("a"), F.col("v").alias("b"))
    )
    common = met.where(F.col("n") > BUCKET).select("v").distinct()
    flips = F.array(F.col("v"), *[F.col("v").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    variants = common.select("v", F.explode(flips).alias("x"))
    hubs = variants.groupBy("x").agg(F.min("v").alias("hub"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    stars = variants.join(hubs, "x").where(F.col("v") != F.col("hub")).select(F.col("v").alias("a"), F.col("hub").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) for every row.

    Fingerprints link at two or fewer differing bits; component_id is the smallest
    id reachable, the row's own included. Null and empty texts have fingerprint
    zero and link like any other. Null ids are ignored by the minimum; repeated
    rows stay; other columns are not carried.
    """
    made = fingerprints(docs, text, words, [doc_id])
    rows = stored(made.select(named(doc_id).alias("id"), F.lower(F.hex("fp")).alias("fingerprint"), _as_long("fp").alias("v")), "fingerprints")
    nodes = rows.groupBy("v").agg(F.min("id").alias("low"))
    roots = components(near_links(nodes.select("v"))).select(F.col("node").alias("v"), "root")
    placed = nodes.join(roots, "v", "left").select("v", "low", F.coalesce("root", "v").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = placed.join(lows, "root").select("v", "component_id")
    return rows.join(classes, "v").select(F.col("id").alias(doc_id), "fingerprint", "component_id")


def bit_budget(similarity: float, lanes: int) -> int:
    """Bits that differ between sets of this Jaccard similarity at most: the expected number and ``ERRORS`` standard errors.

    A filter, not a decision. Lanes are remixed from the same hashes, which does not make their bits dependent.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    width = 64 * lanes
    return math.floor(width * share + ERRORS * math.sqrt(width * share * (1 - share)))


def ring_holds(boxes: np.ndarray, budget: int) -> np.ndarray:
    """Per row of box differences: some chain around the ring stays within its share of the budget.

    Chains are as long as half the ring; the full distance decides on the rest.
    """
    n = boxes.shape[1]
    sums = np.cumsum(np.concatenate((boxes, boxes), axis=1), axis=1, dtype=np.int64)
    sums = np.concatenate((np.zeros((len(boxes), 1), np.int64), sums), axis=1)
    alive = np.ones((len(boxes), n), bool)
    for step in range(1, n // 2 + 1):
        alive &= (sums[:, step : step + n] - sums[:, :n]) * n <= step * budget
    return alive.any(axis=1)


def wide_fingerprints(docs: DataFrame, text: str, words: int, keep: Sequence[str]) -> DataFrame:
    """Add the set of shingles as ``id``, ``n`` and ``counters``, its wide fingerprint ``fp`` and the keys of its sample ring, ``chains``.

    A text without words has all bits zero and no chains.
    """

    def make():
        known = ngram_join.WordHashes()

        def work(texts):
            sets = [ngram_join.gram_set(t, words, known) for t in as_bytes(texts)]
            prints = [_majority(h, WIDE_LANES) if len(h) else bytes(8 * WIDE_LANES) for h in sets]
            chains = [_sample_chains(h) if len(h) else np.zeros(0, np.int64) for h in sets]
            at = np.cumsum([0, *map(len, chains)], dtype=np.int32)
            flat = np.concatenate(chains) if chains else np.zeros(0, np.int64)
            return [
                pa.array([ngram_join.set_id(h) for h in sets], pa.int64()),
                pa.array([len(h) for h in sets], pa.int64()),
                pa.array([ngram_join.counters(h) for h in sets], pa.binary()),
                pa.array(prints, pa.binary()),
                pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
            ]

        return work

    return apply_arrow(docs, [text], "id bigint, n bigint, counters binary, fp binary, chains array<bigint>", make, keep)


def _ring_near(pairs: DataFrame, nodes: DataFrame, budget: int) -> DataFrame:
    """The pairs (a, b) that the ring and the full distance do not rule out; pairs with a small set all stay."""
    side = lambda key, fp, n: nodes.select(F.col("id").alias(key), F.col("fp").alias(fp), F.col("n").alias(n))
    paired = pairs.join(side("a", "x", "nx"), "a").join(side("b", "y", "ny"), "b").withColumn("small", F.least("nx", "ny") < FILTERED_FROM)

    def check():
        def work(x, y, small):
            left, right = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, 8 * WIDE_LANES) for v in (x, y))
            boxes = np.bitwise_count(left ^ right)
            near = ring_holds(boxes, budget)
            near[near] = boxes[near].sum(axis=1, dtype=np.int64) <= budget
            return [pa.array(near | small.to_numpy(zero_copy_only=False), pa.bool_())]

        return work

    return apply_arrow(paired, ["x", "y", "small"], "near boolean", check, ["a", "b"]).where("near").select("a", "b")


def _all_pairs(rows: DataFrame) -> DataFrame:
    """Every pair of ids under one ``key``, once; for keys of few ids."""
    left, right = rows.alias("l"), rows.alias("r")
    met = left.join(right, F.col("l.key") == F.col("r.key")).where(F.col("l.id") > F.col("r.id"))
    return met.select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()


def similar_groups(nodes: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, root), as ``components`` gives them, of ids joined by this Jaccard similarity of their sets, directly or through others.

    ``nodes`` has ``id``, ``n``, ``counters``, ``fp`` and ``chains`` of each distinct
    set and the ``mark`` of a row of ``docs`` (text, mark) that has it. A budget this
    wide leaves no chain of bits that must be equal, so candidates come from the
    sample ring: at similarity 0.8 two sets have no three equal consecutive boxes
    of 32 once in 100,000 cases. Under a chain of few, all are compared; under a
    crowded one each meets a leader. What the bit filter leaves is decided on the
    sets themselves. Where leaders do not join all of a crowd, its sets are joined
    by their rarest shingles, which finds every similar pair among them.
    """
    percent = round(100 * similarity)
    budget = bit_budget(similarity, WIDE_LANES)
    spark = docs.sparkSession
    plain = spark.sparkContext.broadcast(ngram_join.Order(*(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))))
    fetch = lambda asked: stored(ngram_join.segments(docs, "text", words, asked, plain).dropDuplicates(["id", "fragment"]), "segments")
    sets = nodes.select("id", "n", "counters", "mark")

    keyed = nodes.select("id", F.explode("chains").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min_by("id", F.xxhash64("key", "id")).alias("leader"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = stored(keyed.join(leaders, "key"), "ring")
    crowds = met.where(F.col("n") > BUCKET)
    led = crowds.where(F.col("id") != F.col("leader")).select(F.greatest("id", "leader").alias("a"), F.least("id", "leader").alias("b"))
    pairs = _all_pairs(met.where(F.col("n") <= BUCKET).select("key", "id")).unionByName(led).distinct()
    groups = components(ngram_join.similar_pairs(_ring_near(pairs, nodes, budget), sets, fetch, percent))

    painted = crowds.select("key", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("colour", F.coalesce("root", "id"))
    mixed = painted.groupBy("key").agg(F.min("colour").alias("low"), F.max("colour").alias("high")).where(F.col("low") != F.col("high")).select("key")
    apart = stored(painted.join(mixed, "key").select("id").distinct(), "apart")
    if not apart.limit(1).count():
        return groups
    asked = sets.join(apart, "id")
    rows = ngram_join.marked_rows(docs, asked).join(asked.select("mark"), "mark", "left_semi").dropDuplicates(["mark"])
    rows = stored(rows.select("text"), "apart-texts")
    order = spark.sparkContext.broadcast(ngram_join.gram_order(rows, "text", words))
    rare = ngram_join.first_grams(ngram_join.gram_sets(rows, "text", words, percent, order, []).where("n > 0"))
    return ngram_join.similarity_groups(rare, sets, fetch, percent, groups)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, its own columns unchanged.

    Texts of one group are linked, directly or through others, by a Jaccard
    similarity of at least ``similarity`` of their sets of ``words``-word shingles.
    Null texts and texts without words are alike. Of ids that are equal, or null
    (which come last), the smaller text hash decides; of repeated rows one stays.
    """
    own = docs.select(named(doc_id).alias("doc"), named(text).alias("text"), row_key(text).alias("text_key"), ngram_join.row_mark(doc_id, text).alias("mark"))
    rows = wide_fingerprints(own, "text", words, ["doc", "text_key", "mark"])
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "text_key", "mark", "n", "counters", "fp", "chains")
    # many rows of one set leave one row of a partition each; the rest is written once
    nodes = stored(rows.groupBy("id").agg(F.min(first).alias("first")).select("id", "first.*"), "wide-nodes")
    groups = similar_groups(nodes.where("n > 0"), own.select("text", "mark"), words, similarity)
    roots = groups.withColumnRenamed("node", "id")
    rank = F.struct("none", "doc", "text_key")
    chosen = (
        nodes.select("id", "none", "doc", "text_key")
        .join(roots, "id", "left")
        .groupBy(F.coalesce("root", "id").alias("root"))
        .agg(F.min(rank).alias("first"))
        .select("first.doc", "first.text_key")
    )
    chosen = stored(chosen, "chosen")
    # rows of most keys stay as they are; only the others are looked up, so no text is shuffled for those that stay
    keys = own.groupBy("doc", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    same = lambda l, r: l["doc"].eqNullSafe(r["doc"]) & (l["text_key"] == r["text_key"])
    kept = chosen.withColumn("kept", F.lit(True))
    marked = keys.join(kept, same(keys, kept), "left").select(keys["doc"], keys["text_key"], "rows", F.coalesce("kept", F.lit(False)).alias("kept"))
    odd = stored(marked.where(~F.col("kept") | (F.col("rows") > 1)), "odd-keys")
    work = packed(docs, doc=doc_id, text=text).withColumn("text_key", row_key("text")).drop("text")
    taken = F.broadcast(odd) if odd.count() <= MOST_SENT else odd
    stay = work.join(taken, same(work, taken), "left_anti").select("row")
    repeated = odd.where("kept")
    if not repeated.limit(1).count():
        return stay.select(*unpacked(docs.columns))
    sent = F.broadcast(repeated) if repeated.count() <= MOST_SENT else repeated
    once = work.join(sent, same(work, sent), "left_semi").dropDuplicates(["doc", "text_key"]).select("row")
    return stay.unionByName(once).select(*unpacked(docs.columns))
