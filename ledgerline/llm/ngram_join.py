"""Similarity self-join of word n-gram sets by vertical partitioning.

All n-grams stand in one global order, rare ones first. Two sets of the asked
similarity share one among the first few of each, so only sets that meet there
are compared. To compare, the order is cut into fragments and each set into the
segments that lie in them: partial overlaps are counted fragment by fragment,
apart from each other, and added up per pair.

Sets that are equal are one class from the start. Where many classes meet under
one n-gram, each is compared with a leader first; classes that this leaves
unlinked meet, in blocks, all that are not of their component.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCHES, apply_arrow, as_bytes, named, stored
from .graph import grown

WORDS, PERCENT = 4, 85
FRAGMENTS, HOT_FRAGMENTS = 16, 4
# n-grams whose counts decide the order: those below this share of the hash range. Most prefixes lie in it.
COUNTED = int(0.375 * 2**64)
# n-grams in this many texts or more go behind all others; so many at most, the most frequent ones.
OFTEN, MOST_OFTEN = 32, 1 << 20
# Up to so many classes under one n-gram are compared pair by pair; more are packed into blocks of about CELL, of which
# two at a time are compared, STRIP ids of one against all of the other.
BUCKET, CELL, STRIP = 8, 1024, 32
PROBES, BEST_ROUNDS = 8, 2
# Up to so many pairs are decided at once; of more, the likeliest are tried first.
FEW_PAIRS = 1 << 16
# Counters that bound the overlap of two sets from above; blocks compare coarse ones first, each the sum of several.
COUNTERS, COARSE = 512, 128
# Words whose hashes a task keeps.
KNOWN_WORDS = 1 << 17
# Slots of the filter for the rows whose sets are fetched.
SLOTS = 1 << 26
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Order:
    """What differs from the order by hash: the frequent n-grams by value, and the place of each behind all others."""

    often: np.ndarray
    place: np.ndarray
    cuts: np.ndarray

    def places(self, grams: np.ndarray) -> np.ndarray:
        """-1 for rare n-grams, else the place among the frequent ones."""
        if not len(self.often) or not len(grams):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.often, grams), len(self.often) - 1)
        return np.where(self.often[at] == grams, self.place[at], -1)

    def first(self, grams: np.ndarray, size: int) -> np.ndarray:
        """The first n-grams of a set that is sorted by hash."""
        place = self.places(grams)
        return np.concatenate((grams[place < 0], grams[place >= 0][np.argsort(place[place >= 0])]))[:size]

    def often_share(self, grams: np.ndarray) -> int:
        """Of those n-grams that are counted at all, how many sixty-fourths are frequent."""
        low = self.places(grams[: np.searchsorted(grams, np.uint64(COUNTED))])
        return int(64 * (low >= 0).sum()) // max(len(low), 1)

    def fragments(self, grams: np.ndarray) -> np.ndarray:
        """Fragment of each: rare ones by equal ranges of the hash, frequent ones by equal numbers of occurrences."""
        rare = FRAGMENTS - HOT_FRAGMENTS
        place = self.places(grams)
        return np.where(place < 0, ((grams >> np.uint64(32)) * np.uint64(rare) >> np.uint64(32)).astype(np.int64), rare + np.searchsorted(self.cuts, place, "right"))


class WordHashes(dict):
    """XXH64 of words, kept for the next text; forgotten when too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 42)
        return value


def gram_set(text: bytes, words: int, known: WordHashes) -> np.ndarray:
    """64-bit hashes of the distinct n-grams, sorted; of the whole sequence if it is shorter; none without words."""
    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(known.__getitem__, split), np.uint64, len(split))
    size = min(words, len(split))
    total = np.full(len(split) - size + 1, size, np.uint64)
    for k in range(size):
        total = (total ^ each[k : k + len(total)]) * _MIX
        total ^= total >> np.uint64(31)
    return np.unique(total)


def prefix_size(n: int, percent: int) -> int:
    """How many of the first n-grams hold one of every similar set: all but the least overlap, and one."""
    return n - -(-percent * n // 100) + 1 if n else 0


def counters(grams: np.ndarray) -> bytes:
    """How many n-grams fall to each counter; all at the top if one would pass it, which bounds nothing."""
    counts = np.bincount((grams & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
    return (counts if counts.max() < 255 else np.full(COUNTERS, 255)).astype(np.uint8).tobytes()


def _coarse(fine: np.ndarray) -> np.ndarray:
    """Rows of coarse counters from rows of fine ones, with the same rule for those at the top."""
    sums = fine.reshape(len(fine), -1, COARSE).sum(axis=1, dtype=np.int64)
    top = (fine.max(axis=1, initial=0) == 255) | (sums.max(axis=1, initial=0) >= 255)
    return np.where(top[:, None], 255, sums).astype(np.uint8)


def room(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """How far the overlap that pairs of counters (rows of uint8) allow lies above the least that is asked; below 0: too small.

    In hundredths and ``percent`` parts: 100 + percent times the overlap, less percent times both sizes.
    """
    most = np.minimum(x, y).sum(axis=-1, dtype=np.int64)
    unbound = (x.max(axis=-1, initial=0) == 255) | (y.max(axis=-1, initial=0) == 255)
    return np.where(unbound, 0, (100 + percent) * most - percent * (nx + ny))


def gram_order(docs: DataFrame, text: str, words: int) -> Order:
    """The global order: n-grams by hash, but those of many texts last, by how many."""

    def count(batches):
        known = WordHashes()
        for batch in batches:
            sets = [gram_set(t, words, known) for t in as_bytes(batch.column(0))]
            low = [s[: np.searchsorted(s, np.uint64(COUNTED))] for s in sets]
            grams, n = np.unique(np.concatenate(low) if low else np.zeros(0, np.uint64), return_counts=True)
            for k in range(0, len(grams), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(grams[k : k + 50_000].view(np.int64)), pa.array(n[k : k + 50_000])], names=["gram", "n"])

    counted = docs.select(named(text)).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    counted = stored(counted, "frequent-grams")
    # powers of two from which on the n-grams are few enough: at most 64 rows
    steps = counted.groupBy(F.floor(F.log2("n")).alias("step")).agg(F.count(F.lit(1)).alias("grams")).orderBy(F.desc("step")).collect()
    least, total = 64, 0
    for row in steps:
        total += row["grams"]
        if total > MOST_OFTEN:
            break
        least = row["step"]
    rows = counted.where(F.col("n") >= F.lit(2.0) ** least).toArrow()  # MOST_OFTEN rows at most
    grams, n = rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    by_count = np.lexsort((grams, n))
    weight = np.cumsum(n[by_count])
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, HOT_FRAGMENTS) / HOT_FRAGMENTS) if len(grams) else np.zeros(HOT_FRAGMENTS - 1, np.int64)
    place = np.empty(len(grams), np.int64)
    place[by_count] = np.arange(len(grams))
    by_value = np.argsort(grams)
    return Order(grams[by_value], place[by_value], cuts)


def row_mark(*columns: str) -> Column:
    """64 bits of the rows' columns; only whether a row is looked at depends on them."""
    return F.xxhash64(*[named(c) for c in columns])


def _slots(keys: DataFrame) -> bytes:
    """A bit for each key's slot, of ``SLOTS``: at most ``SLOTS / 8`` bytes, however many keys there are."""
    slot = keys.select(F.pmod("mark", F.lit(SLOTS)).cast("int").alias("slot"))
    word = slot.selectExpr("shiftright(slot, 5) AS at", "shiftleft(1L, slot % 32) AS bit")
    rows = word.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(SLOTS // 32, np.uint32)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return bits.tobytes()


def _asked(batch: pa.RecordBatch, bits: np.ndarray) -> pa.Array:
    slot = batch.column(1).to_numpy(zero_copy_only=False) % SLOTS
    return pa.array(((bits[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1).astype(bool))


def marked_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows (text, mark) whose mark is among the wanted, and by chance a few more: a filter of fixed size, where the rows are read."""
    seen = docs.sparkSession.sparkContext.broadcast(_slots(wanted))

    def run(batches):
        bits = np.frombuffer(seen.value, np.uint32)
        for batch in batches:
            yield batch.filter(_asked(batch, bits))

    return docs.select("text", "mark").mapInArrow(run, "text string, mark bigint")


def segments(docs: DataFrame, text: str, words: int, wanted: DataFrame, order) -> DataFrame:
    """(id, fragment, grams) of the sets of the wanted rows (column ``mark``).

    Other rows go before their sets are made; those that pass by chance drop out of the
    joins that follow. ``docs`` has ``mark`` and the text.
    """

    def make(batches):
        cut, known = order.value, WordHashes()
        for batch in batches:
            ids, fragments, grams, sizes = [], [], [], 0
            for t in as_bytes(batch.column(0)):
                own = gram_set(t, words, known)
                if not len(own):
                    continue
                part = cut.fragments(own)
                for f in np.unique(part).tolist():
                    ids.append(set_id(own))
                    fragments.append(f)
                    grams.append(own[part == f].view(np.int64))
                    sizes += len(grams[-1])
                if sizes > 1_000_000:
                    yield _segment_batch(ids, fragments, grams)
                    ids, fragments, grams, sizes = [], [], [], 0
            yield _segment_batch(ids, fragments, grams)

    rows = marked_rows(docs.select(named(text).alias("text"), "mark"), wanted)
    return rows.select("text").mapInArrow(make, "id bigint, fragment int, grams array<bigint>")


def _segment_batch(ids: list, fragments: list, grams: list) -> pa.RecordBatch:
    at = pa.array(np.cumsum([0, *map(len, grams)], dtype=np.int32))
    flat = pa.array(np.concatenate(grams) if grams else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fragments, pa.int32()), pa.ListArray.from_arrays(at, flat)], names=["id", "fragment", "grams"])


def set_id(grams: np.ndarray) -> int:
    """A set's class: 64 bits of its n-grams, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).astype(np.int64))


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b, common): n-grams that both sets of each pair have, added up over the fragments.

    ``parts`` has one row per id and fragment. Pairs without a common n-gram are left out.
    """
    side = lambda key, grams: parts.select(F.col("id").alias(key), "fragment", F.col("grams").alias(grams))
    dealt = pairs.select("a", "b").join(side("a", "x"), "a").join(side("b", "y"), ["b", "fragment"])
    return dealt.select("a", "b", F.size(F.array_intersect("x", "y")).alias("n")).groupBy("a", "b").agg(F.sum("n").alias("common"))


def _with_room(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, room) of those pairs whose counters leave room for the overlap."""
    side = lambda key, n, c: sets.select(F.col("id").alias(key), F.col("n").alias(n), F.col("counters").alias(c))
    sized = pairs.select("a", "b").join(side("a", "na", "ca"), "a").join(side("b", "nb", "cb"), "b")

    def make():
        def work(x, y, nx, ny):
            x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, COUNTERS) for v in (x, y))
            return [pa.array(room(x, y, nx.to_numpy(), ny.to_numpy(), percent), pa.int64())]

        return work

    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return apply_arrow(sized.where(fits), ["ca", "cb", "na", "nb"], "room bigint", make, ["a", "b", "na", "nb"]).where("room >= 0")


def similar_pairs(pairs: DataFrame, sets: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are as similar as asked, exactly.

    ``sets`` has (id, n, counters, mark). Counters bound the overlap from above,
    so few pairs are left whose sets are fetched.
    """
    near = stored(_with_room(pairs, sets, percent).drop("room"), "near-pairs")
    asked = near.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(sets.select("id", "mark"), "id")
    common = overlaps(near, fetch(asked))
    enough = (100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))
    return common.join(near, ["a", "b"]).where(enough).select("a", "b")


def _in_order(x: Column, y: Column) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _few_pairs(met: DataFrame, percent: int, unlike: Column | None = None) -> DataFrame:
    """Pairs of ids under n-grams of few: lengths, and what can still follow the n-gram in both, leave room for the overlap."""
    left, right = met.alias("l"), met.alias("r")
    c = lambda s, n: F.col(f"{s}.{n}")
    rest = 1 + F.least(c("l", "n") - c("l", "pos"), c("r", "n") - c("r", "pos")) - 1
    fits = (100 * F.least(c("l", "n"), c("r", "n")) >= percent * F.greatest(c("l", "n"), c("r", "n"))) & (
        (100 + percent) * rest >= percent * (c("l", "n") + c("r", "n"))
    )
    joined = left.join(right, c("l", "gram") == c("r", "gram")).where((c("l", "id") > c("r", "id")) & fits)
    joined = joined if unlike is None else joined.where(unlike)
    return joined.select(c("l", "id").alias("a"), c("r", "id").alias("b")).distinct()


def _unsettled(met: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows under n-grams whose ids are of several components so far, with ``colour``, the component."""
    painted = met.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("colour", F.coalesce("root", "id")).drop("root")
    mixed = painted.groupBy("gram").agg(F.min("colour").alias("low"), F.max("colour").alias("high")).where(F.col("low") != F.col("high")).select("gram")
    return stored(painted.join(mixed, "gram"), "unsettled")


def _probe_pairs(met: DataFrame) -> DataFrame:
    """Every id with one of those under the same n-gram whose sets consist most of frequent n-grams.

    Where many texts vary one, these are the nearest to it. Which of them, depends
    on the n-gram, so a text meets a few.
    """
    rank = F.shiftleft(F.col("often"), 50) + F.shiftrightunsigned(F.xxhash64("id", F.pmod("gram", F.lit(PROBES))), 14)
    top = met.groupBy("gram").agg(F.max_by("id", rank).alias("leader"))
    led = met.join(top, "gram").where(F.col("id") != F.col("leader"))
    return led.select(*_in_order(F.col("id"), F.col("leader"))).distinct()


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those of the pairs whose ids are of different components."""
    side = lambda key, root: groups.select(F.col("node").alias(key), F.col("root").alias(root))
    placed = pairs.join(side("a", "ra"), "a", "left").join(side("b", "rb"), "b", "left")
    return placed.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b", "room")


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """For every id the pair with most room for overlap."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"), "a", "b", "room")
    return ends.groupBy("id").agg(F.max_by("a", "room").alias("a"), F.max_by("b", "room").alias("b")).select("a", "b").distinct()


def _blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(gram, i, blocks, ids, colours, sizes, places, counters, lone): the ids under each n-gram in blocks of about ``CELL``.

    A block is one row: an array of each value.
    ``blocks`` is how many the n-gram has, ``lone`` whether the block holds ids outside
    the n-gram's main component, the one that most of its ids are of.
    """
    colours = rows.groupBy("gram", "colour").agg(F.count(F.lit(1)).alias("c"))
    main = colours.groupBy("gram").agg(F.max_by("colour", "c").alias("main"), F.ceil(F.sum("c") / CELL).cast("int").alias("blocks"))

    held = rows.join(main, "gram").join(sets.select("id", "counters"), "id")
    member = F.struct("id", "colour", "n", "pos", "counters")
    packed = held.groupBy("gram", "blocks", F.pmod(F.xxhash64("gram", "id"), F.col("blocks")).cast("int").alias("i")).agg(
        F.collect_list(member).alias("m"), F.max(F.col("colour") != F.col("main")).alias("lone")
    )
    part = lambda name: F.col("m").getField(name)
    return packed.select(
        "gram", "i", "blocks", "lone", part("id").alias("ids"), part("colour").alias("colours"),
        part("n").alias("sizes"), part("pos").alias("places"), part("counters").alias("counters"),
    )


def _block_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ids of different components under n-grams of many that the counters cannot tell apart.

    Under each n-gram every block meets itself and the blocks up to half way round,
    so that any two meet; not two blocks of the main component alone. Rows grow with
    the blocks, not with the ids, times the blocks; a task holds two at a time. All
    counters travel with a block, so only pairs that leave room for the overlap
    become rows: coarse counters rule out most, the fine ones of the rest decide.
    """
    for key, value in BATCHES.items():
        rows.sparkSession.conf.set(key, value)
    blocks = stored(_blocks(rows, sets), "blocks")
    values = ("ids", "colours", "sizes", "places", "counters")
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in values]
    steps = F.sequence(F.lit(0), F.floor(F.col("blocks") / 2).cast("int"))
    several = blocks.where("blocks > 1")
    left = several.select("gram", "lone", F.explode(F.transform(steps, lambda d: F.pmod(F.col("i") + d, F.col("blocks")))).alias("j"), *side("x"))
    right = several.select("gram", F.col("i").alias("j"), F.col("lone").alias("other"), *side("y"))
    met = left.join(right, ["gram", "j"]).where("lone OR other")
    sides = [f"{s}_{c}" for s in "xy" for c in values]
    met = met.select(*sides).unionByName(blocks.where("blocks = 1 AND lone").select(*side("x"), *side("y")))

    def compare(batches):
        flat = lambda column, k: column[k].values.to_numpy(zero_copy_only=False)
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for k in range(batch.num_rows):
                (ix, cx, nx, px, bx), (iy, cy, ny, py, by) = (
                    [flat(batch.column(at + v), k) for v in range(4)]
                    + [np.frombuffer(b"".join(batch.column(at + 4)[k].as_py()), np.uint8).reshape(-1, COUNTERS)]
                    for at in (0, 5)
                )
                dx, dy = _coarse(bx), _coarse(by)
                for s in range(0, len(ix), STRIP):
                    own = slice(s, s + STRIP)
                    both = nx[own, None] + ny[None, :]
                    rest = np.minimum((nx - px)[own, None], (ny - py)[None, :])
                    fits = (cx[own, None] != cy[None, :]) & ((100 + percent) * rest >= percent * both)
                    fits &= 100 * np.minimum(nx[own, None], ny[None, :]) >= percent * np.maximum(nx[own, None], ny[None, :])
                    i, j = np.nonzero(fits)
                    i += s
                    for a, b in ((dx, dy), (bx, by)):
                        near = room(a[i], b[j], nx[i], ny[j], percent) >= 0
                        i, j = i[near], j[near]
                    found.append(np.stack((np.maximum(ix[i], iy[j]), np.minimum(ix[i], iy[j]))))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(found, axis=1)], names=["a", "b"])

    return met.mapInArrow(compare, "a bigint, b bigint").distinct()


def similarity_groups(
    met: DataFrame, sets: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int, known: DataFrame | None = None
) -> DataFrame:
    """(node, root), as ``components`` gives them, of all ids joined by similarity, directly or through others.

    ``met`` has (gram, id, n, pos, often): the first n-grams of each set that others
    have there too, and ``many``, whether more than ``BUCKET`` have. Under crowded
    n-grams all meet a few probes. As far as this does not link them, they meet all
    others in blocks, where counters alone are compared; that work grows with the
    ids outside an n-gram's main component times all of its ids. Of the pairs that
    are left, each id's most likely one is tried first, if they are many. Ids of one
    group ``known`` before are not compared again.
    """
    crowds = met.where("many")
    first = _few_pairs(met.where("NOT many"), percent).unionByName(_probe_pairs(crowds)).distinct()
    if known is not None:
        first = _apart(first.withColumn("room", F.lit(0)), known).drop("room")
    groups = grown(known, similar_pairs(first, sets, fetch, percent))
    apart = _unsettled(crowds, groups)
    if not apart.limit(1).count():
        return groups
    left = stored(_with_room(_block_pairs(apart, sets, percent), sets, percent), "block-pairs")
    for tried in range(BEST_ROUNDS + 1):
        if not (many := left.count()):
            break
        last = many <= FEW_PAIRS or tried == BEST_ROUNDS
        now = left if last else stored(_best_pairs(left), "best-pairs")
        groups = grown(groups, similar_pairs(now, sets, fetch, percent))
        if last:
            break
        left = stored(_apart(left.join(now, ["a", "b"], "left_anti"), groups), "apart-pairs")
    return groups


def first_grams(rows: DataFrame) -> DataFrame:
    """(gram, id, n, pos, often, many) for every set's first n-grams that other sets have among theirs."""
    each = rows.select("id", "n", "often", F.posexplode("first").alias("pos", "gram")).distinct()
    counts = each.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1)
    return stored(each.join(counts, "gram").select("gram", "id", "n", "pos", "often", (F.col("k") > BUCKET).alias("many")), "met")


def gram_sets(docs: DataFrame, text: str, words: int, percent: int, order, keep: Sequence[str]) -> DataFrame:
    """Add the text's set as ``id``, ``n``, ``often`` (sixty-fourths that are frequent), ``first`` and ``counters``.

    A text without words has n 0 and no first n-grams.
    """

    def make():
        ranks, known = order.value, WordHashes()

        def work(texts):
            sets = [gram_set(t, words, known) for t in as_bytes(texts)]
            first = [ranks.first(s, prefix_size(len(s), percent)).view(np.int64) for s in sets]
            at = pa.array(np.cumsum([0, *map(len, first)], dtype=np.int32))
            return [
                pa.array([set_id(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([ranks.often_share(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(np.concatenate(first) if first else np.zeros(0, np.int64))),
                pa.array([counters(s) for s in sets], pa.binary()),
            ]

        return work

    return apply_arrow(docs, [text], "id bigint, n bigint, often bigint, first array<bigint>, counters binary", make, keep)


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row.

    A text's set holds its distinct ``words``-word n-grams, A-Z lower-cased, words
    parted by ASCII blanks; a shorter text its whole sequence. Two rows link if
    100 x intersection >= ``percent`` x union. component_id is the smallest id
    reachable by links, the row's own included. Null texts and texts without words
    have empty sets and link with nothing. Null ids are ignored by the minimum;
    repeated rows stay; other columns are not carried.
    """
    spark: SparkSession = docs.sparkSession
    own = docs.select(named(doc_id).alias("doc"), named(text).alias("text"), row_mark(doc_id, text).alias("mark"))
    order = spark.sparkContext.broadcast(gram_order(own, "text", words))
    rows = stored(gram_sets(own, "text", words, percent, order, ["doc", "mark"]), "gram-sets")
    classes = stored(
        rows.where("n > 0").groupBy("id", "n", "counters").agg(F.min("doc").alias("low"), F.min("mark").alias("mark")), "classes"
    )
    fetch = lambda asked: stored(segments(own, "text", words, asked, order).dropDuplicates(["id", "fragment"]), "segments")
    groups = similarity_groups(first_grams(rows.where("n > 0")), classes, fetch, percent)
    roots = groups.withColumnRenamed("node", "id")
    placed = classes.select("id", "low").join(roots, "id", "left").select("id", "low", F.coalesce("root", "id").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    found = placed.join(lows, "root").select("id", "component_id", F.lit(True).alias("linked"))
    alone = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
    return rows.select("doc", "id", "n").join(found, "id", "left").select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), alone.alias("component_id"))
