"""Periodic runs of words: stretches that repeat a phrase many times over.

A run with period q repeats a Lyndon word of q words, its root, under one of the
two orders of the words. Grouping suffixes as the first phase of Baier's suffix
sorter does leaves exactly those suffixes together that start with the same
longest Lyndon word, so the groups under both orders give every root directly.
Equal groups q apart are consecutive roots; common extensions to both sides make
them a run.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import apply_arrow, as_bytes

MIN_EXPONENT, MIN_LENGTH = 4, 6


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[int]]:
    """Group of each position, and length of each group's Lyndon word.

    Positions are of one group exactly if the longest Lyndon words that start
    there are equal. Groups are taken from the highest down. Each position of the
    group points to the nearest one before it in a lower group; its Lyndon word
    goes on with that of the group, as often as it is pointed to, so it moves to
    a new group right above its own.
    """
    n = len(symbols)
    ranks = {s: k for k, s in enumerate(sorted(set(symbols)))}
    group = [-1] + [ranks[s] for s in symbols]
    members: list[list[int]] = [[] for _ in ranks]
    for i in range(1, n + 1):
        members[group[i]].append(i)
    length = [1] * len(ranks)
    below, above = list(range(-1, len(ranks) - 1)), list(range(1, len(ranks) + 1))
    # positions of groups not yet taken, as a list linked both ways; 0 and n + 1 are its ends
    before, after = list(range(-1, n + 1)), list(range(1, n + 3))
    now = len(ranks) - 1
    while now >= 0:
        moves: dict[tuple[int, int], list[int]] = {}
        target, times = 0, 0
        for i in members[now]:
            if group[i] != now:
                continue
            j, k = before[i], after[i]
            after[j], before[k] = k, j
            if j == target:
                times += 1
                continue
            if target:
                moves.setdefault((times, group[target]), []).append(target)
            target, times = j, 1
        if target:
            moves.setdefault((times, group[target]), []).append(target)
        for times, old in sorted(moves, reverse=True):
            new = len(length)
            length.append(length[old] + times * length[now])
            members.append(moves[times, old])
            for j in members[new]:
                group[j] = new
            upper = above[old]
            below.append(old)
            above.append(upper)
            above[old] = new
            below[upper] = new
        now = below[now]
    return group[1:], length


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Leading places at which two arrays agree, up to the end of the shorter."""
    most, at, step = min(len(a), len(b)), 0, 16
    while at < most:
        differ = np.flatnonzero(a[at : min(at + step, most)] != b[at : min(at + step, most)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return most


def stretch_runs(symbols: np.ndarray, exponent: int, least: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``exponent`` periods and ``least`` symbols."""
    found = set()
    n = len(symbols)
    for order in (symbols, -symbols):
        group, length = (np.array(x, np.int64) for x in lyndon_groups(order.tolist()))
        period = length[group]
        place = np.arange(n)
        root = place + (exponent - 1) * period <= n
        for k in range(1, exponent - 1):  # a run this long holds exponent - 1 whole roots
            at = np.minimum(place + k * period, n - 1)
            root &= group[at] == group
        earlier = place - period
        root &= ~((earlier >= 0) & (group[np.maximum(earlier, 0)] == group))
        for i in np.flatnonzero(root).tolist():
            q = int(period[i])
            start = i - _common(symbols[:i][::-1], symbols[: i + q][::-1])
            end = i + q + _common(symbols[i:], symbols[i + q :])
            if end - start >= max(least, exponent * q):
                found.add((start, end - start, q))
    return found


def word_runs(words: Sequence[bytes], exponent: int = MIN_EXPONENT, least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a sequence of words, by start, then period.

    In a run of e or more periods every triple of neighbouring words comes e - 1
    times or more, so the grouping runs only over stretches of such triples; a
    word beyond a stretch extends no run in it.
    """
    n = len(words)
    if n < max(least, exponent):
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    often = min(exponent - 1, max(least, exponent) - 2)
    if often < 2:
        stretches = [(0, n)]
    else:
        triples = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:] if len(number) < 1 << 21 else None
        if triples is None:  # too many different words to pack three numbers into one
            pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
            triples = pairs[:-1] * len(number) + ids[2:]
        order = np.argsort(triples, kind="stable")
        same = np.diff(triples[order]) == 0
        edges = np.flatnonzero(np.concatenate(([True], ~same, [True])))
        counts = np.repeat(np.diff(edges), np.diff(edges))
        good = np.zeros(n, bool)
        good[order[counts >= often]] = True
        steps = np.diff(np.concatenate(([0], good.view(np.int8), [0])))
        stretches = [(a, b + 2) for a, b in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist())]
    found = []
    for a, b in stretches:
        if b - a >= max(least, exponent):
            found += [(a + s, size, q) for s, size, q in stretch_runs(ids[a:b], exponent, least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those after the first period of a run."""
    if not runs:
        return b" ".join(words)
    cut = np.zeros(len(words) + 1, np.int64)
    for start, size, q in runs:
        cut[start + q] += 1
        cut[start + size] -= 1
    gone = np.cumsum(cut)[:-1] > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


def find_runs(
    docs: DataFrame,
    text: str = "text",
    exponent: int = MIN_EXPONENT,
    least: int = MIN_LENGTH,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``n_words``, ``runs`` and ``collapsed`` to every row.

    Words are runs of characters other than ASCII blanks. ``runs`` are the
    maximal stretches of at least ``exponent`` times their smallest period and
    ``least`` words, as (start, length, period) by start, then period.
    ``collapsed`` has each run once, its first period. A null or blank text has no words, no runs and
    an empty ``collapsed``. Rows stay as they are, repeated ones too; columns
    with the new names give way. A text is worked on whole, in one task.
    """

    def make():
        def work(texts):
            counts, found, rest = [], [], []
            for raw in as_bytes(texts):
                words = raw.split()
                runs = word_runs(words, exponent, least)
                counts.append(len(words))
                found.append(runs)
                rest.append(collapse(words, runs))
            at = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            packed = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(at), packed), pa.array(rest, pa.binary()).cast(pa.string())]

        return work

    ddl = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return apply_arrow(docs, [text], ddl, make, keep)
