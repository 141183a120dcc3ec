"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are measured on a bounded sample of rows;
the rules then run in the order of rejections per second, each only on the rows
that all rules before it let through. The order changes the time, never the
verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apply_arrow, as_bytes, named, packed, unpacked

BLANKS = b" \t\n\x0b\x0c\r"
_TAILS = bytes(range(0x80, 0xC0))
WINDOW = 8
SAMPLE_ROWS = 2_000


class Texts:
    """Features of a batch of texts, each computed for the rows that ask for it and then kept."""

    def __init__(self, raw: Sequence[bytes]):
        self.raw = raw
        self._words: dict[int, list[bytes]] = {}
        self._values: dict[str, dict[int, int]] = {}

    def words(self, i: int) -> list[bytes]:
        if i not in self._words:
            self._words[i] = self.raw[i].split()
        return self._words[i]

    def get(self, feature: str, rows: Sequence[int]) -> np.ndarray:
        known = self._values.setdefault(feature, {})
        new = [i for i in rows if i not in known]
        if new:
            known.update(zip(new, FEATURES[feature](self, new)))
        return np.fromiter((known[i] for i in rows), np.int64, len(rows))


def _repeat_words(texts: Texts, rows: Sequence[int]) -> list[int]:
    """Words inside windows of eight words that a text holds at least twice.

    Windows get exact numbers by doubling: a window of 2n words is numbered by the
    numbers of its two halves.
    """
    splits = [texts.words(i) for i in rows]
    sizes = np.array([len(s) for s in splits])
    if not sizes.sum():
        return [0] * len(rows)
    numbers: dict[bytes, int] = {}
    number = np.fromiter((numbers.setdefault(w, len(numbers)) for s in splits for w in s), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(rows)), sizes)
    span = 1
    while span < WINDOW and len(number) > span:
        pair = number[:-span] * (int(number.max()) + 1) + number[span:]
        number = np.unique(pair, return_inverse=True)[1]
        span *= 2
    if span < WINDOW:
        return [0] * len(rows)
    inside = doc[: len(number)] == doc[WINDOW - 1 :]
    at = np.flatnonzero(inside)
    _, which, count = np.unique(doc[at] * (int(number.max()) + 1) + number[at], return_inverse=True, return_counts=True)
    again = at[count[which] > 1]
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return np.bincount(doc[covered], minlength=len(rows)).tolist()


def _dup_lines(texts: Texts, rows: Sequence[int]) -> list[int]:
    out = []
    for i in rows:
        lines = [x for x in texts.raw[i].split(b"\n") if x.strip(BLANKS)]
        out.append(len(lines) - len(set(lines)))
    return out


FEATURES: dict[str, Callable[[Texts, Sequence[int]], Sequence[int]]] = {
    "n_words": lambda t, rows: [len(t.words(i)) for i in rows],
    "word_chars": lambda t, rows: [len(t.raw[i].translate(None, BLANKS + _TAILS)) for i in rows],
    "n_symbols": lambda t, rows: [len(t.raw[i]) - len(t.raw[i].translate(None, b"#*$%&|<>")) for i in rows],
    "n_marks": lambda t, rows: [t.raw[i].count(b"!") + t.raw[i].count(b"?") for i in rows],
    "n_lines": lambda t, rows: [sum(1 for x in t.raw[i].split(b"\n") if x.strip(BLANKS)) for i in rows],
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the named features, as arrays, to the rows that the rule rejects."""

    name: str
    features: tuple[str, ...]
    fails: Callable[..., np.ndarray]


BASE_RULES = (
    Rule("short", ("n_words",), lambda n: n < 20),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 30 * n),
)
RULES = (
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("shouting", ("n_words", "n_marks"), lambda n, m: 2 * m > n),
    Rule("same lines", ("n_lines", "n_dup_lines"), lambda n, d: 2 * d > n),
    Rule("word length", ("n_words", "word_chars"), lambda n, c: (c > 20 * n) | (c < 2 * n)),
)


def cascade_order(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[int]:
    """Indexes of the rules by rejections per second on about ``rows`` sampled rows."""
    total = docs.count()
    if not total:
        return list(range(len(rules)))
    sample = docs.select(named(text).alias("text")).sample(min(1.0, rows / total), seed=11)

    def run(batches):
        for batch in batches:
            raw = as_bytes(batch.column(0))
            everyone = list(range(len(raw)))
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                fresh = Texts(raw)
                lost = int(np.sum(rule.fails(*[fresh.get(f, everyone) for f in rule.features])))
                spent = time.perf_counter() - began
                yield pa.RecordBatch.from_pydict({"k": [k], "lost": [lost], "spent": [spent]})

    found = sample.mapInArrow(run, "k long, lost long, spent double").groupBy("k").agg(F.sum("lost").alias("lost"), F.sum("spent").alias("spent"))
    gain = {r.k: r.lost / max(r.spent, 1e-9) for r in found.collect()}
    return sorted(range(len(rules)), key=lambda k: (-gain.get(k, 0.0), k))


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = BASE_RULES + RULES,
    base: Sequence[Rule] = BASE_RULES,
    report: Sequence[str] = (),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the features of ``report``, ``base_failed`` and ``kept`` to every row.

    ``report`` features are computed for all rows; a rule's other features only
    for rows that no earlier rule of the cascade rejected. base_failed tells
    whether a base rule rejects the row (null unless ``report`` holds all features
    of the base rules). A null text has no words and fails; repeated rows are judged
    alike; columns of the same names are replaced.
    """
    ordered = [rules[k] for k in cascade_order(docs, rules, text)]
    told = {f for r in base for f in r.features} <= set(report)
    ddl = ", ".join([*(f"{f} long" for f in report), "base_failed boolean", "kept boolean"])

    def make():
        def work(column):
            texts = Texts(as_bytes(column))
            everyone = list(range(len(column)))
            out = [pa.array(texts.get(f, everyone), pa.int64()) for f in report]
            failed = [r.fails(*[texts.get(f, everyone) for f in r.features]) for r in base] if told else []
            alive = np.arange(len(column))
            for rule in ordered:
                rows = alive.tolist()
                alive = alive[~rule.fails(*[texts.get(f, rows) for f in rule.features])]
            kept = np.zeros(len(column), bool)
            kept[alive] = True
            lost = reduce(np.logical_or, failed, np.zeros(len(column), bool))
            return [*out, pa.array(lost if told else [None] * len(column), pa.bool_()), pa.array(kept, pa.bool_())]

        return work

    return apply_arrow(docs, [text], ddl, make, keep)


def drop_low_quality(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = BASE_RULES + RULES) -> DataFrame:
    """The rows that no rule rejects, with their own columns."""
    verdict = judge(packed(docs, text=text), "text", rules, keep=["row"])
    return verdict.where("kept").select(*unpacked(docs.columns))
