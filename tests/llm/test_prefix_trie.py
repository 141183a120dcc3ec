"""The prefix trie against a trie of nested dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import prefix_trie, queries

from llm_helpers import SF, sorted_rows

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_trie(convs):
    """Rows for {conv_id: [(role, text), ...]}."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    rows = [
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], sha(ends[n])) for n, m in members.items()
    ]
    return sorted(rows, key=repr)


def by_conversation(rows):
    """Turns in order, null first; of equal turns the digest's order does not matter where the rows are equal."""
    convs = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0)):
        if r.conv_id is not None:
            convs[r.conv_id].append((r.role or "", r.text or ""))
    return convs


def opened(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def test_query_matches_nested_dictionaries(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    assert sorted_rows(queries.op13_prefix_trie(spark, SF), *COLUMNS) == brute_trie(opened(by_conversation(rows)))


def test_openings_of_absent_and_short_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (3, 5, 20, 21, 22, 23, 24, 25, 26, 27, 39, 40, 47) for t in range(2 if c == 20 else 1 + c % 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = opened(by_conversation(df.collect()))
    assert any(not turns for turns in expected.values())
    made = prefix_trie.trie_of(queries.with_common_openings(df), df.select("conv_id"))
    assert sorted_rows(made, *COLUMNS) == brute_trie(expected)


def test_long_chains_hot_openings_and_one_endless_conversation(spark):
    random.seed(5)
    rows = []
    for c in range(120):
        same = 60 if c % 3 else 2
        n = 400 if c == 7 else 61 + c % 5 if c % 3 else random.randrange(1, 5)
        rows += [(c, t, "user" if t % 2 else "bot", f"w {t} x" if t < same else f"own {c} {t}") for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert sorted_rows(prefix_trie.prefix_trie(df), *COLUMNS) == brute_trie(by_conversation(df.collect()))


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [
        (1, None, None, None, 1), (1, 0, "a", "b c", 2), (1, 1, "a", "", 3), (2, 5, "", None, 4), (2, 7, "a", "b c", 5), (2, 9, "a", "", 6),
        (3, 0, "ab", "c", 7), (4, 0, "a", "bc", 8), (5, 1, "x", "y", 9), (5, 1, "x", "y", 9), (None, 0, "a", "b", 1), (6, None, "x", "y  y", 0),
    ]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, depth int").withColumns({"p1": F.lit(1), "s1": F.lit("s"), "_above": F.lit(2)})
    made = prefix_trie.prefix_trie(df)
    assert made.columns == list(COLUMNS)
    assert sorted_rows(made, *COLUMNS) == brute_trie(by_conversation(df.collect()))
    more = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, 5, 6, 100, 99, None)], "conv_id long")
    with_empty = by_conversation(df.collect()) | {100: [], 99: []}
    assert sorted_rows(prefix_trie.prefix_trie(df, more), *COLUMNS) == brute_trie(with_empty)
    assert prefix_trie.prefix_trie(df.where("false")).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "caterpillar", "random", "two tops"])
def test_contraction_gives_subtree_sums(spark, shape):
    random.seed(8)
    n = 150
    parent = {
        "path": lambda v: v - 1, "star": lambda v: 0, "caterpillar": lambda v: v - 1 if v % 2 else v - 2,
        "random": lambda v: random.randrange(v), "two tops": lambda v: v - 2,
    }[shape]
    up = {v: parent(v) if v > (1 if shape == "two tops" else 0) else None for v in range(n)}
    up = {v: p if p is None or p >= 0 else 0 for v, p in up.items()}
    totals = {v: [1, v] for v in range(n)}
    for v in range(n - 1, -1, -1):
        if up[v] is not None:
            totals[up[v]] = [a + b for a, b in zip(totals[up[v]], totals[v])]
    df = spark.createDataFrame([(v, p, 1, v) for v, p in up.items()], "v long, p long, leaves long, saved long")
    node = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("x"), (F.col(c) * 3).alias("y")))
    got = prefix_trie.subtree_totals(df.select(node("v").alias("id"), node("p").alias("parent"), "leaves", "saved"))
    assert {r.id.x: [r.leaves, r.saved] for r in got.collect()} == totals
