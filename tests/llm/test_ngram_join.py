"""The n-gram similarity join against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from ledgerline.llm import ngram_join, queries

from llm_helpers import SF, TRICKY, all_texts, nothing, sorted_rows, tricky  # noqa: F401


def brute_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()


def brute_rows(texts, words=4, percent=85):
    sets = {d: brute_set(t, words) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(d for d in sets if sets[d]), 2):
        x, y = sets[a], sets[b]
        if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted(((d, len(sets[d]), find(d)) for d in texts), key=repr)


def run(spark, texts, **more):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    return sorted_rows(ngram_join.similar_components(df, **more), "doc_id", "n_shingles", "component_id")


def test_query_matches_all_pairs(spark):
    got = sorted_rows(queries.op12_ngram_jaccard_join(spark, SF), "doc_id", "n_shingles", "component_id")
    assert got == brute_rows(all_texts(spark, SF))


@pytest.fixture
def crowded():
    """Near copies at all distances from each other, quotes of one passage, equal sets in other words, and short texts."""
    random.seed(11)
    word = lambda: f"w{random.randrange(4000)}"
    texts, passage = {}, [word() for _ in range(120)]
    for size in (9, 30, 140):
        base = [word() for _ in range(size)]
        for _ in range(40):
            texts[len(texts)] = " ".join(word() if random.random() < 0.6 / (size**0.5 * 4) else w for w in base)
    for k in range(60):  # texts made of the passage and little of their own: about as many link as do not
        texts[len(texts)] = " ".join(passage[k % 7 :] + [word() for _ in range(6 + k % 9)])
    for k in range(60):  # the passage inside much else
        texts[len(texts)] = " ".join([word() for _ in range(200)] + passage)
    texts |= {len(texts) + k: t for k, t in enumerate(["One two THREE four five", "one  two three\tfour five"] * 20 + TRICKY + ["", " ", None])}
    return texts


@pytest.mark.parametrize("bucket", [ngram_join.BUCKET, 2])
def test_crowds_match_all_pairs(spark, crowded, monkeypatch, bucket):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "CELL", 7)
    expected = brute_rows(crowded)
    assert 20 < len({c for _, _, c in expected}) < len(crowded) - 60
    assert run(spark, crowded) == expected


def made_rows(node):
    """Rows that the executed plan's Generate nodes made."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return made_rows(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return made_rows(node.plan())
    own = node.metrics().apply("numOutputRows").value() if kind == "GenerateExec" else 0
    return own + sum(made_rows(node.children().apply(k)) for k in range(node.children().size()))


def test_blocks_of_a_crowd_are_not_copied_per_id(spark):
    n, rng = 300, np.random.default_rng(8)
    grams = [np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64)) for _ in range(n)]
    for k in range(0, n, 30):  # some that counters cannot tell apart
        grams[k + 1] = grams[k]
    sets = spark.createDataFrame([(k, 40, bytearray(ngram_join.counters(g))) for k, g in enumerate(grams)], "id long, n long, counters binary")
    rows = spark.createDataFrame([(7, k, 40, 0, k) for k in range(n)], "gram long, id long, n long, pos int, colour long")
    pairs = ngram_join._block_pairs(rows, sets, 85)
    found = {(r.a, r.b) for r in pairs.collect()}
    coarse = ngram_join._coarse(np.stack([np.frombuffer(ngram_join.counters(g), np.uint8) for g in grams]))
    size = np.array([40])
    assert found == {(a, b) for a in range(n) for b in range(a) if ngram_join.room(coarse[a][None], coarse[b][None], size, size, 85)[0] >= 0}
    assert {(k + 1, k) for k in range(0, n, 30)} <= found
    assert made_rows(pairs._jdf.queryExecution().executedPlan()) < n


def test_blocks_give_only_pairs_that_fine_counters_leave(spark):
    """Sets alike in every coarse counter: compared on those alone, each pair of them would be a row."""
    n, rng = 120, np.random.default_rng(9)
    grams = [np.arange(40, dtype=np.uint64) + np.uint64(ngram_join.COARSE) * rng.integers(0, 4, 40).astype(np.uint64) for _ in range(n)]
    for k in range(0, n, 30):
        grams[k + 1] = grams[k]
    sets = spark.createDataFrame([(k, 40, bytearray(ngram_join.counters(g))) for k, g in enumerate(grams)], "id long, n long, counters binary")
    for cell in (ngram_join.CELL, 50):
        rows = spark.createDataFrame([(7, k, 40, 0, k) for k in range(n)], "gram long, id long, n long, pos int, colour long")
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ngram_join, "CELL", cell)
            found = ngram_join._block_pairs(rows, sets, 85).collect()
        assert {(r.a, r.b) for r in found} == {(k + 1, k) for k in range(0, n, 30)}


def test_many_pairs_are_tried_likeliest_first(spark, crowded, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", 2)
    monkeypatch.setattr(ngram_join, "FEW_PAIRS", 0)
    texts = {d: t for d, t in crowded.items() if d % 2}
    assert run(spark, texts) == brute_rows(texts)


def test_other_sizes_and_order_without_frequent_grams(spark, crowded, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_OFTEN", 0)
    texts = {d: t for d, t in crowded.items() if d % 3}
    assert run(spark, texts, words=5, percent=80) == brute_rows(texts, 5, 80)


def test_word_hashes_stay_few(monkeypatch):
    monkeypatch.setattr(ngram_join, "KNOWN_WORDS", 50)
    known = ngram_join.WordHashes()
    text = " ".join(f"w{k % 70}" for k in range(300)).encode()
    assert (ngram_join.gram_set(text, 4, known) == ngram_join.gram_set(text, 4, ngram_join.WordHashes())).all() and len(known) <= 50


def test_order_puts_frequent_grams_last_and_fragments_cover_a_set():
    grams = np.sort(np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2))
    order = ngram_join.Order(grams[::5], np.random.default_rng(2).permutation(100), np.array([20, 50, 70]))
    first = order.first(grams, 450)
    assert set(first[:400]) == set(grams) - set(grams[::5]) and list(order.places(first[400:])) == list(range(50))
    parts = order.fragments(grams)
    assert parts.min() >= 0 and parts.max() < ngram_join.FRAGMENTS
    assert (parts[::5] >= ngram_join.FRAGMENTS - ngram_join.HOT_FRAGMENTS).all() and len(set(parts)) == ngram_join.FRAGMENTS


def test_counters_bound_the_overlap():
    rng = np.random.default_rng(4)
    for n in (3, 50, 400, 60_000):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.concatenate((x[: int(n * 0.93)], rng.integers(0, 2**63, n - int(n * 0.93), dtype=np.uint64))))
        common = len(np.intersect1d(x, y))
        a, b = (np.frombuffer(ngram_join.counters(s), np.uint8)[None] for s in (x, y))
        if 185 * common >= 85 * (len(x) + len(y)):
            assert (ngram_join.room(a, b, np.array([len(x)]), np.array([len(y)]), 85) >= 0).all()


def test_odd_rows(spark, tricky, nothing):
    made = ngram_join.similar_components(tricky)
    assert made.columns == ["doc_id", "n_shingles", "component_id"] and made.count() == tricky.count()
    by_id = {r.doc_id: r for r in made.collect() if r.doc_id is not None}
    for d, t in enumerate(TRICKY):
        assert by_id[d].n_shingles == len(brute_set(t, 4))
    assert by_id[16].component_id == 15 and by_id[0].component_id == 0 and by_id[1].component_id == 1
    assert ngram_join.similar_components(nothing).count() == 0
