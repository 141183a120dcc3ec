"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from ledgerline.llm import queries, runs

from llm_helpers import SF, all_texts, nothing, tricky  # noqa: F401


def brute_runs(words, exponent=4, least=6):
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            smaller = lambda p: all(words[k] == words[k + p] for k in range(i, i + size - p))
            if j > i and size >= max(least, exponent * q) and not any(smaller(p) for p in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(found),
        *best,
        1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_lyndon_groups_hold_equal_longest_lyndon_words():
    random.seed(3)
    for _ in range(300):
        w = [random.randrange(3) for _ in range(random.randrange(1, 25))]
        group, length = runs.lyndon_groups(w)
        is_lyndon = lambda u: all(u < u[k:] for k in range(1, len(u)))
        words = [max((w[i:j] for j in range(i + 1, len(w) + 1) if is_lyndon(w[i:j])), key=len) for i in range(len(w))]
        assert [length[g] for g in group] == [len(u) for u in words]
        for i in range(len(w)):
            for j in range(i):
                assert (group[i] == group[j]) == (words[i] == words[j])


@pytest.mark.parametrize(("exponent", "least"), [(4, 6), (2, 2), (3, 5)])
def test_word_runs_match_search(exponent, least):
    random.seed(exponent)
    for _ in range(1500):
        n, k = random.randrange(45), random.choice([1, 2, 2, 3, 5])
        words = [b"%d" % random.randrange(k) for _ in range(n)]
        if n > 6:
            a = random.randrange(n)
            p = 1 + (n - a) // random.randint(3, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert runs.word_runs(words, exponent, least) == brute_runs(words, exponent, least)


def test_nested_runs_in_a_long_text():
    phrase = [b"a"] * 7 + [b"b", b"c", b"d"] * 5 + [b"e"]
    words = [b"%d" % i for i in range(500)] + phrase * 900 + [b"z"]
    found = runs.word_runs(words)
    assert (500, len(phrase) * 900, len(phrase)) in found
    assert sum(q == 1 for _, _, q in found) == 900 and sum(q == 3 for _, _, q in found) == 900
    assert runs.collapse(words, found).split() == words[:500] + [b"a", b"b", b"c", b"d", b"e", b"z"]


def test_query_matches_search_on_whole_texts(spark):
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    texts = all_texts(spark, SF)
    assert set(got) == set(texts)
    short = [d for d, t in texts.items() if len(t) < 9000]
    assert len(short) > 150
    for d in short:
        assert got[d] == brute_row(d, texts[d])


def test_odd_rows(spark, tricky, nothing):
    rows = tricky.withColumnRenamed("n_tokens", "runs").withColumnRenamed("kept", "collapsed")
    found = runs.find_runs(rows)
    assert found.columns == ["doc_id", "text", "source", "n_words", "runs", "collapsed"] and found.count() == rows.count()
    for r in found.collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode())
        assert r.n_words == len(words)
        assert [tuple(x) for x in r.runs] == runs.word_runs(words)
        assert r.collapsed.encode() == runs.collapse(words, [tuple(x) for x in r.runs])
    planted = queries.with_periodic_tails(tricky.select("doc_id", "text"))
    assert planted.count() == tricky.count()
    assert runs.find_runs(nothing).count() == 0
