"""Filters, duplicates and shards against brute force and against SQL."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_helpers import SF, TRICKY, all_texts, by_sql, nothing, tricky  # noqa: F401
from oracle_check import compare, connect

import corpus_pipeline
from ledgerline.llm import decontaminate, license_scan, line_dedup, quality, queries, sharding, simhash, sql, url_filter
from ledgerline.llm.graph import components, grown


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, key):
    status, detail = compare(queries.QUERIES[key](spark, SF), connect(SF), queries.ORACLE_SQL[key])
    assert status == "EXACT", detail


# urls


def glob_matches(pattern, text):
    if not pattern:
        return not text
    if pattern.startswith("**"):
        return any(glob_matches(pattern[2:], text[i:]) for i in range(len(text) + 1))
    if pattern[0] == "*":
        for i in range(len(text) + 1):
            if glob_matches(pattern[1:], text[i:]):
                return True
            if i < len(text) and text[i] == "/":
                return False
        return False
    if pattern[0] == "\\":
        pattern = pattern[1:]
    return bool(text) and pattern[0] == text[0] and glob_matches(pattern[1:], text[1:])


def test_automaton_against_recursion():
    draw = random.Random(1)
    patterns = ["".join(draw.choice(["a", "b", "/", "*", "**", "\\*"]) for _ in range(draw.randrange(0, 7))) for _ in range(150)]
    texts = ["".join(draw.choice("ab/*") for _ in range(draw.randrange(0, 9))) for _ in range(200)]
    hits = url_filter.Automaton(patterns).match([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for j, p in enumerate(patterns):
            assert hits[i, j] == glob_matches(p, t), (p, t)


def test_urls_edge_cases(spark):
    rows = [
        (None, None, None),
        ("no scheme", "", None),
        ("http://", "", None),
        ("HTTP://WWW.Example.COM/en/x?q#f", "www.example.com", "www.example.com/en/"),
        ("x://a.example.com/en/", "a.example.com", "example.com/en/"),
        ("x://aexample.com/en/", "aexample.com", "com/"),
        ("x://example.com/en", "example.com", "com/"),
        ("x://com", "com", None),
        ("x://net/fr/", "net", "net/fr/"),
        ("x://host:80#a://b/net/fr/", "host:80", None),
        ("x://" + "a" * 70_000 + ".com/" + "b" * 70_000, "a" * 70_000 + ".com", "com/"),
        ("x://ads-track.org/", "ads-track.org", None),
        ("x://É.Net/es/é", "É.net", "net/es/"),
    ]
    df = spark.createDataFrame([(i, u, "old") for i, (u, _, _) in enumerate(rows)], "page_id int, url string, verdict string")
    made = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    for i, (url, host, rule) in enumerate(rows):
        assert (made[i].host, made[i].rule) == (host or "", rule), url
        assert made[i].verdict == ("block" if not host or (rule or "").startswith(("net", "example")) or i == 11 else "allow")
    assert url_filter.filter_urls(df.where("false")).count() == 0


# licenses


def test_licenses_on_tricky_rows(tricky, nothing):
    made = license_scan.scan_licenses(tricky)
    assert made.count() == tricky.count() and license_scan.scan_licenses(nothing).count() == 0
    want = {r["doc_id"]: r for r in by_sql(sql.license_scan(license_scan.TEMPLATES), documents=[{"doc_id": i, "text": t} for i, t in enumerate(TRICKY)])}
    for r in made.where("doc_id is not null").collect():
        assert {k: v for k, v in r.asDict().items()} == want[r.doc_id]
    assert want[5]["n_base"] == 2 and want[8]["labels"] == "apache-2,apache-2-notice" and want[1]["n_words"] == 0


def test_licenses_tell_equal_ids_apart(spark):
    rows = [(1, "under the mit license"), (1, "cc by nc"), (1, "cc by nc"), (None, "apache license version 2")]
    made = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.base_labels) for r in made.collect()) == [(0, "apache-2"), (1, "cc-by-nc"), (1, "cc-by-nc"), (1, "mit")]


def test_licenses_with_words_put_in_or_left_out(spark):
    grant = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met".split()
    put = lambda at, n: " ".join([*grant[:at], *(f"acme{i}" for i in range(n)), *grant[at:]])
    rows = [
        "ACME CORP PAGE TWO OF NINE".join([" ".join(grant[:10]) + " ", " " + " ".join(grant[10:])]),
        put(10, 21),
        put(10, 22),                                        # beyond twice the template's length
        "before " * 9 + put(4, 3) + " between " * 30 + put(12, 8) + " after",
        " ".join(grant * 3),
        " ".join(grant[:8] + grant[12:]),
        " ".join(reversed(grant)),
    ]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    made = {r.doc_id: r.asDict() for r in license_scan.scan_licenses(docs).collect()}
    assert [made[i]["labels"] for i in range(7)] == ["bsd-grant", "bsd-grant", "", "bsd-grant", "bsd-grant", "bsd-grant", ""]
    want = by_sql(sql.license_scan(license_scan.TEMPLATES), documents=[{"doc_id": i, "text": t} for i, t in enumerate(rows)])
    assert made == {r["doc_id"]: r for r in want}


# lines


def test_lines_against_sql_and_edges(spark, nothing):
    draw = random.Random(3)
    common = ["shared footer", "  shared footer", "Cookie notice\t"]
    rows = []
    for i in range(120):
        lines = [f"own line {i} {k} with some more words" for k in range(draw.randrange(0, 4))] + draw.sample(common, draw.randrange(0, 3)) + [""]
        rows.append((i, None if i % 17 == 0 else "\n".join(lines), None if i % 13 == 0 else f"site{i % 9}", i))
    docs = spark.createDataFrame([*rows, rows[5], rows[5]], "doc_id long, text string, source string, n_lines int")
    made = line_dedup.drop_spread_lines(docs, min_sites=4).collect()
    assert len(made) == len(rows) + 2
    asked = [{"doc_id": i, "text": t, "source": s} for i, t, s, _ in rows]
    want = {r["doc_id"]: r for r in by_sql(sql.line_dedup(4), documents=asked)}
    for r in made:
        assert (r.n_lines, r.n_removed, r.text) == tuple(want[r.doc_id][k] for k in ("n_lines", "n_removed", "text"))
    assert sum(r.n_removed for r in made) > 20
    assert line_dedup.drop_spread_lines(nothing).count() == 0


@pytest.mark.parametrize("most", [0, line_dedup.MOST_SENT])
def test_every_boilerplate_line_goes(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST_SENT", most)
    names = "doc_id long, text string, source string, _key string, row int, drop string, h1 string"
    rows = [(i, f"own line {i}\nthis is the very long footer that all share\n  and another shared line of text\t", f"site{i}", "k", 7, "d", "h") for i in range(12)]
    rows += [(50, "and another shared line of text", "site1", "k", 7, "d", "h"), (51, None, None, None, None, None, None), (52, "", "s", "k", 1, "d", "h")]
    made = {r.doc_id: r for r in line_dedup.drop_spread_lines(spark.createDataFrame([*rows, rows[3]], names)).collect()}
    assert [made[i].text for i in range(12)] == [f"own line {i}" for i in range(12)] and sum(made[i].n_removed for i in range(12)) == 24
    assert (made[50].text, made[50].n_removed, made[51].text, made[51].n_lines, made[52].text, made[52].n_lines) == ("", 1, None, 0, "", 1)
    assert made[0][3:7] == ("k", 7, "d", "h")


def test_sites_near_the_threshold_are_counted_exactly(spark):
    rows = [(s * 1000 + i, f"line {i} on {n} sites\nunique {s} {i} and a few more words here", f"s{s}") for i, n in enumerate(range(90, 112)) for s in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = line_dedup.spread_lines(docs, min_sites=100)
    assert found.count() == sum(n >= 100 for n in range(90, 112))


# near duplicates


def fingerprint(text, words=3):
    split = (text or "").encode().lower().split()
    shingles = [b" ".join(split[i : i + words]) for i in range(len(split) - words + 1)] or ([b" ".join(split)] if split else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, near):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in combinations(range(len(values)), 2):
        if near(values[i], values[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_op5_against_all_pairs(spark):
    texts = dict(sorted(all_texts(spark, SF).items()))
    prints = [fingerprint(t) for t in texts.values()]
    ids = list(texts)
    lows = [ids[r] for r in classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)]
    want = {i: (f"{p:016x}", low) for i, p, low in zip(ids, prints, lows)}
    assert {r[0]: tuple(r[1:]) for r in queries.op5_simhash_near_dedup(spark, SF).collect()} == want


def test_links_join_what_all_pairs_join(spark):
    draw = random.Random(9)
    values = set()
    for _ in range(12):  # crowds that share chains, among strangers
        base = draw.getrandbits(64)
        values |= {base ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(0, 5))) for _ in range(40)}
    values |= {draw.getrandbits(64) for _ in range(300)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame([(v,) for v in values], "v long")
    made = {r.node: r.root for r in components(simhash.near_links(nodes)).collect()}
    want = classes(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert [made.get(v, v) for v in values] == [values[r] for r in want]


def test_near_duplicates_on_tricky_rows(tricky, nothing):
    made = simhash.near_duplicates(tricky)
    assert made.count() == tricky.count() and simhash.near_duplicates(nothing).count() == 0
    by_id = {r.doc_id: r for r in made.collect() if r.doc_id is not None}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[2].fingerprint == "0" * 16
    assert by_id[2].component_id == 0 and by_id[16].component_id == 15
    assert all(r.fingerprint == f"{fingerprint(TRICKY[i]):016x}" for i, r in by_id.items())


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    made = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(made.values()) == {0, 100} and made[60] == 0 and made[139] == 100


def test_components_of_few_links_leave_few_files(spark):
    """Rounds have tasks by their links, not by the shuffle partitions; groups known before count as links."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        made = components(spark.createDataFrame([(i, i + 1) for i in range(0, 200, 2)], "a long, b long"))
        more = grown(made, spark.createDataFrame([(0, 198), (300, 301)], "a long, b long"))
        assert len(made.inputFiles()) == len(more.inputFiles()) == 1
        found = {r.node: r.root for r in more.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found[198] == found[199] == 0 and found[301] == 300 and len(found) == 102


def test_ring_filter_keeps_all_within_budget():
    draw = np.random.default_rng(2)
    boxes = draw.integers(0, 4, (3000, 16))
    held = simhash.ring_holds(boxes, 20)
    assert held[boxes.sum(axis=1) <= 20].all() and not held.all()


def test_keep_one(spark, tricky, nothing):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    base = [[draw.choice(words) for _ in range(300)] for _ in range(12)]
    rows = []
    for g, text in enumerate(base):
        rows.append((g * 10, " ".join(text)))
        rows.append((g * 10 + 1, " ".join(text)))
        for k in range(2, 6):  # three changed words of 300: similarity about 0.9
            edited = list(text)
            for at in draw.sample(range(300), 3):
                edited[at] = "changed"
            rows.append((g * 10 + k, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [g * 10 for g in range(12)]
    kept = simhash.keep_one(tricky)
    assert kept.columns == tricky.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and not {1, 2, 16} & set(ids)
    assert simhash.keep_one(nothing).count() == 0


def test_keep_one_finds_pairs_near_the_threshold_among_shared_passages(spark):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(20000)]
    passage = [draw.choice(words) for _ in range(70)]  # in every text
    rows = []
    for g in range(300):
        text = [draw.choice(words) for _ in range(280)] + passage
        edited = list(text)
        for at in draw.sample(range(10, 280, 8), 7):  # 35 of 346 shingles change: similarity about 0.82
            edited[at] = "changed"
        rows += [(2 * g, " ".join(text)), (2 * g + 1, " ".join(edited))]
    left = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {2 * g for g in range(300)} <= left and len(left) <= 303


def test_keep_one_finds_pairs_made_of_a_passage_that_many_quote(spark):
    draw = random.Random(7)
    some = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    rows = []
    for g in range(3):
        passage = some(204)
        rows += [(g * 10_000 + k, " ".join(passage + some(20))) for k in range(2)]  # 200 of 240 shingles: similarity 0.83
        rows += [(g * 10_000 + 10 + k, " ".join(some(75) + passage + some(75))) for k in range(3000)]
    left = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, _ in rows} - left == {g * 10_000 + 1 for g in range(3)}


def test_keep_one_finds_pairs_among_many_of_one_form(spark):
    draw = random.Random(8)
    some = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    rows = []
    for g in range(6):
        form = some(324)
        rows += [(g * 1000 + 10 + k, " ".join(form + some(76))) for k in range(400)]  # similarity 0.68 to each other
        first = form + some(76)
        rows += [(g * 1000, " ".join(first)), (g * 1000 + 1, " ".join(first[:-28] + some(28)))]  # 0.87
    left = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = {i for i, _ in rows} - left
    assert {g * 1000 + 1 for g in range(6)} <= gone and len(gone) <= 0.03 * len(rows)  # the distance is an estimate


# test items


def test_overlap_edges(spark, tricky, nothing):
    items = [(1, TRICKY[15]), (2, "one two three"), (2, "one two three"), (None, "lambda mu nu"), (3, None), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    made = {r.doc_id: r for r in decontaminate.find_overlap(tricky, bench).collect() if r.doc_id is not None}
    assert made[15].n_hit == 21 and made[15].items == ["", "1"]
    assert made[12].n_hit == 12 and made[12].items == ["2"] and made[1].n_words == 0
    split = {r.doc_id: r for r in decontaminate.find_overlap(tricky, bench, set_windows=8).collect() if r.doc_id is not None}
    assert all((split[i].n_hit, split[i].items, split[i].spans) == (r.n_hit, r.items, r.spans) for i, r in made.items())
    assert decontaminate.find_overlap(nothing, bench).count() == 0
    assert decontaminate.find_overlap(tricky, bench.where("false")).where("n_hit > 0").count() == 0


def test_item_sets_stay_small_with_copies_and_long_items(spark, monkeypatch):
    draw = random.Random(5)
    long = " ".join(f"w{draw.randrange(400)}" for _ in range(600))
    shared = "One passage, that MANY items quote: a b c d e f g"
    bench = spark.createDataFrame([(0, long)] + [(1, shared)] * 200 + [(k, shared) for k in range(2, 120)] + [(500, None), (501, "")], "item_id long, text string")
    some = long.split()
    texts = [" ".join(some[k : k + 15]) for k in range(0, 580, 60)] + ["x " + shared.upper() + " y", "clean", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: r for r in decontaminate.find_overlap(docs, bench).collect()}
    made, sizes = decontaminate.NgramSet.__init__, []
    monkeypatch.setattr(decontaminate.NgramSet, "__init__", lambda self, items, window: sizes.append(len(items)) or made(self, items, window))
    split = {r.doc_id: r for r in decontaminate.find_overlap(docs, bench, set_windows=300).collect()}
    assert len(sizes) > 3 and max(sizes) <= 330
    assert all((split[i].n_words, split[i].spans, split[i].items) == (r.n_words, r.spans, r.items) for i, r in whole.items())
    assert len(whole[10]["items"]) == 119 and whole[0].n_hit == 15


def test_decontaminate_cuts_or_drops(spark):
    item = "q w e r t y u i o p"
    docs = spark.createDataFrame([(1, "Öpen, (q w e r t y u i o p)! " + "end " * 30), (2, item), (3, "clean"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == [3, 4]
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, max_share=0.5).collect()}
    assert cut == {1: "Öpen, ()! " + "end " * 30, 3: "clean", 4: None}


# shards


def test_op7_against_brute_force(spark):
    texts = dict(sorted(all_texts(spark, SF).items()))
    total, end, seen, want = sum(len(t.encode()) + 1 for t in texts.values()), 0, {}, {}
    for k, t in texts.items():
        size = len(t.encode()) + 1
        end += size
        shard = (2 * end - size) * 8 // (2 * total)
        want[k] = (size, zlib.crc32(t.encode()), "bytes", shard, seen.get(shard, 0), None)
        seen[shard] = seen.get(shard, 0) + 1
    assert {r[0]: tuple(r[1:]) for r in queries.op7_sharding(spark, SF).collect()} == want


def test_shards_with_ties_nulls_and_clashing_names(spark):
    rows = [(None if i % 7 == 0 else i % 3, 5, i) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, size long, slot int")
    made = sharding.assign_shards(df, 4, parts=6).collect()
    assert len(made) == 500
    for s in range(4):
        slots = sorted(r.slot for r in made if r.shard == s)
        assert slots == list(range(125))
    assert sharding.assign_shards(df.where("false"), 4, parts=2).count() == 0
    assert sorted({r.shard for r in sharding.assign_shards(df.limit(1), 4, parts=2).collect()}) == [2]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_near_copies_are_decided_at_the_threshold_itself(spark, monkeypatch, bucket):
    """Pairs at 0.8 and just below, on short and long texts, with crowds, passages that many quote, and texts without words."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    draw = random.Random(bucket)
    word = lambda: f"w{draw.randrange(10**6)}"
    texts = [None, "", " \n", "one", "ONE"]
    for n, cut in ((9, 1), (16, 3), (29, 5), (60, 12), (304, 60)):
        for _ in range(12):
            own = [word() for _ in range(n)]
            for more in (cut - 1, cut, cut + 1):  # n - 4 shingles, of which the copy lacks some: about 0.8
                texts += [" ".join(own), " ".join(own[: n - more])]
            texts.append(" ".join(own[:-1] + [word()]))
    passage = [word() for _ in range(80)]
    texts += [" ".join(passage + [word() for _ in range(draw.randrange(2, 60))]) for _ in range(90)]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    near = lambda a, b: a == b or (len(a & b) >= 0.8 * len(a | b) - 1e-9)
    want = set(classes(sets, near))
    names = "doc_id long, text string, _text_key string, row string, mark int, _doc int"
    rows = [(i, t, "k", "r", 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[7], rows[0], (None, texts[9], "k", "r", 1, 2)], names).repartition(4)
    made = simhash.keep_one(docs)
    assert made.columns == docs.columns
    found = made.collect()
    assert sorted(r.doc_id for r in found) == sorted(want) and {tuple(r)[2:] for r in found} == {("k", "r", 1, 2)}
    assert simhash.keep_one(docs.where("false")).count() == 0


# quality


def test_quality_on_tricky_rows(tricky, nothing):
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    made = quality.judge(tricky, report=shown)
    assert made.columns.count("kept") == 1 and quality.judge(nothing, report=shown).count() == 0
    want = {r["doc_id"]: r for r in by_sql(sql.QUALITY, documents=[{"doc_id": i, "text": t} for i, t in enumerate(TRICKY)])}
    for r in made.where("doc_id is not null").collect():
        assert {k: r[k] for k in (*shown, "base_failed", "kept")} == {k: want[r.doc_id][k] for k in (*shown, "base_failed", "kept")}
    assert made.count() == tricky.count()
    dropped = quality.drop_low_quality(tricky)
    assert dropped.columns == tricky.columns and {r.doc_id for r in dropped.collect()} == {i for i, r in want.items() if r["kept"]}


def test_cascade_order_follows_rejections(tricky):
    never = quality.Rule("never", ("n_repeat_words",), lambda n: n < 0)
    always = quality.Rule("always", ("n_words",), lambda n: n >= 0)
    assert quality.cascade_order(tricky, [never, always]) == [1, 0]


# pipeline


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near dedup", "decontamination", "bpe"]
    rows = [r.asDict() for r in docs.collect()]
    good = {r["doc_id"] for r in by_sql(f"SELECT doc_id FROM ({sql.QUALITY}) WHERE kept", documents=rows)}
    first = corpus_pipeline.keep_quality(spark, docs, SF)
    assert {r.doc_id for r in first.collect()} == good and first.columns == docs.columns
    kept = [r for r in rows if r["doc_id"] in good]
    second = corpus_pipeline.drop_lines(spark, first, SF)
    want = {r["doc_id"]: r["text"] for r in by_sql(sql.line_dedup(line_dedup.MIN_SITES), documents=kept)}
    assert {r.doc_id: r.text for r in second.collect()} == want and second.columns == docs.columns
    third = corpus_pipeline.drop_near_copies(spark, second, SF)
    left = {r.doc_id for r in third.collect()}

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    ids = sorted(want)
    sets = [shingles(want[i]) for i in ids]

    def similar(share):
        return classes(sets, lambda a, b: min(len(a), len(b)) >= share * max(len(a), len(b)) and len(a & b) >= share * len(a | b))

    assert left == {ids[r] for r in similar(0.8)}
    fourth = corpus_pipeline.drop_test_items(spark, third, SF)
    bench = [r.asDict() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    asked = [{"doc_id": i, "text": want[i]} for i in left]
    clean = {r["doc_id"] for r in by_sql(f"SELECT doc_id FROM ({sql.DECONTAMINATION}) WHERE NOT contaminated", documents=asked, benchmark=bench)}
    assert {r.doc_id for r in fourth.collect()} == clean and fourth.columns == docs.columns
    fifth = corpus_pipeline.encode(spark, fourth, SF).collect()
    assert {r.doc_id for r in fifth} == clean and all(r.restored and len(r.ids) == 4 * r.n_tokens for r in fifth)


def test_pipeline_runs_whole(spark):
    assert queries.pipeline(spark, SF).columns == ["doc_id", "n_tokens", "ids", "restored"]
