"""BPE, counts and files against the tokenizers library itself."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF, TRICKY, all_texts, nothing, sorted_rows, tricky  # noqa: F401
from tokenizers import Tokenizer

from ledgerline.llm import bpe, queries, token_count, token_files
from ledgerline.llm.pretokens import pieces, split_bytes

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path, texts):
    tool = Tokenizer.from_file(path)
    tool.no_truncation()
    tool.no_padding()
    return [e.ids for e in tool.encode_batch(list(texts), add_special_tokens=False)]


def noise(n):
    draw = random.Random(4)
    return ["".join(draw.choice(" aab'ts\n\t\x1f\x85é1²_-<|>日　İΣ") for _ in range(50)) for _ in range(n)]


def test_ids_equal_the_library():
    texts = [t or "" for t in TRICKY] + noise(400)
    made = [np.frombuffer(i, "<u4").tolist() for i in bpe.ByteBpe(BYTES, 50).encode(texts)]
    assert made == library(BYTES, texts)


def test_cache_stays_small_and_goes_with_its_task(monkeypatch):
    texts = [" ".join(f"q{k * 7 + j}z" for j in range(40)) for k in range(60)]
    tool = bpe.ByteBpe(BYTES, 100)
    monkeypatch.setattr(bpe, "PART", 500)
    made = [np.frombuffer(i, "<u4").tolist() for i in tool.encode(texts)]
    assert made == library(BYTES, texts)
    assert len(tool.cache.young) <= 200 and len(tool.cache.old) <= 200
    other = tool.fresh()
    assert not other.cache.young and other.table is tool.table and other.encode(texts[:3]) == tool.encode(texts[:3])


def test_word_ids_equal_the_library():
    texts = [t or "" for t in TRICKY] + noise(400)
    tool = token_files.WordBpe(WORDS, 50)
    assert [np.frombuffer(i, tool.type).tolist() for i in tool.encode(texts)] == library(WORDS, texts)


def test_decoding_restores_every_text():
    texts = [t or "" for t in TRICKY] + noise(100)
    tool = bpe.ByteBpe(BYTES)
    assert tool.decode(tool.encode(texts)) == texts


def test_pieces_split_like_the_whole():
    text = "don't stop  now\n é1 'tis " * 500
    cut = list(pieces(text, 64))
    assert len(cut) > 50 and "".join(cut) == text
    assert [w for p in cut for w in split_bytes(p)] == split_bytes(text)


def test_round_trip_on_tricky_rows(tricky, nothing):
    made = bpe.round_trip(tricky, BYTES)
    assert made.columns == ["doc_id", "text", "source", "kept", "ids", "n_tokens", "decoded"]
    for r in made.collect():
        assert r.decoded == (r.text or "") and r.n_tokens == len(r.ids) // 4
    assert made.count() == tricky.count() and bpe.round_trip(nothing, BYTES).count() == 0
    again = bpe.decode(bpe.encode(tricky, BYTES), BYTES)
    assert sorted_rows(again, "decoded") == sorted_rows(made, "decoded")


def test_op2_against_the_library(spark):
    texts = all_texts(spark, SF)
    ids = dict(zip(texts, library(BYTES, texts.values())))
    tool = Tokenizer.from_file(BYTES)
    want = {
        k: (len(v), hashlib.sha256(np.array(v, "<u4").tobytes()).hexdigest(), hashlib.sha256(tool.decode(v, skip_special_tokens=False).encode()).hexdigest())
        for k, v in ids.items()
    }
    assert {r[0]: tuple(r[1:]) for r in queries.op2_bpe_round_trip(spark, SF).collect()} == want


def test_op9_against_the_library(spark):
    texts = all_texts(spark, SF)
    want = {k: (len(texts[k].encode()), len(v), len(v) > 512) for k, v in zip(texts, library(BYTES, texts.values()))}
    assert {r[0]: tuple(r[1:]) for r in queries.op9_token_counts(spark, SF).collect()} == want


def test_counts_on_tricky_rows(tricky, nothing):
    want = dict(zip(TRICKY, map(len, library(BYTES, [t or "" for t in TRICKY]))))
    made = token_count.count_tokens(tricky, BYTES)
    assert made.columns.count("n_tokens") == 1
    for r in made.where("doc_id is not null").collect():
        assert r.n_tokens == want[r.text]
    assert token_count.count_tokens(nothing, BYTES).count() == 0


def test_packed_table():
    packed = token_count.pack([" the", "é", ""], [1, 2, 0])
    assert token_count.unpack(packed) == {" the": 1, "é": 2, "": 0}


def test_op10_against_the_library(spark):
    texts = dict(sorted(all_texts(spark, SF).items()))
    want, start = {}, 0
    for k, ids in zip(texts, library(WORDS, texts.values())):
        whole = np.array([*ids, 2], "<u4").tobytes()
        want[k] = (start, len(ids) + 1, zlib.crc32(whole))
        start += len(ids) + 1
    assert {r[0]: tuple(r[1:]) for r in queries.op10_token_files(spark, SF).collect()} == want


def test_files_of_tricky_rows(spark, tricky, nothing, tmp_path):
    folder = token_files.write_tokens(tricky, WORDS, str(tmp_path / "t"), parts=3)
    rows = token_files.read_tokens(spark, folder).collect()
    assert len(rows) == tricky.count()
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    one = token_files.read_tokens(spark, folder, wanted=[6]).collect()
    assert [r.doc_id for r in one] == [6]
    assert np.frombuffer(one[0].ids, "<u4").tolist() == [*library(WORDS, [TRICKY[6]])[0], 2]
    empty = token_files.write_tokens(nothing, WORDS, str(tmp_path / "e"), parts=3)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_a_wrong_dictionary_is_refused(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words {i} and more of them " * 20) for i in range(300)], "doc_id long, text string")
    folder = token_files.write_tokens(docs, WORDS, str(tmp_path / "t"), parts=2)
    head = spark.read.parquet(f"{folder}/dictionary").first()
    assert head["hash"] == hashlib.sha256(head["bytes"]).hexdigest()
    spark.createDataFrame([("0" * 64, head["bytes"], 2, 2)], "hash string, bytes binary, width int, end_id int").write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError):
        token_files.read_tokens(spark, folder)
