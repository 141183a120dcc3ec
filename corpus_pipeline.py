"""From raw documents to token ids: quality, lines, near duplicates, test items, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run``
applies them to the documents of ``sf_dir``; each stage's rows are written once
to the shared folder and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, line_dedup, quality, simhash
from ledgerline.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; columns stay as they are.

    A null or blank text has no words and goes; repeated rows are judged alike; an empty table stays empty.
    """
    return quality.drop_low_quality(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that spread over many sites; ``n_chars`` counts what is left.

    A null source counts for no site; a null text stays null; a text of nothing but
    such lines becomes empty; other columns stay, whatever their names.
    """
    cut = line_dedup.drop_spread_lines(docs)
    length = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity 0.8 or more, directly or through others.

    The smallest doc_id stays, null ones last; texts without words are one group; of repeated rows one stays.
    """
    return simhash.keep_one(docs, words=5, similarity=0.8)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item; columns stay as they are.

    A null text has no windows and stays; without items every document stays.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and whether they decode to its text; a null text counts as empty."""
    made = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id", "text"])
    return made.selectExpr("doc_id", "n_tokens", "ids", "decoded <=> coalesce(text, '') AS restored")


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_test_items),
    ("bpe", encode),
]
# Near duplicates and token ids cannot be put in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
