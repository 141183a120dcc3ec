"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    license_scan,
    line_dedup,
    ngram_join,
    prefix_trie,
    quality,
    runs,
    sharding,
    simhash,
    sql,
    token_count,
    token_files,
    url_filter,
)
from .common import stored, table

SHARDS = 8
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, keep=["page_id"])


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), keep=["doc_id"])
    return made.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_spread_lines(documents(spark, sf_dir, "doc_id", "source", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlap(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.assign_shards(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(documents(spark, sf_dir), report=shown, keep=["doc_id"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), keep=["doc_id"])


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    folder = token_files.write_tokens(documents(spark, sf_dir), path, token_files.token_folder(spark))
    return token_files.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Texts of which every tenth, by the hash of its id, has its words from some place on replaced by repeats of the first ones."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \x09-\x0D]+"), lambda w: w != "")
    plan = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).cast("long").alias("g"))
    split = plan.withColumn("w", F.when(F.col("chosen"), words)).withColumn("n", F.size("w").cast("long"))
    placed = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", F.when(F.col("n") > 0, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )
    turned = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)])), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, turned).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_periodic_tails(documents(spark, sf_dir)), keep=["doc_id"])
    return found.selectExpr(
        "doc_id",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        # of equal exponents the run that comes first: reduce keeps it unless a later one is strictly greater
        """reduce(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
             (best, r) -> IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best)) AS best""",
        "sha2(CAST(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '') AS BINARY), 256) AS runs_sha256",
        "sha2(CAST(collapsed AS BINARY), 256) AS collapsed_sha256",
    ).selectExpr(
        "doc_id", "n_runs", "best.start AS start", "best.length AS length", "best.period AS period",
        "CAST(floor(1000 * best.length / best.period) AS BIGINT) AS exponent_milli", "runs_sha256", "collapsed_sha256",
    )


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(documents(spark, sf_dir))


def with_common_openings(turns: DataFrame) -> DataFrame:
    """Digested turns, numbered from 1: each conversation opens with turns of the first of its twenty, then goes on with its own."""
    rows = prefix_trie.numbered(prefix_trie.digest_turns(turns), "conv_id", ["turn", "s1", "s2"]).drop("p1", "p2", "turn")
    rows = stored(rows, "numbered-turns")
    opening = F.crc32(F.col("conv_id").cast("string")) % 4
    first = rows.where((F.col("conv_id") % 20 == 0) & (F.col("place") < 3))
    lengths = first.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("most"))
    convs = rows.where("place = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), opening.alias("h"))
    convs = convs.join(lengths, "base", "left").withColumn("opens", F.least("h", F.coalesce("most", F.lit(0)))).drop("most")
    copied = convs.join(first.withColumnRenamed("conv_id", "base"), "base").where(F.col("place") < F.col("opens"))
    own = rows.join(convs, "conv_id").where(F.col("place") >= F.col("h"))
    depth = lambda start: (F.col("place") + 1 + start).cast("long").alias("depth")
    return copied.select("conv_id", depth(F.lit(0)), "s1", "s2", "words").unionByName(
        own.select("conv_id", depth(F.col("opens") - F.col("h")), "s1", "s2", "words")
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie.trie_of(with_common_openings(turns), turns.select("conv_id"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_bpe_round_trip,
        op3_license_scan,
        op4_line_dedup,
        op5_simhash_near_dedup,
        op6_benchmark_decontamination,
        op7_sharding,
        op8_quality_rules,
        op9_token_counts,
        op10_token_files,
        op11_periodic_runs,
        op12_ngram_jaccard_join,
        op13_prefix_trie,
        pipeline,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": sql.URL_FILTERS,
    "op3_license_scan": sql.license_scan(license_scan.TEMPLATES),
    "op4_line_dedup": sql.line_dedup(line_dedup.MIN_SITES),
    "op6_benchmark_decontamination": sql.DECONTAMINATION,
    "op8_quality_rules": sql.QUALITY,
}
