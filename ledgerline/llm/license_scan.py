"""License scan by diagonal voting, in DataFrame functions only.

Every run of three words of every document is hashed and joined to the places
where license templates have the same run. A hit votes for the diagonal
(document position minus template position); votes of a diagonal are a bit set
over the template's places, so they merge by OR. Neighbouring diagonals, which
insertions and deletions cause, are merged: each diagonal with all that follow
it within the stretch a template may have, so that a page header, a name or a
clause inside a notice does not part it. A span counts when it holds enough of
the template.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lower_az, named, row_key

GRAM = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``exact`` ones are phrases: a place is a diagonal on which every run stands."""

    label: str
    words: str
    exact: bool = False


# Phrases of the base labels, then opening words of public licenses.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template(
        "mit-grant",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    Template(
        "apache-2-notice",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    ),
    Template(
        "bsd-grant",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    Template("gpl", "licensed under the gnu general public license"),
    Template("all-rights-reserved", "all rights reserved"),
)
# A span needs this share of the template's runs, within this many times its length:
# its diagonals lie at most (MAX_STRETCH - 1) template lengths apart.
MIN_SHARE, MAX_STRETCH = 0.6, 2


def words_of(text: Column) -> Column:
    """Words of ASCII digits, letters and all other characters, A-Z lower-cased."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def template_runs(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per distinct run of three words with all its template places; bounded by the templates."""
    places: dict[tuple[str, ...], list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        words = template.words.split(" ")
        if not GRAM <= len(words) <= 62 + GRAM:
            raise ValueError(f"a template has {GRAM} to {62 + GRAM} words: {template.label}")
        for p in range(len(words) - GRAM + 1):
            places.setdefault(tuple(words[p : p + GRAM]), []).append((t, p))
    if len(places) > 10_000:
        raise ValueError("templates with over 10,000 runs are no longer a small table")
    rows = [(*run, at) for run, at in places.items()]
    known = spark.createDataFrame(rows, "t0 string, t1 string, t2 string, places array<struct<template: int, at: int>>")
    return known.withColumn("_hash", F.xxhash64("t0", "t1", "t2"))


def votes(docs: DataFrame, doc_id: str, text: str, templates: Sequence[Template]) -> DataFrame:
    """Rows (_key, id, n_words, template, diagonal, mask, head).

    Every document has one row with ``head`` 1, its first run, voting or not; all
    others vote. A run that meets several template places is one row for each.
    """
    known = template_runs(docs.sparkSession, templates)
    split = docs.select(named(doc_id).alias("_id"), row_key(doc_id, text).alias("_key"), words_of(named(text)).alias("_w"))
    runs = split.select(
        "_id",
        "_key",
        F.size("_w").cast("long").alias("n_words"),
        F.posexplode_outer(F.arrays_zip("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(0))), F.slice("_w", 3, F.greatest(F.size("_w"), F.lit(0))))).alias("_pos", "_run"),
    ).select("_id", "_key", "n_words", "_pos", *[F.col("_run").getField(str(i) if i else "_w").alias(f"w{i}") for i in range(GRAM)])
    joined = runs.withColumn("_hash", F.xxhash64("w0", "w1", "w2")).join(F.broadcast(known), "_hash", "left")
    same = (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    met = joined.withColumn("_places", F.when(same, F.col("places"))).where(
        F.col("_places").isNotNull() | F.col("_pos").isNull() | (F.col("_pos") == 0)
    )
    return met.select("_id", "_key", "n_words", "_pos", F.posexplode_outer("_places").alias("_nth", "_place")).select(
        "_id",
        "_key",
        "n_words",
        F.col("_place.template").alias("template"),
        (F.col("_pos") - F.col("_place.at")).cast("long").alias("diagonal"),
        F.when(F.col("_place").isNotNull(), F.expr("shiftleft(1L, _place.at)")).alias("mask"),
        (F.coalesce(F.col("_pos"), F.lit(0)) + F.coalesce(F.col("_nth"), F.lit(0)) == 0).cast("long").alias("head"),
    )


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document row: id, n_words, places and labels.

    n_base counts the places of exact templates, first_word and last_word are the
    smallest and largest start of one (null without), base_labels their labels,
    labels those of all templates found, score the largest share of a template's
    runs on merged diagonals (1 with a place of an exact one). A null text has no words. Repeated rows get a
    row each; documents of one id with different texts are told apart; columns
    other than id and text are not carried; an empty table gives none.
    """
    info = docs.sparkSession.createDataFrame(
        [(i, t.label, t.exact, len(t.words.split(" ")) - GRAM + 1) for i, t in enumerate(templates)],
        "template int, label string, exact boolean, runs int",
    )
    diagonals = (
        votes(docs, doc_id, text, templates)
        .groupBy("_key", "template", "diagonal")
        .agg(
            F.first("_id").alias("_id"),
            F.first("n_words").alias("n_words"),
            F.bit_or("mask").alias("mask"),
            F.sum("head").alias("heads"),
        )
        .join(F.broadcast(info), "template", "left")
    )
    # in steps of the slack, so that one frame serves all templates; half a word keeps rounding off its edge
    slack = (MAX_STRETCH - 1) * (F.col("runs") + GRAM - 1)
    within = W.partitionBy("_key", "template").orderBy(F.col("diagonal") / (slack + 0.5)).rangeBetween(W.currentRow, 1)
    placed = diagonals.withColumn("_span", F.bit_or("mask").over(within)).withColumn(
        "full", F.col("exact") & (F.bit_count("mask") == F.col("runs"))
    )
    spans = placed.groupBy("_key", "template").agg(
        F.first("_id").alias("_id"),
        F.first("n_words").alias("n_words"),
        F.first("label").alias("label"),
        F.first("exact").alias("exact"),
        F.sum("heads").alias("heads"),
        F.sum(F.col("full").cast("long")).alias("places"),
        F.min(F.when(F.col("full"), F.col("diagonal"))).alias("first_word"),
        F.max(F.when(F.col("full"), F.col("diagonal"))).alias("last_word"),
        F.max(F.bit_count("_span") / F.col("runs")).alias("share"),
    )
    found = F.when(F.col("exact"), F.col("places") > 0).otherwise(F.col("share") >= MIN_SHARE)
    per_row = spans.groupBy("_key").agg(
        F.first("_id").alias(doc_id),
        F.first("n_words").alias("n_words"),
        F.sum("heads").alias("_copies"),
        F.coalesce(F.sum("places"), F.lit(0)).alias("_places"),
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("places") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(~F.col("exact"), F.col("share")).when(F.col("places") > 0, 1.0)), F.lit(0.0)).alias("score"),
    )
    return per_row.select(
        named(doc_id),
        "n_words",
        F.col("_places").alias("n_base"),
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
