"""What the tests of this folder share."""

import duckdb
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"

TRICKY = [
    None,
    "",
    "   \n\t ",
    "word",
    "two words",
    "Under the MIT license. under the mit LICENSE",
    "Ünïcode ÉTÉ Σίσυφος 日本語 👍🏽 naïve",
    "a<|endoftext|>b <|startoftext|> c",
    "Licensed under the Apache License, Version 2.0 (the license); you may not use this file except in compliance with the License.",
    "CC BY-NC 4.0 and cc by nc again",
    "same line\nsame line\n\nother\nsame line",
    "!! wow !! ## $$ %% && || <> " * 3,
    "one two three four five six seven eight nine ten " * 4,
    "x" * 3000,
    "  lead and  trail\r\n 12 ½ 3rd don't I'LL  ",
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi",
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi",
    "the lambda " * 2500,
]


@pytest.fixture(scope="session")
def tricky(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with names the operators use."""
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "mine", i) for i, t in enumerate(TRICKY)]
    rows += [rows[5], rows[12], (None, "no id here at all", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, kept string, `n_tokens` int")


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.where("false")


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def all_texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def by_sql(sql, **tables):
    """Rows of ``sql`` over tables given as lists of dicts, as dicts."""
    con = duckdb.connect()
    for name, rows in tables.items():
        frame = pd.DataFrame(rows)
        for c in frame:
            if frame[c].dtype.kind == "f":
                frame[c] = frame[c].astype("Int64")
        con.register(name, frame)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, r)) for r in cursor.fetchall()]
