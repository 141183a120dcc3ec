"""CSV with line breaks inside quotes, read by many tasks per file.

Lines are read split by split. A line is inside a quoted field if an odd number
of quotes stands before it in its file, so quotes are counted per split, added
up over the splits of a file, and then along the lines of each split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split, order, and whether an odd number of quotes stands before them in the split."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        F.regexp_replace("value", "\r$", "").alias("value"),
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("odd"),
    )
    before = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)


def _split_starts(lines: DataFrame) -> DataFrame:
    """Per split: parity of the quotes and number of records before it in its file.

    A split opens records at its lines of even parity if it begins outside quotes,
    else at those of odd parity; both are counted, as its beginning is not known yet.
    """
    totals = lines.groupBy("file", "split").agg(
        F.sum("odd").alias("quotes"), F.count_if(F.col("inside") == 0).alias("even"), F.count_if(F.col("inside") == 1).alias("uneven")
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begun = totals.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    opened = F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("uneven"))
    return begun.select("file", "split", "parity", F.coalesce(F.sum(opened).over(earlier), F.lit(0)).alias("records"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``number`` (from 1 in each file) and text of every record of one file or of the files of a folder.

    A record that lies within one line is taken as it is; only the lines of the
    others are brought together. Line breaks inside quotes stay, CR LF as LF.
    Quotes that do not balance raise an error.
    """
    lines = _lines(spark, path)
    within = Window.partitionBy("file", "split").orderBy("line")
    placed = lines.join(_split_starts(lines), ["file", "split"]).withColumn("inside", (F.col("inside") + F.col("parity")) % 2)
    numbered = placed.withColumn("number", F.col("records") + F.count_if(F.col("inside") == 0).over(within))
    whole = (F.col("inside") == 0) & (F.col("odd") == 0)
    pieces = (
        numbered.filter(~whole)
        .groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("parts"), F.sum("odd").alias("quotes"))
    )
    joined = F.when(F.col("quotes") % 2 == 0, F.array_join(F.transform("parts", lambda p: p["value"]), "\n")).otherwise(
        F.raise_error(F.concat(F.lit("a quoted field is not closed: "), F.col("file")))
    )
    return numbered.filter(whole).select("file", "number", "value").unionByName(
        pieces.select("file", "number", joined.cast("string").alias("value"))
    )


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of RFC 4180 files whose header holds the names of ``schema``; an empty field is NULL, blank lines are passed over.

    A header other than the contract's, or a record with too few or too many
    fields, fails the job.
    """
    header = F.lower(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    same = F.transform(F.split(header, ","), lambda c: F.trim(c)) == F.array(*[F.lit(c.lower()) for c in schema.names])
    body = F.when(F.col("number") > 1, F.trim("value") != "").otherwise(
        F.when(same, False).otherwise(F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.col("value"))))
    )
    options = {
        "quote": '"', "escape": '"', "nullValue": "", "multiLine": "true", "mode": "FAILFAST", "columnPruning": "false",
        "maxCharsPerColumn": "-1",
    }
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = records(spark, path).filter(body.cast("boolean"))
    return rows.select(F.from_csv("value", types, options).alias("row")).select("row.*")
