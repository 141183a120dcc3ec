"""Helpers shared by the operators on documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import checkpoint_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A-Z lower-cased; every byte that is neither a digit, a letter nor part of a non-ASCII character becomes a space.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
# Arrow batches small enough that a batch of long texts fits a worker.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(df: DataFrame, **needed: str) -> DataFrame:
    """The caller's columns in one struct ``row``, out of the way of the operator's own names, and the needed ones beside it."""
    return df.select(F.struct(*[named(c) for c in df.columns]).alias("row"), *[named(c).alias(n) for n, c in needed.items()])


def unpacked(columns: Sequence[str], **replaced: Column) -> list[Column]:
    """The caller's columns out of ``row``, some of them replaced."""
    return [(replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in columns]


def lower_az(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and go on from the files: cuts lineage and fixes the rows."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> Column:
    """128 bits that equal rows share; null and empty differ."""
    parts = [F.coalesce(F.concat(F.lit("="), named(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\u0001", *parts)))


def apply_arrow(
    df: DataFrame, inputs: Sequence[str], ddl: str, make: Callable[[], Callable[..., list]], keep: Sequence[str] | None = None
) -> DataFrame:
    """Add the columns of ``ddl``, computed batch by batch from ``inputs``.

    ``make`` runs once per task and returns the function from Arrow arrays to
    arrays. ``keep`` names the columns that stay (default: all). A kept column
    with the name of a new one gives way to it.
    """
    for key, value in BATCHES.items():
        df.sparkSession.conf.set(key, value)
    new = T._parse_datatype_string(ddl)
    taken = {n.lower() for n in new.names}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    sent = kept + [c for c in dict.fromkeys(inputs) if c not in kept]
    at = [sent.index(c) for c in inputs]
    source = df.select(*[named(c).alias(f"c{i}") for i, c in enumerate(sent)])
    kinds = {f.name: f.dataType for f in df.schema}
    fields = [T.StructField(c, kinds[c]) for c in kept] + [T.StructField(f.name, f.dataType) for f in new]
    names, n_kept = [f.name for f in fields], len(kept)

    def run(batches):
        work = make()
        for batch in batches:
            out = work(*[batch.column(i) for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n_kept)] + list(out), names=names)

    return source.mapInArrow(run, T.StructType(fields))


def as_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return array.cast(pa.binary()).fill_null(b"").to_pylist()


def as_texts(array: pa.Array) -> list[str]:
    return array.fill_null("").to_pylist()


def ordered_parts(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows in ``parts`` ranges of the order, sorted inside; ``_part`` numbers the ranges.

    Rows equal in all order columns are told apart by where they were read, so that
    even a value that fills a third of the table is spread over several ranges.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [named(c).asc_nulls_first() for c in order] + [F.col("_arrival")]
    return (
        df.withColumn("_arrival", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
    )
