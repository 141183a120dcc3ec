"""Contiguous shards of nearly equal bytes, in DataFrame functions only.

Rows are ranged by the order column; each range gives its total, the totals give
every range its start, and a running sum inside the range gives every row its
place in the whole. Equal cuts of the whole are the shards. The only window
without a key runs over one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ordered_parts, packed, stored, unpacked


def assign_shards(rows: DataFrame, shards: int, order: str = "doc_id", size: str = "size", parts: int | None = None) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (place in the shard, from 0).

    A row belongs to the shard that its middle byte falls into, so a shard differs
    from the equal share by at most one row's size at either end. Sizes are
    positive. Null order values come first, equal ones in the order they are read;
    repeated rows are rows of their own; columns named shard or slot are replaced.
    The ranged rows are written once to the shared folder, so pass the columns that
    are needed, not whole texts.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    ranged = stored(ordered_parts(packed(rows, order=order, size=size), ["order"], parts), "ranged")
    every = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(every), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(every), F.lit(0)).alias("_rows_before"),
            F.sum("_bytes").over(W.partitionBy(F.lit(0))).alias("_total"),
        )
    )
    inside = W.partitionBy("_part").orderBy(F.col("order").asc_nulls_first(), "_arrival")
    up_to = inside.rowsBetween(W.unboundedPreceding, 0)
    placed = (
        ranged.join(F.broadcast(starts), "_part")
        .withColumn("_end", F.col("_bytes_before") + F.sum("size").over(up_to))
        .withColumn("_row", F.col("_rows_before") + F.row_number().over(inside) - 1)
        .withColumn("_middle", 2 * F.col("_end") - F.col("size"))
        .withColumn("shard", F.expr(f"cast((cast(_middle as decimal(38,0)) * {int(shards)}) div (2 * _total) as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *unpacked(kept), "shard", (F.col("_row") - F.col("_first")).cast("long").alias("slot")
    )
