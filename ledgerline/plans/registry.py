"""Registry of runnable queries with the SQL an independent engine can check them by."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casting import plain
from . import driver_tables, oracle
from .warehouse import Warehouse


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Warehouse], DataFrame]
    sql: str | None
    rounded: tuple[str, ...] = ()
    digits: int = 6

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.on(driver_tables.bind(spark, sf_dir))

    def on(self, warehouse: Warehouse) -> DataFrame:
        """Report shape of the result; values that depend on summing order are rounded."""
        out = plain(self.build(warehouse))
        if self.rounded:
            out = out.withColumns({c: F.round(F.col(c), self.digits) for c in self.rounded})
        return out


REGISTRY: dict[str, Query] = {}


def register(
    key: str,
    build: Callable[[Warehouse], DataFrame],
    sql: str | None = None,
    *,
    rounded: Sequence[str] = (),
    doubles: Sequence[str] = (),
    parts: dict[str, str] | None = None,
    digits: int = 6,
) -> None:
    """Add a query. ``doubles`` are columns the oracle holds as DECIMAL."""
    if key in REGISTRY:
        raise ValueError(f"{key} is registered twice")
    if sql is not None:
        swaps = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles if c not in rounded]
        swaps += [f"ROUND(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in rounded]
        if swaps:
            sql = f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({sql})"
        sql = oracle.compose(sql, parts)
    REGISTRY[key] = Query(key, build, sql, tuple(rounded), digits)
