"""Aggregate and ratio helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import MONEY


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom as DOUBLE, NULL when bottom is zero or NULL."""
    return _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))


def exact(c: str | Column) -> Column:
    return _col(c).cast(MONEY)


def exact_sum(c: str | Column) -> Column:
    """Decimal sum: the same total whatever the order of the partial sums."""
    return F.sum(exact(c))


def money_sum(c: str | Column) -> Column:
    return exact_sum(c).cast("double")


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def flag_sum(c: str | Column) -> Column:
    return F.sum(_col(c).cast("bigint"))


def band(value: Column, edges: Sequence[float], labels: Sequence[str], null_label: str | None) -> Column:
    """Label of the first edge the value is below; the last label takes the rest.

    ``null_label=None`` lets a NULL fall through to the last label.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    ladder = F.when(value.isNull(), F.lit(null_label)) if null_label is not None else None
    for edge, label in zip(edges, labels):
        test = value < F.lit(edge)
        ladder = F.when(test, F.lit(label)) if ladder is None else ladder.when(test, F.lit(label))
    return F.lit(labels[-1]) if ladder is None else ladder.otherwise(F.lit(labels[-1]))
