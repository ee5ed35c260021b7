"""Keeping one row per key.

``row_number() = 1`` is written as a window filter on purpose: the optimizer turns it into a
group limit that already runs before the shuffle, so a key with a huge number of copies
leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _as_columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order. Add a tie-break for a stable choice."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*_as_columns(order))))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of every key; nulls in the order columns lose."""
    return keep_first(df, keys, [c.desc_nulls_last() for c in _as_columns(order)])


def distinct_on(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
