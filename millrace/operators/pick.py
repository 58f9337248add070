"""First row and latest value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given (total) order.

    `row_number() = 1` is planned as a group limit on both sides of the shuffle: each map task
    already keeps one row per key, so a key that holds a third of the table sends at most one
    row per map task to the task that decides.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def latest_value(value: Column, *order: Column) -> Column:
    """Aggregate: the value on the newest row. A NULL on that row is a legal result.

    The order must be total within the group; NULLs in it sort oldest.
    """
    return F.max_by(value, F.struct(*order))
