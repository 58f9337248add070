"""As-of joins over validity intervals.

A dimension history (or a rate list) says "value v of key k holds from a to b". Finding the value
for a dated fact row is a range join. On the key alone, a fact row would meet every version of its
key, and one hot key would be one join group. So the time axis is cut into coarse buckets: every
interval is listed once per bucket it touches, a fact row lies in exactly one bucket, and the join
is a hash equality on (key, bucket) plus the exact range test. A fact row then meets only the
versions alive in its bucket, and a hot key falls apart into as many groups as there are buckets
(which adaptive execution splits further, as no operator here needs the join's own partitioning).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

_EPOCH = date(1970, 1, 1)


@dataclass(frozen=True)
class Buckets:
    """Where the time axis is cut.

    Dates before `low` or after `high` share the edge buckets, on both sides of the join, so the
    result never depends on these numbers; they only set how finely the work is cut.
    """

    low: date
    high: date
    days: int = 366

    def of(self, day: Column) -> Column:
        first = (self.low - _EPOCH).days // self.days
        last = (self.high - _EPOCH).days // self.days
        index = F.floor(F.unix_date(day) / F.lit(self.days)).cast("int")
        return F.least(F.greatest(index, F.lit(first)), F.lit(last))

    def last(self) -> Column:
        return F.lit((self.high - _EPOCH).days // self.days)


def with_validity(df: DataFrame, by: Sequence[str], on: str) -> DataFrame:
    """Turn dated values (one row per key and date) into intervals up to the next date.

    A key has at most one row per calendar day, so the window's groups are bounded by the
    calendar and not by the data.
    """
    order = Window.partitionBy(*by).orderBy(on)
    return df.withColumn("valid_from", F.col(on)).withColumn(
        "valid_to", F.date_sub(F.lead(on).over(order), 1)
    )


def interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    by: Sequence[tuple[str, str]],
    day: str,
    values: dict[str, str],
    buckets: Buckets,
    how: str = "inner",
    start: str = "effective_from",
    end: str = "effective_to",
) -> DataFrame:
    """Attach to each fact row the interval of its key that contains `day`.

    `by` pairs fact columns with interval columns; `values` maps new column names to interval
    columns. The intervals of a key must be disjoint, so no fact row is multiplied. An open
    interval has a NULL end. With `how="left"` unmatched rows stay, with NULLs.
    """
    first = buckets.of(F.col(start))
    until = F.when(F.col(end).isNull(), buckets.last()).otherwise(buckets.of(F.col(end)))
    side = intervals.where(F.col(end).isNull() | (F.col(end) >= F.col(start))).select(
        *[F.col(right).alias(f"__k{i}") for i, (_, right) in enumerate(by)],
        F.col(start).alias("__from"),
        F.col(end).alias("__to"),
        *[F.col(source).alias(target) for target, source in values.items()],
        F.explode(F.sequence(first, until)).alias("__slot"),
    )
    left = facts.withColumn("__bucket", buckets.of(F.col(day)))
    condition = (
        (F.col("__bucket") == F.col("__slot"))
        & (F.col("__from") <= F.col(day))
        & (F.col("__to").isNull() | (F.col("__to") >= F.col(day)))
    )
    for i, (name, _) in enumerate(by):
        condition = condition & (left[name] == F.col(f"__k{i}"))
    extra = [f"__k{i}" for i in range(len(by))] + ["__from", "__to", "__slot", "__bucket"]
    return left.join(side, condition, how).drop(*extra)
