"""Slowly changing dimension, type 2: a version history built with window functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def collapse_changes(
    changes: DataFrame, key: str, day: str, attributes: Sequence[str], seq: Sequence[Column]
) -> DataFrame:
    """One row per key and day; of several changes of one attribute the newest counts.

    Each attribute is a one-field struct, NULL where the change does not touch it, so a change to
    NULL differs from no change. The aggregation is partial: a key with very many changes
    shrinks to one row per day on the map side.
    """
    order = F.struct(*seq)
    newest = [
        F.max_by(F.col(name), F.when(F.col(name).isNotNull(), order)).alias(name)
        for name in attributes
    ]
    return changes.groupBy(F.col(key), F.col(day)).agg(*newest)


def scd2_build(
    seed: DataFrame,
    changes: DataFrame,
    key: str,
    seed_date: str,
    change_date: str,
    attributes: Sequence[str],
    seq: Sequence[Column],
) -> DataFrame:
    """Version history of `seed` under `changes`.

    `seed` has one row per key. `changes` has `key`, `change_date` and, per attribute, a struct
    `<value>` as in `collapse_changes`. Every change date opens a version, even if no attribute
    differs. A key's history starts at its seed date or its first change, whichever is earlier;
    values of a change on that very day win over the seed's. Changes of unknown keys are ignored.
    Result: all seed columns plus `effective_from`, `effective_to`, `is_current`; per key the
    intervals are disjoint, gap-free, and exactly the last one is current.
    """
    fixed = [c for c in seed.columns if c not in {key, seed_date, *attributes}]
    base = seed.select(
        key,
        F.col(seed_date).alias("__day"),
        F.lit(0).alias("__kind"),
        F.struct(F.col(seed_date).alias("__seed_date"), *fixed).alias("__fixed"),
        *[F.struct(F.col(name).alias("value")).alias(name) for name in attributes],
    )
    daily = collapse_changes(changes, key, change_date, attributes, seq).select(
        key, F.col(change_date).alias("__day"), F.lit(1).alias("__kind"), *attributes
    )
    points = base.unionByName(daily, allowMissingColumns=True)

    # Both windows below share one shuffle by key. A key has at most one row per calendar day.
    whole = Window.partitionBy(key)
    points = (
        points.withColumn("__first", F.min("__day").over(whole))
        .withColumn("__seeded", F.min("__kind").over(whole) == 0)
        .where(F.col("__seeded") & F.col("__first").isNotNull())
        .withColumn("__day", F.when(F.col("__kind") == 0, F.col("__first")).otherwise(F.col("__day")))
        .where(F.col("__day").isNotNull())
    )
    ordered = Window.partitionBy(key).orderBy("__day", "__kind")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = points.select(
        key,
        "__day",
        F.lead("__day").over(ordered).alias("__next"),
        F.last("__fixed", ignorenulls=True).over(so_far).alias("__fixed"),
        *[F.last(name, ignorenulls=True).over(so_far).alias(name) for name in attributes],
    )
    history = filled.where(F.col("__next").isNull() | (F.col("__next") > F.col("__day")))

    def pick(name: str) -> Column:
        if name == key:
            return F.col(key)
        if name == seed_date:
            return F.col("__fixed.__seed_date").alias(name)
        if name in attributes:
            return F.col(f"{name}.value").alias(name)
        return F.col(f"__fixed.{name}").alias(name)

    return history.select(
        *[pick(c) for c in seed.columns],
        F.col("__day").alias("effective_from"),
        F.date_sub(F.col("__next"), 1).alias("effective_to"),
        F.col("__next").isNull().alias("is_current"),
    )
