"""Keyed upserts as set operations: union of both sides, then one winner per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .pick import first_per_key


def _union(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    if existing is None:
        return incoming
    return existing.unionByName(incoming, allowMissingColumns=True)


def upsert_latest(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    seq: Sequence[Column],
    nullable_key: Sequence[Column] | None = None,
) -> DataFrame:
    """Last write wins: the row with the highest `seq` stays for every key.

    `nullable_key` is for keys whose NULLs never collide. Such rows are kept as they are; the
    columns given only recognise a record that was delivered twice. To keep it one shuffle, the
    NULL-key rows get their identity as an extra grouping column instead of a plan of their own.
    """
    rows = _union(existing, incoming)
    order = [column.desc() for column in seq]
    if nullable_key is None:
        return first_per_key(rows, keys, order)
    rows = rows.withColumn("__identity", _identity(keys, nullable_key))
    return first_per_key(rows, [*keys, "__identity"], order).drop("__identity")


def _identity(keys: Sequence[str], nullable_key: Sequence[Column]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return F.when(missing, F.sha2(F.concat_ws("|", *nullable_key), 256))


def upserted_keys(rows: DataFrame, keys: Sequence[str], nullable_key: Sequence[Column] | None = None) -> DataFrame:
    """One row of keys for each row that an upsert of `rows` leaves, whichever that is.

    No order decides here, so the rows are neither sorted nor shuffled with what they are ordered by.
    """
    if nullable_key is None:
        return rows.select(*keys).distinct()
    return rows.select(*keys, _identity(keys, nullable_key).alias("__identity")).distinct().drop("__identity")


def upsert_guarded(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    guard: Sequence[Column],
    seq: Sequence[Column],
) -> DataFrame:
    """A row replaces the stored one only if its guard is strictly greater.

    That is the first arrival among the rows with the greatest guard, whatever the batches were.
    """
    order = [column.desc_nulls_last() for column in guard] + [column.asc() for column in seq]
    return first_per_key(_union(existing, incoming), keys, order)


def upsert_partial(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    refresh: Sequence[str],
) -> DataFrame:
    """Known keys take only the `refresh` columns from `incoming`; new keys are inserted."""
    if existing is None:
        return incoming
    columns = incoming.columns
    packed = F.struct(*[F.col(c) for c in columns])
    old = existing.select(*keys, F.struct(*[F.col(c) for c in columns]).alias("old"))
    new = incoming.select(*keys, packed.alias("new"))
    joined = old.join(new, list(keys), "full")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()

    def resolve(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in refresh:
            return F.when(has_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        return F.when(has_old, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))

    return joined.select(*[resolve(c).alias(c) for c in columns])


def insert_if_absent(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    seq: Sequence[Column],
) -> DataFrame:
    """Rows of `incoming` with a new key are added (first arrival wins); others are ignored."""
    fresh = first_per_key(incoming, keys, [column.asc() for column in seq])
    if existing is None:
        return fresh
    return existing.unionByName(fresh.join(existing.select(*keys), list(keys), "left_anti"))


def changed_only(incoming: DataFrame, ledger: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of `incoming` whose key the ledger does not hold yet."""
    if ledger is None:
        return incoming
    return incoming.join(ledger.select(*keys), list(keys), "left_anti")
