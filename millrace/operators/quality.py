"""Data-quality flags and reject splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def flags(*rules: tuple[Column, Column | str]) -> Column:
    """Array of the flags whose condition holds; empty (never NULL) when none does."""
    if not rules:
        return F.array().cast("array<string>")
    raised = [
        F.when(condition, F.lit(flag) if isinstance(flag, str) else flag)
        for condition, flag in rules
    ]
    return F.array_compact(F.array(*raised))


def reject_reason(*rules: tuple[Column, str]) -> Column:
    """Reason of the first rule that holds, NULL for a good row."""
    reason = None
    for condition, text in rules:
        reason = F.when(condition, text) if reason is None else reason.when(condition, text)
    return F.lit(None).cast("string") if reason is None else reason


def split_rejects(df: DataFrame, *rules: tuple[Column, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with a `reason` column."""
    marked = df.withColumn("reason", reject_reason(*rules))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(
        F.col("reason").isNotNull()
    )
