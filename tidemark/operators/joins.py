"""Equi-join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Add the columns of ``right`` (unique on ``keys``) to ``left``.

    Many-to-one, so adaptive execution may split a hot key's rows over many
    tasks.  Keys named in ``null_safe`` also match NULL with NULL.
    """
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"__{k}") for k in keys],
        *[F.col(f"`{c}`") for c in right.columns if c not in keys],
    )
    tests = [
        F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) if k in null_safe else F.col(f"`{k}`") == F.col(f"`__{k}`")
        for k in keys
    ]
    return left.join(renamed, reduce(lambda a, b: a & b, tests), how).drop(*[f"__{k}" for k in keys])


def hot_keys(
    df: DataFrame, key: str, min_rows: int = 200_000, max_keys: int = 100_000
) -> DataFrame:
    """Keys that hold too many rows for one task.

    A key qualifies with more than ``max(min_rows, all rows / max_keys)`` rows,
    so there can be at most ``max_keys`` of them: the result is safe to
    broadcast whatever the data.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg(F.sum("_rows")).scalar() / F.lit(max_keys)
    return counts.where(F.col("_rows") > F.greatest(F.lit(float(min_rows)), share)).select(key)
