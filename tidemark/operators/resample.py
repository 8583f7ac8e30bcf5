"""Rebalancing of a training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import id_levels, running_totals

SAMPLINGS = ("none", "rose", "upsampling_with_duplicates")


def _uniform(seed: int, stream: int, row: str) -> str:
    """SQL for a uniform number in (0, 1) that depends on the row only, so a retried task repeats it."""
    return f"(CAST(shiftrightunsigned(xxhash64({seed}, {stream}, {row}), 11) AS DOUBLE) + 0.5D) / {float(1 << 53)}D"


def _normal(seed: int, stream: int, row: str) -> str:
    """SQL for a standard normal number from two uniform ones (Box-Muller)."""
    radius = f"sqrt(-2D * ln({_uniform(seed, 2 * stream, row)}))"
    return f"{radius} * cos(2D * pi() * {_uniform(seed, 2 * stream + 1, row)})"


def rose_size(majority: int, minority: int, share: float) -> int:
    """New minority rows needed for a final share of the whole set."""
    if not 0 < share < 1:
        raise ValueError(f"minority share must lie between 0 and 1, not {share}")
    extra = int(majority * (share / (1 - share)) - minority)
    if extra < 0:
        raise ValueError("the minority share is already larger than asked for")
    return extra


def rose(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    row_id: str,
    share: float = 0.01,
    shrinkage: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """Smoothed bootstrap: redraw minority rows and blur each feature.

    The blur of a column is ``shrinkage * (4 / ((d + 2) n)) ** (1 / (d + 4))`` standard
    deviations of the minority class.  New rows get negative ids.
    """
    minority = df.where(F.col(label) == 1)
    facts = df.agg(
        F.count_if(F.col(label) == 1).alias("minority"),
        F.count_if(F.col(label) == 0).alias("majority"),
        *[F.expr(f"stddev_pop(CASE WHEN `{label}` = 1 THEN `{f}` END) AS sd_{i}") for i, f in enumerate(features)],
    ).first()
    n, d = facts["minority"], len(features)
    if n == 0:
        raise ValueError("no minority rows to draw from")
    extra = rose_size(facts["majority"], n, share)
    width = shrinkage * (4.0 / ((d + 2) * n)) ** (1.0 / (d + 4))
    numbered = running_totals(
        minority.withColumn("_one", F.lit(1)), id_levels(F.col(row_id)), [row_id], {"_place": F.col("_one")}
    )
    draws = df.sparkSession.range(extra).select(
        F.col("id").alias("_draw"), F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "id"), F.lit(n)).alias("_pick")
    )
    picked = draws.join(numbered, F.col("_pick") == F.col("_place_before"))
    blurred = {
        f: f"CAST(`{f}` AS DOUBLE) + {width * (facts[f'sd_{i}'] or 0.0)}D * {_normal(seed, i, '_draw')} AS `{f}`"
        for i, f in enumerate(features)
    }
    drawn = picked.selectExpr(
        *[f"-_draw - 1 AS `{c}`" if c == row_id else blurred.get(c, f"`{c}`") for c in df.columns]
    )
    doubles = df.selectExpr(
        *[f"CAST(`{c}` AS DOUBLE) AS `{c}`" if c in blurred else f"`{c}`" for c in df.columns]
    )
    return doubles.unionByName(drawn)


def duplicate_minority(df: DataFrame, label: str, copies: int = 2) -> DataFrame:
    """Adds ``copies`` further copies of every minority row."""
    times = F.explode(F.sequence(F.lit(1), F.lit(copies))) if copies else None
    if times is None:
        return df
    more = df.where(F.col(label) == 1).withColumn("_copy", times).drop("_copy")
    return df.unionByName(more)


def resample(df: DataFrame, features: Sequence[str], label: str, row_id: str, sampling: str = "none", share: float = 0.01, shrinkage: float = 1.0, seed: int = 42, copies: int = 2) -> DataFrame:
    """Dispatch by name; an unknown name is an error."""
    if sampling == "none":
        return df
    if sampling == "rose":
        return rose(df, features, label, row_id, share, shrinkage, seed)
    if sampling == "upsampling_with_duplicates":
        return duplicate_minority(df, label, copies)
    raise ValueError(f"sampling must be one of {SAMPLINGS}, not {sampling!r}")
