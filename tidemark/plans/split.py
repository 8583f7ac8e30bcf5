"""Train / validation / test split: old payments train, newer ones are dealt by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bucket100, half_up
from ..operators.quantile import approximate_quantile, discrete_quantile
from ..schema import EPOCH, ROW_ID
from ..session import stage


def assign_split(
    df: DataFrame,
    valid: float = 0.15,
    test: float = 0.15,
    ts: str = EPOCH,
    row_id: str = ROW_ID,
    exact: bool = True,
) -> DataFrame:
    """Adds ``split``.

    The cut is staged as a one-row table: found once, it is the same for every
    later use of the splits, also when it comes from a sketch.
    """
    quantile = discrete_quantile if exact else approximate_quantile
    limit = stage(quantile(df, ts, half_up(100 * (1 - valid - test))), "cut").scalar()
    buckets = half_up(valid / (valid + test) * 100)
    return df.withColumn(
        "split",
        F.when(F.col(ts) < limit, "training")
        .when(F.col(ts).isNull(), F.lit(None))
        .when(bucket100(F.col(row_id)) < buckets, "validation")
        .otherwise("testing"),
    )


def temporal_split(df: DataFrame, valid: float = 0.15, test: float = 0.15, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts without the time column.  Stage ``df`` first if it is a long plan."""
    tagged = assign_split(df, valid, test, **options)
    drop = ("split", options.get("ts", EPOCH))
    return tuple(tagged.where(F.col("split") == s).drop(*drop) for s in ("training", "validation", "testing"))
