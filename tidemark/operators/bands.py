"""Global trailing windows computed over overlapping time bands."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach
from .prefix import require_exact


def halo_banded_window(
    df: DataFrame,
    ts: str,
    means: Mapping[str, tuple[str, int]],
    delay: int,
    band: int,
    fill: float = 0.0,
) -> DataFrame:
    """Delayed trailing means by native windows, one task per band.

    A band also reads a lead-in at least as long as the widest frame; lead-in
    rows serve as history and are dropped, so the bands' own rows are disjoint
    and together complete.  The result equals one global window.  Rows collapse to one per
    second before they are copied, and each frame is a difference of two frames that
    start with the band, so a band costs its seconds, not seconds times frame.
    """
    halo = max(width for _, width in means.values())
    copies = -(-halo // band)
    if copies > 100:
        raise ValueError(f"a band of {band} would copy each second {copies} times; widen it")
    values = sorted({value for value, _ in means.values()})
    require_exact(df, values)
    seconds = (
        df.where(F.col(ts).isNotNull())
        .groupBy(ts)
        .agg(
            *[F.sum(v).alias(f"_s_{v}") for v in values],
            *[F.count(v).alias(f"_n_{v}") for v in values],
        )
        .withColumn("_own", F.floor(F.col(ts) / F.lit(band)))
    )
    # A second is history for the bands whose lead-in covers it.
    spread = seconds.withColumn("_band", F.explode(F.sequence(F.col("_own"), F.col("_own") + copies))).where(
        F.col(ts) >= F.col("_band") * band - halo
    )

    def upto(column: str, shift: int) -> str:
        frame = f"RANGE BETWEEN UNBOUNDED PRECEDING AND {shift} PRECEDING"
        return f"coalesce(sum(`{column}`) OVER (PARTITION BY _band ORDER BY `{ts}` {frame}), 0)"

    columns = []
    for name, (value, width) in means.items():
        total, rows = (f"{upto(c, delay)} - {upto(c, width + 1)}" for c in (f"_s_{value}", f"_n_{value}"))
        columns.append(f"coalesce(try_divide(CAST({total} AS DOUBLE), CAST({rows} AS DOUBLE)), {float(fill)}D) AS `{name}`")
    rates = spread.selectExpr(f"`{ts}`", "_band", "_own", *columns).where("_band = _own").drop("_band", "_own")
    return attach(df, rates, [ts])
