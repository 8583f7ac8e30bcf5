"""Exact discrete quantiles: of an integer time column, and of any number or time by narrowing passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import DAY, running_totals
from .shards import shard


def discrete_quantile(df: DataFrame, column: str, percent: int, output: str = "quantile") -> DataFrame:
    """Smallest value with at least ``percent`` of the rows at or below it, as one row.

    Counts per distinct second are added up day by day, so no task holds more
    than one day of seconds; integer arithmetic keeps the cut exact.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).scalar()
    ranked = running_totals(counts, [F.floor(F.col(column) / F.lit(DAY))], [column], {"_n": F.col("_n")})
    reached = (F.col("_n_before") + F.col("_n")) * 100 >= total * percent
    return ranked.where(reached).agg(F.min(column).alias(output))


def approximate_quantile(df: DataFrame, column: str, percent: int, precision: int = 4_000, output: str = "quantile") -> DataFrame:
    """The same cut from a mergeable sketch: one pass, no shuffle of rows."""
    sketch = F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), precision)
    parts = df.groupBy(shard().alias("_shard")).agg(sketch.alias("_q"))
    merged = parts.agg(F.kll_merge_agg_bigint("_q", precision).alias("_q"))
    return merged.select(F.kll_sketch_get_quantile_bigint("_q", F.lit(percent / 100)).alias(output))


MARGIN = 0.003  # of an interval's rows to either side of a sketched rank; a miss costs one more pass, not exactness


@dataclass(frozen=True)
class _Search:
    """One percentile: its rank among the rows with keys in [low, high], of which ``below`` rows lie under ``low``."""

    percent: float
    rank: int
    low: float
    high: float
    below: int
    inside: int


def _key(df: DataFrame, column: str) -> Column:
    """A double that never falls as the value rises."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    raise TypeError(f"{column!r} is {kind.simpleString()}; quantiles are found for numbers, dates and timestamps")


def _slots(intervals: Sequence[tuple[float, float]]) -> Column:
    """Numbers of the intervals that hold a row's key; those of neighbouring ranks may overlap."""
    hits = F.array(*[F.when(F.col("_k").between(low, high), F.lit(i)) for i, (low, high) in enumerate(intervals)])
    return F.explode(F.filter(hits, lambda i: i.isNotNull()))


def _narrowed(rows: DataFrame, searches: Sequence[_Search], precision: int) -> list[_Search]:
    """One sketch and one exact count of the rows in the searched intervals; each search goes on in the part that holds its rank."""
    k = F.col("_k")
    intervals = sorted({(s.low, s.high) for s in searches})
    held = rows.select("_k", _slots(intervals).alias("_slot"))
    parts = held.groupBy(shard().alias("_shard"), "_slot").agg(F.kll_sketch_agg_double("_k", precision).alias("_q"))
    sketch = parts.groupBy("_slot").agg(F.kll_merge_agg_double("_q", precision).alias("_q"))
    asked = [(s.rank - s.below) / s.inside for s in searches]
    ends = [f for share in asked for f in (max(0.0, share - MARGIN), min(1.0, share + MARGIN))]
    cuts = {r["_slot"]: r["_cuts"] for r in sketch.select("_slot", F.array(*[F.kll_sketch_get_quantile_double("_q", F.lit(f)) for f in ends]).alias("_cuts")).collect()}
    spans = [cuts[intervals.index((s.low, s.high))][2 * i : 2 * i + 2] for i, s in enumerate(searches)]
    pieces = []
    for s, (a, b) in zip(searches, spans):
        tests = [k < a, k == a, (k > a) & (k < b), (k == b) & F.lit(b > a), k > b]
        pieces.append([F.when(k.between(s.low, s.high) & t, k) for t in tests])
    found = rows.agg(*[f(c).alias(f"{n}{i}_{j}") for i, cs in enumerate(pieces) for j, c in enumerate(cs) for n, f in (("n", F.count), ("l", F.min), ("h", F.max))]).first()
    out = []
    for i, s in enumerate(searches):
        below = s.below
        for j in range(5):
            n = found[f"n{i}_{j}"]
            if s.rank <= below + n:
                out.append(replace(s, low=found[f"l{i}_{j}"], high=found[f"h{i}_{j}"], below=below, inside=n))
                break
            below += n
    return out


def exact_quantiles(df: DataFrame, column: str, percents: Sequence[float], at_end: int = 1_000_000, precision: int = 4_000) -> DataFrame:
    """(percent, value): for each percentile the smallest value with at least that share of the rows at or below it.

    For numbers of any type, dates and timestamps, however skewed.  Each pass sketches the rows between two bounds around every
    rank, counts the rows between tighter bounds exactly and goes on there: about a hundred times
    fewer rows a pass, nothing but sketches and counts is moved.  Once at most ``at_end`` rows (or equal keys) are
    left around a rank, their distinct values are counted and ranked.  NULL is left out, NaN is the largest
    value, an empty table gives NULL.
    """
    if any(not 0 <= p <= 100 for p in percents):
        raise ValueError(f"percents must lie between 0 and 100, not {list(percents)}")
    rows = df.select(F.col(f"`{column}`").alias("_v"), _key(df, column).alias("_k")).where("_v IS NOT NULL")
    real = F.when(~F.isnan("_k"), F.col("_k"))
    n, reals, low, high = rows.agg(F.count(F.lit(1)), F.count(real), F.min(real), F.max(real)).first()
    kind = df.schema[column].dataType
    ranks = {p: max(1, ceil(n * Fraction(str(p)) / 100)) for p in percents}
    searches = [_Search(float(p), r, low, high, 0, reals) for p, r in ranks.items() if r <= reals]
    while open_ := [s for s in searches if s.inside > at_end and s.low < s.high]:
        searches = [s for s in searches if s not in open_] + _narrowed(rows, open_, precision)
    spark = df.sparkSession
    beyond = [float(p) for p, r in ranks.items() if r > reals]
    last = float("nan") if n and beyond else None
    rest = spark.createDataFrame([(p,) for p in beyond], "percent double").select("percent", F.lit(last).cast(kind).alias("value"))
    if not searches:
        return rest
    intervals = sorted({(s.low, s.high) for s in searches})
    counts = rows.select("_v", _slots(intervals).alias("_slot")).groupBy("_slot", "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = counts.withColumn("_upto", F.sum("_n").over(W.partitionBy("_slot").orderBy("_v")))
    # One row per percentile, whatever the data.
    wanted = spark.createDataFrame([(s.percent, intervals.index((s.low, s.high)), s.rank - s.below) for s in searches], "percent double, _slot int, _rank long")
    hit = upto.join(F.broadcast(wanted), "_slot").where("_upto >= _rank")
    return hit.groupBy("percent").agg(F.min("_v").alias("value")).unionByName(rest)
