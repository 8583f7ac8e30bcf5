"""Exact prefix sums over a time line or any total order, without one big partition.

A window over a whole table runs in one task, and Spark re-adds every row of a
sliding frame.  Both operators here cut the order into buckets of bounded
size instead: rows are summed inside their bucket in parallel, bucket totals are
summed over the (few) buckets, and the two are added.  Buckets come from
arithmetic on the ordering value, never from sampling, so a retried task
always sees the same ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import attach

DAY = 86_400


def require_exact(df: DataFrame, columns: Sequence[str]) -> None:
    """Prefix sums are subtracted from each other, which only integers and decimals survive."""
    kinds = dict(df.dtypes)
    loose = [c for c in columns if kinds.get(c) in ("float", "double")]
    if loose:
        raise TypeError(f"{loose} are floating point; cast them to a decimal, e.g. CAST(x AS DECIMAL(18, 6))")


def range_sums(
    df: DataFrame,
    ts: str,
    measures: Mapping[str, Column],
    offsets: Mapping[str, int],
    keys: Sequence[str] = (),
    bucket: int = DAY,
) -> DataFrame:
    """Totals of each measure over all rows at or before ``ts - offset``.

    One row per distinct (keys, ts) with a column ``{measure}_{offset name}``
    for every pair.  Differences of two offsets give any RANGE frame.

    1. rows collapse to one per (keys, second), so a hot second is combined
       on the map side;
    2. each second is replayed once per offset, moved later by that offset, next
       to one marker row at its own time: what a marker has passed is its total;
    3. markers add up what passed earlier in their bucket (at most ``bucket``
       seconds of data per offset), plus the totals of all earlier buckets (one row per
       calendar bucket).
    """
    names = list(measures)
    kinds = list(offsets)
    # The keys travel as one struct, which is never NULL itself: NULL keys then
    # group and join like any other value and every step shares one partitioning.
    key = ["_key"] if keys else []
    packed = [F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key")] if keys else []
    instants = df.groupBy(*packed, F.col(ts).alias("_ts")).agg(*[F.sum(e).alias(n) for n, e in measures.items()])
    moves = F.array(
        F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("bigint").alias("shift")),
        *[
            F.struct(F.lit(i).alias("kind"), F.lit(offsets[k]).cast("bigint").alias("shift"))
            for i, k in enumerate(kinds)
        ],
    )
    replay = (
        instants.where("_ts IS NOT NULL")
        .withColumn("_move", F.explode(moves))
        .selectExpr(*key, "_ts + _move.shift AS _at", "_move.kind AS _kind", *names)
        .withColumn("_bucket", F.floor(F.col("_at") / F.lit(bucket)))
    )
    passed = {
        f"{n}_{k}": f"sum(CASE WHEN _kind = {i} THEN `{n}` END)" for i, k in enumerate(kinds) for n in names
    }
    in_bucket = W.partitionBy(*key, "_bucket").orderBy("_at").rangeBetween(W.unboundedPreceding, 0)
    # Shuffle and sort the narrow rows; the window would widen them first.
    narrow = replay.repartition(*key, "_bucket").sortWithinPartitions(*key, "_bucket", "_at")
    markers = (
        narrow.select(
            *key, "_bucket", "_at", "_kind", *[F.expr(e).over(in_bucket).alias(c) for c, e in passed.items()]
        )
        .where("_kind = -1")
        .drop("_kind")
    )
    before = W.partitionBy(*key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    earlier = (
        replay.groupBy(*key, "_bucket")
        .agg(*[F.expr(f"{e} AS `{c}`") for c, e in passed.items()])
        .select(*key, "_bucket", *[F.sum(c).over(before).alias(f"_e_{c}") for c in passed])
    )
    return attach(markers, earlier, [*key, "_bucket"], "inner").selectExpr(
        *[f"_key.`{k}` AS `{k}`" for k in keys],
        f"_at AS `{ts}`",
        *[f"coalesce(`{c}`, 0) + coalesce(`_e_{c}`, 0) AS `{c}`" for c in passed],
    )


def mean_measures(values: Sequence[str], complete: Sequence[str] = ()) -> tuple[dict[str, Column], dict[str, str]]:
    """What `range_mean` adds up for each value, and the name of each value's row count."""
    measures = {f"s{i}": F.col(v) for i, v in enumerate(values)}
    counter = {}
    for i, v in enumerate(values):
        counter[v] = "rows" if v in complete else f"n{i}"
        measures[counter[v]] = F.lit(1) if v in complete else F.when(F.col(v).isNotNull(), 1).otherwise(0)
    return measures, counter


def range_mean(
    df: DataFrame,
    ts: str,
    values: Sequence[str],
    windows: Mapping[str, int],
    delay: int,
    keys: Sequence[str] = (),
    complete: Sequence[str] = (),
    names: Mapping[tuple[str, str], str] | None = None,
    sums: Callable[[Mapping[str, Column], Mapping[str, int]], DataFrame] | None = None,
) -> DataFrame:
    """Mean of each value over ``[ts - window, ts - delay]``, one row per (keys, ts).

    Same result as ``avg(value) over (partition by keys order by ts range
    between window preceding and delay preceding)``; NULL on an empty frame.  A window of
    None has no lower end.  Values are integers or decimals and stay exact; floating-point
    ones raise TypeError.  Values listed
    in ``complete`` hold no NULL and share one row count.  ``sums`` may supply the totals that
    `range_sums` would find, for instance from stored ones.
    """
    for label, width in windows.items():
        if width is not None and width < delay:
            raise ValueError(f"window {label} ends before it starts: {width} < delay {delay}")
    require_exact(df, values)
    measures, counter = mean_measures(values, complete)
    offsets = {"hi": delay, **{f"lo{j}": w + 1 for j, w in enumerate(windows.values()) if w is not None}}
    found = sums(measures, offsets) if sums else range_sums(df, ts, measures, offsets, keys)

    def frame(measure: str, j: int, width: int | None) -> str:
        return f"{measure}_hi" if width is None else f"({measure}_hi - {measure}_lo{j})"

    columns = []
    for i, v in enumerate(values):
        for j, (label, width) in enumerate(windows.items()):
            total, rows = frame(f"s{i}", j, width), frame(counter[v], j, width)
            name = (names or {}).get((v, label), f"{v}_{label}")
            columns.append(f"try_divide(CAST({total} AS DOUBLE), CAST({rows} AS DOUBLE)) AS `{name}`")
    return found.selectExpr(*[f"`{k}`" for k in keys], f"`{ts}`", *columns)


def running_totals(
    df: DataFrame,
    levels: Sequence[Column],
    order: Sequence[Column | str],
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Adds ``{measure}_before``: the sum over all rows earlier in the total order.

    ``levels`` are order-preserving cuts of the order, coarse to fine; rows that
    agree on all of them meet in one task, and so do the sub-buckets of one
    bucket.  Choose them so that both counts are bounded.
    """
    names = list(measures)
    cuts = [f"_l{i}" for i in range(len(levels))]
    rows = df.select("*", *[e.alias(c) for c, e in zip(cuts, levels)], *[e.alias(f"_m_{n}") for n, e in measures.items()])

    def sum_before(window, n):
        return F.coalesce(F.sum(f"_m_{n}").over(window), F.lit(0))

    totals = {}
    finer = rows
    for depth in range(len(cuts), 0, -1):
        finer = finer.groupBy(*keys, *cuts[:depth]).agg(*[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in names])
        totals[depth] = finer
    earlier = None
    for depth in range(1, len(cuts) + 1):
        siblings = W.partitionBy(*keys, *cuts[: depth - 1]).orderBy(cuts[depth - 1])
        siblings = siblings.rowsBetween(W.unboundedPreceding, -1)
        here = totals[depth].select(*keys, *cuts[:depth], *[sum_before(siblings, n).alias(f"_s_{n}") for n in names])
        if earlier is not None:
            here = attach(here, earlier, [*keys, *cuts[: depth - 1]], "inner").withColumns(
                {f"_s_{n}": F.col(f"_s_{n}") + F.col(f"_b_{n}") for n in names}
            )
        earlier = here.select(*keys, *cuts[:depth], *[F.col(f"_s_{n}").alias(f"_b_{n}") for n in names])
    peers = W.partitionBy(*keys, *cuts).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = rows.withColumns({f"_s_{n}": sum_before(peers, n) for n in names})
    return (
        attach(within, earlier, [*keys, *cuts], "inner")
        .withColumns({f"{n}_before": F.col(f"_s_{n}") + F.col(f"_b_{n}") for n in names})
        .drop(*cuts, *[f"_{p}_{n}" for p in "msb" for n in names])
    )


def id_levels(row_id: Column) -> list[Column]:
    """Cuts for a 64-bit id: no more than 2^24, 2^20 and 2^20 items at each step."""
    return [F.shiftright(row_id, 40), F.shiftright(row_id, 20)]


def double_levels(value: Column) -> list[Column]:
    """Cuts for a double, wherever its values crowd together.

    First sign, binary exponent and 12 mantissa bits, then 24 more bits, which
    leaves at most 2^16 distinct doubles per final bucket.
    """
    finite = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    size = F.abs(finite)
    exponent = F.when(finite == 0, F.lit(0)).otherwise(F.floor(F.log2(size)).cast("int"))
    mantissa = F.when(finite == 0, F.lit(0.0)).otherwise(finite / F.pow(F.lit(2.0), exponent))
    scale = F.when(finite > 0, exponent + 1100).when(finite < 0, -(exponent + 1100)).otherwise(0)
    coarse = scale.cast("bigint") * 16_384 + F.floor(mantissa * 4_096)
    # Infinities and NaN (largest in Spark's order) have levels of their own at the ends.
    ends = F.when(F.isnan(value), 2 << 40).when(value > 0, 1 << 40).otherwise(-(1 << 40))
    return [F.coalesce(coarse, ends.cast("bigint")), F.coalesce(F.floor(mantissa * float(1 << 36)), F.lit(0))]
