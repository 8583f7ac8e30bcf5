"""As-of joins and totals read from stored running sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import attach
from .prefix import DAY, require_exact, running_totals


def _packed(keys: Sequence[str]) -> list[Column]:
    return [F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key")] if keys else []


def as_of(
    probes: DataFrame, table: DataFrame, at: str, ts: str, values: Sequence[str], keys: Sequence[str] = (), bucket: int = DAY
) -> DataFrame:
    """For every distinct (keys, ``at``) of the probes the newest row of ``table`` with ``ts`` at or before it.

    ``table`` holds one row per (keys, ts), both times are integers; NULL keys match each other.
    Without such a row the values are NULL.  Probes and rows meet per key and bucket of
    time, at most ``bucket`` rows and the probes' distinct instants; what lies before a bucket comes from
    the newest row of each earlier one (one row per calendar bucket), so neither a hot key nor the
    keyless case is one task.
    """
    key = ["_key"] if keys else []
    found = F.struct(*[F.col(f"`{v}`") for v in values])
    rows = table.select(*_packed(keys), F.col(ts).alias("_at"), F.lit(0).alias("_kind"), found.alias("_v"))
    marks = probes.select(*_packed(keys), F.col(at).alias("_at"), F.lit(1).alias("_kind")).distinct()
    both = rows.unionByName(marks, allowMissingColumns=True).where("_at IS NOT NULL")
    both = both.withColumn("_bucket", F.floor(F.col("_at") / F.lit(bucket)))
    inside = W.partitionBy(*key, "_bucket").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    hits = both.withColumn("_v", F.last("_v", ignorenulls=True).over(inside)).where("_kind = 1").drop("_kind")
    newest = both.groupBy(*key, "_bucket").agg(F.max_by("_v", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_v"))
    before = W.partitionBy(*key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    earlier = newest.select(*key, "_bucket", F.last("_v", ignorenulls=True).over(before).alias("_e"))
    out = attach(hits, earlier, [*key, "_bucket"], "inner").withColumn("_v", F.coalesce("_v", "_e"))
    return out.select(*[F.col(f"_key.`{k}`").alias(k) for k in keys], F.col("_at").alias(at), *[F.col(f"_v.`{v}`").alias(v) for v in values])


def cumulative(df: DataFrame, ts: str, measures: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, ts): the total of each measure over all rows at or before it, to be stored and read by `totals_as_of`.

    Measures are integers or decimals; rows without a time are left out.
    """
    names = list(measures)
    key = ["_key"] if keys else []
    instants = df.where(F.col(ts).isNotNull()).groupBy(*_packed(keys), F.col(ts).alias("_ts")).agg(
        *[F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in measures.items()]
    )
    require_exact(instants, names)
    ranked = running_totals(instants, [F.floor(F.col("_ts") / F.lit(DAY))], ["_ts"], {n: F.col(n) for n in names}, keys=key)
    return ranked.select(
        *[F.col(f"_key.`{k}`").alias(k) for k in keys], F.col("_ts").alias(ts), *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in names]
    )


def totals_as_of(
    probes: DataFrame, tables: Sequence[DataFrame], ts: str, measures: Sequence[str], offsets: Mapping[str, int], keys: Sequence[str] = ()
) -> DataFrame:
    """`range_sums` from stored running sums: totals over all rows at or before ``ts - offset``, one row per (keys, ts) of the probes.

    ``tables`` come from `cumulative` over disjoint sets of rows, in any order of time; their totals add up.
    """
    kinds = list(offsets)
    moves = F.array(*[F.struct(F.lit(i).alias("kind"), F.lit(offsets[k]).cast("bigint").alias("shift")) for i, k in enumerate(kinds)])
    instants = probes.where(F.col(ts).isNotNull()).select(*_packed(keys), F.col(ts).alias("_ts")).distinct()
    moved = instants.select("*", F.explode(moves).alias("_move")).withColumn("_probe", F.col("_ts") - F.col("_move.shift"))
    key = ["_key"] if keys else []
    # All tables in one pass, each with probes of its own: the plan does not grow with their number.
    moved = moved.withColumn("_table", F.explode(F.array(*[F.lit(i) for i in range(len(tables))])))
    stored = [t.select(*_packed(keys), F.lit(i).alias("_table"), F.col(ts).alias("_at"), *measures) for i, t in enumerate(tables)]
    found = as_of(moved, reduce(DataFrame.unionByName, stored), "_probe", "_at", measures, [*key, "_table"])
    joined = attach(moved, found, [*key, "_table", "_probe"])
    sums = [F.coalesce(F.sum(F.when(F.col("_move.kind") == i, F.col(m))), F.lit(0)).alias(f"{m}_{k}") for i, k in enumerate(kinds) for m in measures]
    out = joined.groupBy(*key, "_ts").agg(*sums)
    return out.select(*[F.col(f"_key.`{k}`").alias(k) for k in keys], F.col("_ts").alias(ts), *[f"{m}_{k}" for k in kinds for m in measures])
