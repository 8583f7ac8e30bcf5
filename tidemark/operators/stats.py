"""Feature statistics, expected schema, histograms and distribution distances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shards import shard


def _kind(data_type: T.DataType) -> str:
    if not isinstance(data_type, T.NumericType):
        return "BYTES"
    return "INT" if isinstance(data_type, T.IntegralType) else "FLOAT"


def _sketches(df: DataFrame, columns: Sequence[str], precision: int = 800) -> DataFrame:
    """One row: a quantile sketch ``q{i}`` per number and a distinct-value sketch ``u{i}`` per column."""
    first, last = [], []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        first.append(F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), 12).alias(f"u{i}"))
        last.append(F.hll_union_agg(f"u{i}").alias(f"u{i}"))
        if _kind(df.schema[name].dataType) != "BYTES":
            first.append(F.kll_sketch_agg_double(c.cast("double"), precision).alias(f"q{i}"))
            last.append(F.kll_merge_agg_double(f"q{i}", precision).alias(f"q{i}"))
    return df.groupBy(shard().alias("_shard")).agg(*first).agg(*last)


def feature_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per feature: exact counts and moments, sketched median and distinct count.

    Features that are not numbers leave the numeric fields NULL.
    """
    columns = list(columns or df.columns)
    null = F.lit(None).cast("double")
    aggregates, exact, sketched = [F.count(F.lit(1)).alias("all_rows")], [], []
    for i, name in enumerate(columns):
        c, kind = F.col(f"`{name}`"), _kind(df.schema[name].dataType)
        aggregates.append(F.count(c).alias(f"n{i}"))
        if kind != "BYTES":
            x = c.cast("double")
            aggregates += [
                F.avg(x).alias(f"a{i}"),
                F.stddev_pop(x).alias(f"s{i}"),
                F.count_if(c == 0).alias(f"z{i}"),
                F.min(x).alias(f"l{i}"),
                F.max(x).alias(f"h{i}"),
            ]

        def number(prefix: str, numeric: bool = kind != "BYTES", i: int = i) -> Column:
            return F.col(f"{prefix}{i}").cast("double") if numeric else null

        exact.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.lit(kind).alias("type"),
                F.col(f"n{i}").alias("present"),
                (F.col("all_rows") - F.col(f"n{i}")).alias("missing"),
                number("a").alias("mean"),
                number("s").alias("std_dev"),
                number("z").cast("bigint").alias("zeros"),
                number("l").alias("min"),
                number("h").alias("max"),
            )
        )
        median = F.kll_sketch_get_quantile_double(f"q{i}", F.lit(0.5)) if kind != "BYTES" else null
        sketched.append(
            F.struct(
                F.lit(name).alias("feature"),
                median.alias("median"),
                F.hll_sketch_estimate(f"u{i}").alias("approx_distinct"),
            )
        )
    rows = df.agg(*aggregates).select(F.inline(F.array(*exact)))
    return rows.join(_sketches(df, columns).select(F.inline(F.array(*sketched))), "feature")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 20) -> DataFrame:
    """Most frequent values per text feature; ties go to the smaller value."""
    long = _long(df, columns, "string").where("value IS NOT NULL")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("feature").orderBy(F.col("n").desc(), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def _long(df: DataFrame, columns: Sequence[str], data_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) rows; narrow, so it fuses with the scan."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(data_type).alias("value")) for c in columns]
    )
    return df.select(*keep, F.inline(cells))


def infer_schema(stats: DataFrame, target: str) -> DataFrame:
    """Expected type, presence and range per feature and environment.

    The target is expected in TRAINING and absent in SERVING.
    """
    environments = F.explode(F.array(F.lit("TRAINING"), F.lit("SERVING")))
    return (
        stats.select(
            "feature",
            "type",
            (F.col("missing") == 0).alias("required"),
            F.col("min").alias("low"),
            F.col("max").alias("high"),
            environments.alias("environment"),
        )
        .withColumn("expected", ~((F.col("feature") == target) & (F.col("environment") == "SERVING")))
    )


def write_profile(df: DataFrame, target: str, folder: str, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Write ``stats`` and ``schema`` tables of the training data; return both as written."""
    folder, spark = folder.rstrip("/"), df.sparkSession
    feature_stats(df, columns).write.mode("overwrite").parquet(f"{folder}/stats")
    stats = spark.read.parquet(f"{folder}/stats")
    infer_schema(stats, target).write.mode("overwrite").parquet(f"{folder}/schema")
    return stats, spark.read.parquet(f"{folder}/schema")


def validate(df: DataFrame, expected: DataFrame, environment: str) -> DataFrame:
    """Anomalies of a table against the expected schema: (feature, anomaly)."""
    seen = feature_stats(df).select(
        "feature", F.col("type").alias("seen_type"), "present", "missing", F.col("min").alias("seen_low"), F.col("max").alias("seen_high")
    )
    want = expected.where(F.col("environment") == environment)
    both = want.join(seen, "feature", "full_outer")
    expected_here = F.coalesce("expected", F.lit(False))
    checks = F.array(
        F.when(F.col("environment").isNull(), F.lit("NEW_COLUMN")),
        F.when(F.col("environment").isNotNull() & ~expected_here & F.col("seen_type").isNotNull(), F.lit("UNEXPECTED_IN_ENVIRONMENT")),
        F.when(expected_here & F.col("seen_type").isNull(), F.lit("COLUMN_MISSING")),
        F.when(expected_here & (F.col("seen_type") != F.col("type")), F.lit("TYPE_CHANGED")),
        F.when(expected_here & F.col("required") & (F.col("missing") > 0), F.lit("VALUES_MISSING")),
        F.when(expected_here & ((F.col("seen_low") < F.col("low")) | (F.col("seen_high") > F.col("high"))), F.lit("OUT_OF_RANGE")),
    )
    return both.select("feature", F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("anomaly"))


def bin_edges(reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, low, high) of the reference data: one row per feature."""
    agg = reference.agg(
        *[F.min(F.col(f"`{c}`").cast("double")).alias(f"l{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(f"`{c}`").cast("double")).alias(f"h{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"))
        for i, c in enumerate(columns)
    ]
    return agg.select(F.inline(F.array(*rows)))


def binned(df: DataFrame, columns: Sequence[str], edges: DataFrame, bins: int = 10, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, bin) of every value; what lies outside the edges goes to the end bins."""
    long = _long(df, columns, "double", keep).where("value IS NOT NULL")
    # One edge row per column of the table, so broadcasting it is always safe.
    joined = long.join(F.broadcast(edges), "feature")
    place = F.floor(F.try_divide(F.col("value") - F.col("low"), F.col("high") - F.col("low")) * bins)
    return joined.select(
        *keep, "feature", F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0)))).cast("int").alias("bin")
    )


def histograms(df: DataFrame, columns: Sequence[str], edges: DataFrame, bins: int = 10, keep: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts (keep..., feature, bin, n)."""
    return binned(df, columns, edges, bins, keep).groupBy(*keep, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def quantile_histogram(df: DataFrame, columns: Sequence[str], buckets: int = 10) -> DataFrame:
    """(feature, bucket, low, high): approximate bounds of equally full buckets, in one pass."""

    def bound(i: int, step: int) -> Column:
        return F.kll_sketch_get_quantile_double(f"q{i}", F.lit(step / buckets))

    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(b).alias("bucket"), bound(i, b).alias("low"), bound(i, b + 1).alias("high"))
        for i, c in enumerate(columns)
        for b in range(buckets)
    ]
    return _sketches(df, columns).select(F.inline(F.array(*rows)))


def category_counts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Counts per category, as a histogram whose bins are the values."""
    long = _long(df, columns, "string", keep).where("value IS NOT NULL").withColumnRenamed("value", "bin")
    return long.groupBy(*keep, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def _shares(counts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    return counts.join(totals, list(keys)).select(*keys, "bin", (F.col("n") / F.col("_total")).alias(name))


def distances(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Jensen-Shannon divergence (base 2) and largest share difference per key.

    Joins histograms, so its cost depends on bins, not on rows.
    """
    keys = list(keys)
    both = _shares(left, keys, "p").join(_shares(right, keys, "q"), [*keys, "bin"], "full_outer")
    p, q = F.coalesce("p", F.lit(0.0)), F.coalesce("q", F.lit(0.0))
    middle = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)

    return both.groupBy(*keys).agg(
        (F.sum(part(p) + part(q)) / 2).alias("js_divergence"), F.max(F.abs(p - q)).alias("l_infinity")
    )


def skew(
    training: DataFrame, serving: DataFrame, thresholds: Mapping[str, float], bins: int = 10, categorical: Sequence[str] = ()
) -> DataFrame:
    """Distance of serving from training per feature, against its threshold."""
    numeric = [c for c in thresholds if c not in categorical]
    parts = []
    if numeric:
        edges = bin_edges(training, numeric)
        d = distances(histograms(training, numeric, edges, bins), histograms(serving, numeric, edges, bins))
        parts.append(d.select("feature", F.col("js_divergence").alias("distance")))
    if categorical:
        d = distances(category_counts(training, categorical), category_counts(serving, categorical))
        parts.append(d.select("feature", F.col("l_infinity").alias("distance")))
    out = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    return with_alerts(out, thresholds)


def with_alerts(measured: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    limit = F.coalesce(*[F.when(F.col("feature") == f, F.lit(t)) for f, t in thresholds.items()])
    return measured.withColumn("threshold", limit).withColumn("alert", F.col("distance") > F.col("threshold"))


def drift(windowed: DataFrame, thresholds: Mapping[str, float], window: str = "window_start") -> DataFrame:
    """Distance between consecutive windows of ``(window, feature, bin, n)`` histograms."""
    steps = windowed.select("feature", window).distinct()
    previous = steps.withColumn("_previous", F.lag(window).over(W.partitionBy("feature").orderBy(window)))
    earlier = (
        previous.where("_previous IS NOT NULL")
        .join(windowed.withColumnRenamed(window, "_previous"), ["feature", "_previous"])
        .select("feature", window, "bin", "n")
    )
    later = windowed.join(previous.where("_previous IS NOT NULL").select("feature", window), ["feature", window])
    measured = distances(earlier, later, [window, "feature"])
    return with_alerts(measured.select(window, "feature", F.col("js_divergence").alias("distance")), thresholds)
