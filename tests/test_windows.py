"""Prefix sums and windows against hand-made tables and plain Python."""

import datetime
import random
from decimal import Decimal
from fractions import Fraction
from math import ceil

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.bands import halo_banded_window
from tidemark.operators.joins import attach, hot_keys
from tidemark.operators.prefix import DAY, double_levels, id_levels, range_mean, running_totals
from tidemark.operators.quantile import approximate_quantile, discrete_quantile, exact_quantiles
from tidemark.plans import features as P
from tidemark.plans.split import assign_split, temporal_split

BASE = 1_000_000_000


def payments(spark, rows):
    """rows: (id, user, epoch, amount, is_fraud)."""
    df = spark.createDataFrame(rows, "transaction_id long, user long, datetime_unix_seconds long, amount double, is_fraud int")
    return df.withColumns(
        {
            "amount": F.col("amount").cast("decimal(12,2)"),
            "datetime": F.timestamp_seconds("datetime_unix_seconds").cast("timestamp_ntz"),
        }
    )


def by_id(df, *columns):
    return {r["transaction_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("hot_rows", [200_000, 1])
def test_user_frame_edges(spark, hot_rows):
    t = BASE
    df = payments(
        spark,
        [(1, 1, t, 8.0, 0), (2, 1, t - 1, 4.0, 0), (3, 1, t - DAY, 2.0, 0), (4, 1, t - DAY - 1, 1.0, 0), (5, 2, t, 7.0, 0), (6, 2, t, 9.0, 0), (7, 2, t, 11.0, 0)],
    )
    out = by_id(P.user_windows(df, hot_rows=hot_rows), "mean_amount_last_1_days", "mean_amount", "transaction_count")
    assert out[1] == (3.0, pytest.approx(7 / 3), 3)  # t-1 and t-DAY, not t-DAY-1
    # Peers of one second do not see each other by time, but do by row order.
    assert [out[i][0] for i in (5, 6, 7)] == [0.0, 0.0, 0.0]
    assert [out[i][1:] for i in (5, 6, 7)] == [(0.0, 0), (7.0, 1), (8.0, 2)]


@pytest.mark.parametrize("hot_rows", [200_000, 1])
def test_first_row_and_midnight(spark, hot_rows):
    late = 1577923140  # 2020-01-01 23:59 UTC
    df = payments(spark, [(1, 1, late, 5.0, 0), (2, 1, late + 120, 6.0, 0), (3, 2, late, 1.0, 0)])
    out = by_id(
        P.user_windows(df, hot_rows=hot_rows),
        "days_since_first_transaction",
        "transaction_count",
        "transaction_frequency_all",
        "transaction_frequency_last_7_days",
        "mean_amount",
    )
    assert out[3] == (0, 0, 0.0, 0.0, 0.0)
    assert out[2][0] == 1 and out[2][1] == 1
    assert out[2][2] == 0.0 and out[2][3] == 1.0  # (count - 1) / days, and 1 / least(7, 1)


def test_hot_path_equals_native_path(spark):
    rng = random.Random(3)
    rows = [
        (i * (1 << 33) - 5, 1 if i % 3 == 0 else rng.randrange(2, 9), BASE + rng.choice([0, 60, DAY, 40 * DAY, 400 * DAY]) + rng.randrange(3), rng.randrange(1, 10_000) / 100, 0)
        for i in range(600)
    ]
    df = payments(spark, rows)
    native, bucketed = (P.user_ratios(P.user_windows(df, hot_rows=n)) for n in (200_000, 1))
    assert sorted(map(str, native.collect())) == sorted(map(str, bucketed.select(native.columns).collect()))


def test_null_amounts_do_not_count(spark):
    df = payments(spark, [(1, 1, BASE, 4.0, 0), (2, 1, BASE + 1, None, 0), (3, 1, BASE + 2, 6.0, 0)])
    for hot_rows in (200_000, 1):
        out = by_id(P.user_windows(df, hot_rows=hot_rows), "mean_amount", "mean_amount_last_1_days", "transaction_count")
        assert out[3] == (4.0, 4.0, 2)


def test_delay_edges(spark):
    delay, width = 7 * DAY, 30 * DAY
    t = BASE
    rows = [(1, 1, t, 0.0, 1), (2, 1, t - delay, 0.0, 1), (3, 1, t - delay + 1, 0.0, 1), (4, 1, t - width, 0.0, 0), (5, 1, t - width - 1, 0.0, 0)]
    means = range_mean(payments(spark, rows), "datetime_unix_seconds", ["is_fraud"], {"w": width}, delay)
    at_t = {r["datetime_unix_seconds"]: r["is_fraud_w"] for r in means.collect()}
    assert at_t[t] == 0.5  # t - delay and t - width, nothing fresher or older
    assert at_t[t - width - 1] is None


def test_range_mean_against_native_window(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 1, 1, 2, None]), BASE + rng.randrange(0, 30 * DAY, 777), rng.randrange(100) / 10, rng.choice([0, 1, None])) for i in range(800)]
    df = payments(spark, rows)
    ts = "datetime_unix_seconds"
    for keys in ([], ["user"]):
        means = range_mean(df, ts, ["is_fraud", "amount"], {"a": 9 * DAY, "b": None}, DAY, keys=keys)
        got = attach(df, means, [*keys, ts], null_safe=keys)
        w = W.partitionBy(*keys).orderBy(ts)
        want = df.select(
            "transaction_id",
            F.avg("is_fraud").over(w.rangeBetween(-9 * DAY, -DAY)).alias("x"),
            F.avg(F.col("amount").cast("double")).over(w.rangeBetween(W.unboundedPreceding, -DAY)).alias("y"),
        )
        a, b = by_id(got, "is_fraud_a", "amount_b"), by_id(want, "x", "y")
        assert a.keys() == b.keys()
        for k in a:
            assert a[k] == pytest.approx(b[k]), k


def test_window_shorter_than_delay_is_refused(spark):
    with pytest.raises(ValueError):
        range_mean(payments(spark, [(1, 1, BASE, 1.0, 0)]), "datetime_unix_seconds", ["is_fraud"], {"w": DAY}, 7 * DAY)


def test_bands_equal_one_global_window(spark):
    rng = random.Random(7)
    edges = [978307200, 1293840000, 1451606400]  # 1 January 2001, 2011 and 2016
    rows = [(i, 1, rng.choice(edges) + rng.randrange(-900 * DAY, 900 * DAY), 1.0, rng.randrange(2)) for i in range(500)]
    rows += [(1000 + i, 1, e + d, 1.0, 1) for i, (e, d) in enumerate((e, d) for e in edges for d in (-1, 0, 1))]
    df, ts = payments(spark, rows), "datetime_unix_seconds"
    banded = by_id(halo_banded_window(df, ts, {"m": ("is_fraud", 730 * DAY)}, 7 * DAY, band=365 * DAY), "m")
    w = W.orderBy(ts).rangeBetween(-730 * DAY, -7 * DAY)
    whole = by_id(df.select("transaction_id", F.coalesce(F.avg("is_fraud").over(w), F.lit(0.0)).alias("m")), "m")
    prefix = range_mean(df, ts, ["is_fraud"], {"m": 730 * DAY}, 7 * DAY)
    prefix = by_id(attach(df, prefix, [ts]).withColumn("m", F.coalesce("is_fraud_m", F.lit(0.0))), "m")
    assert banded.keys() == whole.keys() == prefix.keys()
    for k in whole:
        assert banded[k] == pytest.approx(whole[k]) and prefix[k] == pytest.approx(whole[k])


def test_running_totals_with_one_huge_group(spark):
    rng = random.Random(11)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(300)] + list(range(300))
    rows = [(i, "hot" if n % 3 else "cold", n % 5) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id long, k string, v long")
    out = running_totals(df, id_levels(F.col("id")), ["id"], {"v": F.col("v"), "n": F.lit(1)}, keys=["k"])
    got = {(r["k"], r["id"]): (r["v_before"], r["n_before"]) for r in out.collect()}
    want = {}
    for k in ("hot", "cold"):
        total = count = 0
        for i, _, v in sorted(r for r in rows if r[1] == k):
            want[(k, i)] = (total, count)
            total, count = total + v, count + 1
    assert got == want


def test_double_levels_keep_the_order(spark):
    rng = random.Random(13)
    values = [0.0, 1.0, 0.5, 2.0, -1.0, -0.5, 1e-300, 5e-324, -1e-12, 0.1, 0.1 + 1e-17, 1e300]
    values += [2.0**e for e in range(-60, 60)] + [-(2.0**e) for e in range(-5, 5)]
    values += [rng.random() * 10.0 ** rng.randrange(-12, 3) for _ in range(500)]
    values += [0.3 + i * 2.0**-54 for i in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    a, b = double_levels(F.col("v"))
    rows = sorted((r["v"], r["a"], r["b"]) for r in df.select("v", a.alias("a"), b.alias("b")).collect())
    cuts = [(a, b) for _, a, b in rows]
    assert cuts == sorted(cuts)


def test_hot_keys_are_bounded(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert [r["k"] for r in hot_keys(df, "k", min_rows=10).collect()] == [0]
    assert hot_keys(df, "k", min_rows=0, max_keys=5).count() <= 5
    assert hot_keys(df, "k", min_rows=500).count() == 0


@pytest.mark.parametrize("percent,want", [(1, 10), (50, 20), (70, 30), (100, 50)])
def test_discrete_quantile(spark, percent, want):
    values = [10] * 30 + [20] * 30 + [30] * 20 + [40] * 10 + [50 * 1] * 10
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert discrete_quantile(df, "v", percent).first()[0] == want
    assert approximate_quantile(df, "v", percent).first()[0] == want


def test_split_is_disjoint_and_complete(spark):
    rng = random.Random(17)
    df = payments(spark, [(i, 1, BASE + rng.randrange(10**6), 1.0, 0) for i in range(1000)])
    parts = [{r["transaction_id"] for r in p.collect()} for p in temporal_split(df)]
    assert sum(map(len, parts)) == 1000 and set.union(*parts) == set(range(1000))
    assert 680 <= len(parts[0]) <= 700
    tagged = assign_split(df)
    newest = tagged.where("split = 'training'").agg(F.max("datetime_unix_seconds")).first()[0]
    oldest = tagged.where("split <> 'training'").agg(F.min("datetime_unix_seconds")).first()[0]
    assert newest < oldest


@pytest.mark.parametrize(
    "source,scale,train,valid,test",
    [("events", "sf0.001", 699, 150, 151), ("orders", "sf0.001", 1049, 230, 221), ("orders", "sf0.01", 10498, 2245, 2257)],
)
def test_split_sizes_on_all_rows(spark, source, scale, train, valid, test):
    df = spark.read.parquet(f"/root/testdata/{scale}/{source}.parquet")
    key, at = ("event_id", "ts") if source == "events" else ("o_orderkey", "o_orderdate")
    df = df.select(F.col(key).alias("transaction_id"), F.unix_seconds(F.col(at).cast("timestamp")).alias("datetime_unix_seconds"))
    sizes = {r["split"]: r["count"] for r in assign_split(df).groupBy("split").count().collect()}
    assert sizes == {"training": train, "validation": valid, "testing": test}


def test_no_feature_sees_the_future(spark, sf):
    """Changing fresh labels and later rows leaves earlier features as they were."""
    from tidemark.sources.adapters import cards_from_customer, transactions_from_orders, users_from_customer
    from tidemark.sources.holidays import us_holidays

    tx = transactions_from_orders(spark, sf)
    day = F.make_date("Year", "Month", "Day")
    cut = F.lit("1998-06-01").cast("date")
    others = (users_from_customer(spark, sf), cards_from_customer(spark, sf), us_holidays(spark))
    changed = tx.where(day <= cut).withColumn(
        "Is_Fraud_", F.when(day > F.date_sub(cut, 7), ~F.col("Is_Fraud_")).otherwise(F.col("Is_Fraud_"))
    )
    before, after = (P.build_features(t, *others).drop("is_fraud") for t in (tx, changed))
    limit = 896659200  # 1 June 1998
    left = before.where(F.col("datetime_unix_seconds") <= limit)
    assert after.count() == left.count() > 0
    assert left.exceptAll(after).count() == 0


def test_hot_join_key_is_split_over_tasks(spark):
    """A third of all rows on one (category, second): the join back must not sit in one task."""
    n = 300_000
    df = spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997).alias("mcc"),
        F.when(F.col("id") % 3 == 0, BASE).otherwise(BASE + F.col("id") % 50_021 * 60).alias("datetime_unix_seconds"),
        (F.col("id") % 7 == 0).cast("int").alias("is_fraud"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"),
    )
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in tight}
    try:
        for k, v in tight.items():
            spark.conf.set(k, v)
        out = P.delayed_mean_encoding(df)
        assert out.agg(F.count(F.lit(1)), F.countDistinct("transaction_id")).first() == (n, n)
        seen = out.select("transaction_id", "pad", "mcc_mean_encoding")
        seen.collect()
        assert "skew=true" in seen._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_without_a_time_are_treated_alike(spark):
    rows = [(1, 1, None, 8.0, 0), (2, 1, None, None, 0), (3, 1, BASE, 2.0, 0), (4, 1, BASE + 5, 1.0, 0), (5, 2, None, 3.0, 0)]
    out = [by_id(P.user_windows(payments(spark, rows), hot_rows=n), "transaction_count", "mean_amount", "mean_amount_last_1_days", "days_since_first_transaction") for n in (200_000, 1)]
    assert out[0] == out[1] and [out[0][i][0] for i in range(1, 6)] == [0, 1, 2, 3, 0]
    assert out[0][4][1:3] == (5.0, 2.0)


def test_floating_point_input_is_refused(spark):
    df = payments(spark, [(1, 1, BASE, 8.0, 0)]).withColumn("amount", F.lit(0.1))
    ts = "datetime_unix_seconds"
    for call in (lambda: range_mean(df, ts, ["amount"], {"w": DAY}, 1), lambda: P.user_windows(df), lambda: halo_banded_window(df, ts, {"m": ("amount", DAY)}, 1, DAY)):
        with pytest.raises(TypeError, match="DECIMAL"):
            call()
    with pytest.raises(ValueError, match="widen"):
        halo_banded_window(payments(spark, [(1, 1, BASE, 8.0, 0)]), ts, {"m": ("is_fraud", 730 * DAY)}, DAY, band=60)


@pytest.mark.parametrize("kind,draw", [
    ("double", lambda r: r.choice([0.0, -0.0, float("inf"), float("nan"), r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300)])),
    ("double", lambda r: r.choice([1.0, 1.0, 2.0])),
    ("decimal(20, 4)", lambda r: Decimal(r.randrange(10**12)) / 10_000),
    ("date", lambda r: datetime.date(2000, 1, 1) + datetime.timedelta(r.randrange(9000))),
    ("timestamp", lambda r: datetime.datetime(2000, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(seconds=r.randrange(10**8))),
])
def test_exact_quantiles_narrow_to_the_value(spark, kind, draw):
    """Percentiles close to each other, ties, NaN last; few rows left at the end, so several passes run."""
    r = random.Random(3)
    values = [draw(r) for _ in range(2_000)]
    percents = [0, 0.1, 33.3, 50, 50.05, 50.1, 99.9, 100]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 9, f"v {kind}").repartition(7).cache()
    ordered = [x["v"] for x in df.where("v IS NOT NULL").sort("v").collect()]
    got = {x["percent"]: x["value"] for x in exact_quantiles(df, "v", percents, at_end=20, precision=200).collect()}
    for p in percents:
        want = ordered[max(1, ceil(len(ordered) * Fraction(str(p)) / 100)) - 1]
        assert got[p] == want or (got[p] != got[p] and want != want), (p, got[p], want)


def test_exact_quantiles_of_nothing_and_of_text(spark):
    df = spark.createDataFrame([(None, "a")], "v double, t string")
    assert [tuple(x) for x in exact_quantiles(df, "v", [50]).collect()] == [(50.0, None)]
    with pytest.raises(TypeError):
        exact_quantiles(df, "t", [50])
    with pytest.raises(ValueError):
        exact_quantiles(df, "v", [101])
