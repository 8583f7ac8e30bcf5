"""As-of joins, stored running sums, and what is served and appended from them."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of, cumulative, totals_as_of
from tidemark.operators.prefix import range_sums
from tidemark.plans import serving
from tidemark.schema import EPOCH, ROW_ID

DAY = 86_400


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows under one key, some under no key, some without a time, crowded and sparse times."""
    draw = random.Random(11)
    data = [(draw.choice(["a", "a", None, "b", "c"]), draw.choice([draw.randrange(9), draw.randrange(400 * DAY), None]), draw.randrange(50)) for _ in range(400)]
    return spark.createDataFrame(data, "k string, t long, v int").repartition(5).cache()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_as_of_finds_the_newest_earlier_row(spark, rows, keys):
    table = rows.where("t IS NOT NULL").groupBy(*keys, "t").agg(F.sum("v").alias("v"))
    probes = rows.select(*keys, (F.col("t") + F.col("v") * 1000 - 20_000).alias("at"))
    got = {tuple(r) for r in as_of(probes, table, "at", "t", ["v"], keys).collect()}
    stored = [tuple(r) for r in table.collect()]
    want = set()
    for p in {tuple(r) for r in probes.collect() if r["at"] is not None}:
        earlier = [s for s in stored if s[:-2] == p[:-1] and s[-2] <= p[-1]]
        want.add((*p, max(earlier, key=lambda s: s[-2])[-1] if earlier else None))
    assert got == want


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_stored_totals_equal_sums_over_the_rows(spark, rows, keys):
    """Rows dealt over three tables regardless of their time."""
    measures, offsets = {"s": F.col("v"), "n": F.lit(1)}, {"now": 1, "week": 7 * DAY + 1, "all": 0}
    dealt = rows.withColumn("part", F.col("v") % 3).cache()
    tables = [cumulative(dealt.where(F.col("part") == i), "t", measures, keys) for i in range(3)]
    got = totals_as_of(rows, tables, "t", list(measures), offsets, keys)
    want = range_sums(rows, "t", measures, offsets, keys).select(*got.columns)
    assert got.count() > 100 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_as_of_on_empty_tables(spark, rows):
    table = rows.where("t IS NOT NULL").groupBy("k", "t").agg(F.sum("v").alias("v"))
    assert as_of(rows.limit(0), table, "t", "t", ["v"], ["k"]).count() == 0
    none = as_of(rows, table.limit(0), "t", "t", ["v"], ["k"])
    assert none.where("v IS NOT NULL").count() == 0 and none.count() == table.count()


def test_floats_are_refused(spark, rows):
    with pytest.raises(TypeError):
        cumulative(rows, "t", {"s": F.col("v").cast("double")})


def test_appending_needs_a_time(spark):
    new = spark.createDataFrame([(1, None)], f"{ROW_ID} long, {EPOCH} long")
    with pytest.raises(ValueError, match="no time"):
        serving.append_payments(new, new, [], new)
    empty = serving.append_payments(new, new, [], new.limit(0))
    assert empty[0] is new and empty[1] == []
