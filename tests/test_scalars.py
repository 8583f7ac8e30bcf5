"""Scalar rules, flags, holidays and versions on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.plans import features as P
from tidemark.schema import FEATURES, MONITORED
from tidemark.sources import files as IO
from tidemark.sources.holidays import holiday_flag, us_holidays


def one(spark, schema, row, *exprs):
    return tuple(spark.createDataFrame([row], schema).select(*exprs).first())


def test_feature_list():
    assert len(FEATURES) == len(set(FEATURES)) == 80
    assert set(MONITORED) <= set(FEATURES)


def test_nulls(spark):
    users = spark.createDataFrame(
        [(1, None, "$59696", "$0", "$-12")],
        "User long, Gender string, `Per Capita Income - Zipcode` string, `Yearly Income - Person` string, `Total Debt` string",
    )
    row = P.user_features(users).first()
    assert row["gender"] == 1
    assert [float(row[c]) for c in ("per_capita_income_zipcode", "yearly_income_person", "total_debt")] == [59696.0, 0.0, -12.0]
    cards = spark.createDataFrame(
        [(1, 0, None, None, None, None, None)],
        "User long, CARD_INDEX long, Card_Brand string, Card_Type string, Credit_Limit string, Has_Chip boolean, Card_on_Dark_Web boolean",
    )
    row = P.card_features(cards).first()
    assert [row[c] for c in ("amex", "visa", "credit", "has_chip", "card_on_dark_web")] == [0] * 5
    tx = spark.createDataFrame(
        [(1, 1, 0, 2015, 1, 4, "06:30", 1.0, None, 5411, None)],
        "transaction_id long, User long, Card long, Year int, Month int, Day int, Time string, Amount double, Use_Chip string, MCC int, Is_Fraud_ boolean",
    )
    row = P.transaction_features(tx).first()
    assert row["is_fraud"] is None and row["chip_transaction"] == 0 and row["is_2015_or_later"] == 1
    assert row["hour_sin"] == pytest.approx(1.0) and str(row["datetime"]) == "2015-01-04 06:30:00"


def test_week(spark):
    df = spark.createDataFrame([(date(2024, 1, 7 + i),) for i in range(7)], "d date")  # starts on a Sunday
    rows = df.select(F.dayofweek("d"), S.is_weekend(F.col("d")), F.weekday("d")).collect()
    assert [r[0] for r in rows] == [1, 2, 3, 4, 5, 6, 7]
    assert [r[1] for r in rows] == [1, 0, 0, 0, 0, 0, 1]
    assert [r[2] for r in rows] == [6, 0, 1, 2, 3, 4, 5]


def test_rounding_and_ratios(spark):
    row = one(spark, "a double, b double", (69.99999, -2.5), S.round_to_int(F.col("a")), S.round_to_int(F.col("b")))
    assert row == (70, -3)
    assert [S.half_up(x) for x in (69.99999999999999, 2.5, -2.5, 0.49)] == [70, 3, -3, 0]
    row = one(spark, "a double, b double", (1.0, 0.0), S.safe_ratio(F.col("a"), F.col("b")), S.safe_ratio(F.col("b"), F.col("a")))
    assert row == (0.0, 0.0)
    assert one(spark, "i long", (-142,), S.bucket100(F.col("i"))) == (42,)


def test_zero_denominators(spark):
    names = [f"fraud_{c}rolling_mean_{w}" for c in P.INDICATORS for w in P.RATE_WINDOWS]
    df = spark.createDataFrame([tuple(0.0 for _ in names)], ", ".join(f"{n} double" for n in names))
    filled = P.channel_shares(P.rate_ratios(df)).drop(*names).first()
    assert set(filled) == {0.0} and len(filled) == 36
    raw = P.channel_shares(P.rate_ratios(df, own=True, fill=False), fill=False).drop(*names).first()
    assert set(raw) == {None}


def test_holidays(spark):
    days = {(r["date"], r["name"]) for r in us_holidays(spark).collect()}
    for d, name in (
        (date(2021, 6, 19), "Juneteenth National Independence Day"),
        (date(2021, 6, 18), "Juneteenth National Independence Day (Observed)"),
        (date(2021, 12, 31), "New Year's Day (Observed)"),
        (date(2022, 1, 1), "New Year's Day"),
        (date(1986, 1, 20), "Martin Luther King Jr. Day"),
        (date(2024, 2, 19), "Washington's Birthday"),
        (date(2024, 5, 27), "Memorial Day"),
        (date(2024, 9, 2), "Labor Day"),
        (date(2024, 10, 14), "Columbus Day"),
        (date(2024, 11, 28), "Thanksgiving"),
        (date(2023, 11, 10), "Veterans Day (Observed)"),
        (date(2022, 12, 26), "Christmas Day (Observed)"),
    ):
        assert (d, name) in days
    assert not any(n.startswith("Juneteenth") and d.year < 2021 for d, n in days)
    assert not any(n.startswith("Martin") and d.year < 1986 for d, n in days)


def test_holiday_flag_keeps_rows_once(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "i int, d date")
    double = us_holidays(spark).unionByName(us_holidays(spark))
    out = {r["i"]: r["is_holiday"] for r in holiday_flag(df, "d", double).collect()}
    assert out == {1: 1, 2: 0, 3: 0}


def test_versions(spark):
    names = spark.createDataFrame(
        [("d_20230614145952",), ("d_20230614T145953",), ("other_20240101000000",), ("d_2023",)], "name string"
    )
    assert IO.max_version(names, "d").first()[0] == "20230614T145953"
    assert IO.max_version(names, "nothing").first()[0] is None
    checks = spark.createDataFrame(
        [("20230614145952",), ("20230229000000",), ("20240229235959",), ("20230614240000",), ("2023061414595",), ("20230614T145952",), (None,)], "v string"
    )
    assert [r[0] for r in checks.select(IO.valid_version(F.col("v"))).collect()] == [True, False, True, False, False, False, False]
