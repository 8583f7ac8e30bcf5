"""US public holidays as a generated dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import flag

OBSERVED = " (Observed)"

# Fixed values: (name, month, day, first year, has an observed day).
FIXED_DAYS = (
    ("New Year's Day", 1, 1, 1871, True),
    ("Juneteenth National Independence Day", 6, 19, 2021, True),
    ("Independence Day", 7, 4, 1871, True),
    ("Veterans Day", 11, 11, 1978, True),
    ("Christmas Day", 12, 25, 1871, True),
)
# Fixed values: (name, month, weekday with Monday 0, nth in month or -1 for last, first year).
FLOATING_DAYS = (
    ("Martin Luther King Jr. Day", 1, 0, 3, 1986),
    ("Washington's Birthday", 2, 0, 3, 1971),
    ("Memorial Day", 5, 0, -1, 1971),
    ("Labor Day", 9, 0, 1, 1894),
    ("Columbus Day", 10, 0, 2, 1971),
    ("Thanksgiving", 11, 3, 4, 1871),
)


def us_holidays(spark: SparkSession, first: int = 1980, last: int = 2035) -> DataFrame:
    """(date, name) rows, with the weekday on which a weekend holiday is observed.

    Every calendar day is tested against the rules, so the table is one narrow
    projection over a day sequence.
    """
    if first < 1978:
        raise ValueError("rules are stated for 1978 and later")
    # One day beyond each end: an observed day may fall in the neighbouring year.
    span = F.explode(
        F.sequence(
            F.make_date(F.lit(first), F.lit(1), F.lit(1)),
            F.make_date(F.lit(last), F.lit(12), F.lit(31)),
            F.expr("INTERVAL 1 DAY"),
        )
    )
    days = spark.range(1).select(span.alias("date"))
    date = F.col("date")

    def is_day(d, month, day, since):
        return (F.month(d) == month) & (F.dayofmonth(d) == day) & (F.year(d) >= since)

    found = []
    for name, month, day, since, observed in FIXED_DAYS:
        found.append(F.when(is_day(date, month, day, since), F.lit(name)))
        if observed:
            next_day, day_before = F.date_add(date, 1), F.date_sub(date, 1)
            found.append(
                F.when(
                    (is_day(next_day, month, day, since) & (F.weekday(next_day) == 5))
                    | (is_day(day_before, month, day, since) & (F.weekday(day_before) == 6)),
                    F.lit(name + OBSERVED),
                )
            )
    for name, month, weekday, nth, since in FLOATING_DAYS:
        if nth > 0:
            rank = F.floor((F.dayofmonth(date) - 1) / F.lit(7)) + 1 == nth
        else:
            rank = F.month(F.date_add(date, 7)) != month
        found.append(
            F.when(
                (F.month(date) == month) & (F.weekday(date) == weekday) & rank & (F.year(date) >= since),
                F.lit(name),
            )
        )
    names = F.filter(F.array(*found), lambda n: n.isNotNull())
    return days.select("date", F.explode(names).alias("name"))


def holiday_flag(df: DataFrame, date_column: str, holidays: DataFrame, output: str = "is_holiday") -> DataFrame:
    """1 where the day is in the holiday table, else 0 (a NULL day is 0)."""
    # One row per calendar day at most, so it is always small enough to broadcast.
    listed = holidays.select(F.col("date").alias("_holiday")).distinct()
    return (
        df.join(F.broadcast(listed), F.to_date(F.col(date_column)) == F.col("_holiday"), "left")
        .withColumn(output, flag(F.col("_holiday").isNotNull()))
        .drop("_holiday")
    )
