"""Feature stages and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.bands import halo_banded_window
from ..operators.joins import attach
from ..operators.prefix import DAY, range_mean
from ..plans import features as P
from ..plans.split import assign_split
from ..schema import EPOCH, FEATURES, ROW_ID, TARGET
from ..sources.adapters import TRANSACTIONS, cards_from_customer, table, users_from_customer
from ..sources.holidays import us_holidays
from .base import (
    DELAY,
    SQL_INDICATORS,
    SQL_WINDOWS,
    history_sql,
    merged_sql,
    query,
    rnd,
    rounded,
    sql_rnd,
)


def inputs(spark, sf, source):
    return (
        TRANSACTIONS[source](spark, sf),
        users_from_customer(spark, sf),
        cards_from_customer(spark, sf),
        us_holidays(spark),
    )


def merged(spark, sf, source):
    return P.merge_payments(*inputs(spark, sf, source))


MERGED_FLAGS = (
    "day_of_week weekend is_holiday is_2015_or_later swipe_transaction chip_transaction online_transaction "
    "card_present_transaction fraud_chip fraud_swipe fraud_online fraud_card_present gender amex discover mastercard "
    "visa credit debit debit_prepaid has_chip card_on_dark_web is_fraud"
).split()
MERGED_NUMBERS = (
    "hour_sin hour_cos month_sin month_cos day_of_week_sin day_of_week_cos amount per_capita_income_zipcode "
    "yearly_income_person total_debt"
).split()
HISTORY = [f for f in FEATURES if "amount_last" in f or "frequency" in f or f == "mean_amount"]
RATES = [f"fraud_{c}rolling_mean_{w}" for c in SQL_INDICATORS for w in SQL_WINDOWS]
RATIOS = [
    f"fraud_{c}rolling_{s}_relative_to_{l}" for c in SQL_INDICATORS for s in ("30_days", "60_days") for l in ("365_days", "2_years")
]
SHARES = [f"fraud_{c}rolling_{w}_relative_to_all_frauds" for c in SQL_INDICATORS if c for w in SQL_WINDOWS]
INTEGERS = ("transaction_count", "days_since_first_transaction")


def sql_numbers(columns) -> str:
    return ", ".join(f'{sql_rnd(chr(34) + c + chr(34))} AS "{c}"' for c in columns)


for source in ("events", "orders"):

    @query(
        f"merged_{source}",
        f"""{merged_sql(source)}
SELECT transaction_id, sec AS datetime_unix_seconds, yr AS "year", usr AS "user", mcc,
  {', '.join(f'CAST({c} AS INTEGER) AS {c}' for c in MERGED_FLAGS)}, {sql_numbers(MERGED_NUMBERS)} FROM merged""",
    )
    def merged_query(spark, sf, source=source):
        df = merged(spark, sf, source)
        return df.select(
            ROW_ID,
            EPOCH,
            "year",
            "user",
            "mcc",
            *[F.col(c).cast("int").alias(c) for c in MERGED_FLAGS],
            *[rnd(F.col(c)).alias(c) for c in MERGED_NUMBERS],
        )

    @query(
        f"mcc_encoding_{source}",
        f"""{history_sql(source)} SELECT transaction_id, {sql_numbers(['mcc_mean_encoding'])} FROM feat""",
    )
    def mcc_encoding(spark, sf, source=source):
        df = P.delayed_mean_encoding(merged(spark, sf, source).select(ROW_ID, EPOCH, "mcc", TARGET))
        return df.select(ROW_ID, rnd(F.col("mcc_mean_encoding")).alias("mcc_mean_encoding"))

    @query(
        f"user_history_{source}",
        f"""{history_sql(source)} SELECT transaction_id, CAST(transaction_count AS BIGINT) AS transaction_count,
  CAST(since AS BIGINT) AS days_since_first_transaction, {sql_numbers(HISTORY)} FROM feat""",
    )
    def user_history(spark, sf, source=source):
        df = P.user_ratios(P.user_windows(merged(spark, sf, source)))
        return rounded(df.select(ROW_ID, *INTEGERS, *[F.col(f"`{c}`") for c in HISTORY]), (ROW_ID, *INTEGERS))

    @query(
        f"user_history_bucketed_{source}",
        f"""{history_sql(source)} SELECT transaction_id, CAST(transaction_count AS BIGINT) AS transaction_count,
  CAST(since AS BIGINT) AS days_since_first_transaction, {sql_numbers(HISTORY)} FROM feat""",
    )
    def user_history_bucketed(spark, sf, source=source):
        """A low bar for "hot", so most users take the path of the largest ones."""
        df = P.user_ratios(P.user_windows(merged(spark, sf, source), hot_rows=5))
        return rounded(df.select(ROW_ID, *INTEGERS, *[F.col(f"`{c}`") for c in HISTORY]), (ROW_ID, *INTEGERS))

    @query(
        f"features_{source}",
        f"""{history_sql(source)} SELECT transaction_id, datetime_unix_seconds, is_fraud, {sql_numbers(FEATURES)} FROM feat""",
    )
    def features(spark, sf, source=source):
        return rounded(P.build_features(*inputs(spark, sf, source)), (ROW_ID, EPOCH, TARGET))

    @query(
        f"temporal_split_{source}",
        f"""{merged_sql(source)}, cut AS (SELECT quantile_disc(sec, 0.7) AS q FROM merged)
SELECT transaction_id, CASE WHEN sec < q THEN 'training' WHEN abs(transaction_id % 100) < 50 THEN 'validation' ELSE 'testing' END AS split
FROM merged CROSS JOIN cut""",
    )
    def temporal_split_query(spark, sf, source=source):
        return assign_split(merged(spark, sf, source).select(ROW_ID, EPOCH)).select(ROW_ID, "split")


@query(
    "global_rates",
    f"{history_sql('orders')} SELECT DISTINCT datetime_unix_seconds, {sql_numbers(RATES)} FROM feat",
)
def global_rates(spark, sf):
    return rounded(P.global_rates(merged(spark, sf, "orders")), (EPOCH,))


@query(
    "rate_ratios",
    f"{history_sql('orders')} SELECT DISTINCT datetime_unix_seconds, {sql_numbers(RATIOS)} FROM feat",
)
def rate_ratios(spark, sf):
    df = P.rate_ratios(P.global_rates(merged(spark, sf, "orders")))
    return rounded(df.select(EPOCH, *RATIOS), (EPOCH,))


@query(
    "channel_shares",
    f"{history_sql('orders')} SELECT DISTINCT datetime_unix_seconds, {sql_numbers(SHARES)} FROM feat",
)
def channel_shares(spark, sf):
    df = P.channel_shares(P.global_rates(merged(spark, sf, "orders")))
    return rounded(df.select(EPOCH, *SHARES), (EPOCH,))


@query(
    "year_bands",
    f"""{history_sql('orders')} SELECT transaction_id, {sql_numbers(['fraud_rolling_mean_2_years', 'fraud_online_rolling_mean_365_days'])} FROM feat""",
)
def year_bands(spark, sf):
    """Rates from overlapping time bands; equals the one global window."""
    df = merged(spark, sf, "orders").select(ROW_ID, EPOCH, TARGET, "fraud_online")
    out = halo_banded_window(
        df,
        EPOCH,
        {
            "fraud_rolling_mean_2_years": (TARGET, 730 * DAY),
            "fraud_online_rolling_mean_365_days": ("fraud_online", 365 * DAY),
        },
        DELAY,
        band=365 * DAY,
    )
    return rounded(out.select(ROW_ID, "fraud_rolling_mean_2_years", "fraud_online_rolling_mean_365_days"), (ROW_ID,))


def _unlagged_sql() -> str:
    windows, rates, ratios = [], [], []
    for label, days in SQL_WINDOWS.items():
        windows.append(f"g_{label} AS (ORDER BY sec RANGE BETWEEN {days * DAY} PRECEDING AND 1 PRECEDING)")
        for c, column in SQL_INDICATORS.items():
            rates.append(
                f"CAST(sum({column}) OVER g_{label} AS DOUBLE) / nullif(count({column}) OVER g_{label}, 0) AS fraud_{c}rolling_mean_{label}"
            )
    for c in SQL_INDICATORS:
        for s in ("30_days", "60_days"):
            for l in ("365_days", "2_years"):
                ratios.append(
                    f"fraud_{c}rolling_mean_{s} / nullif(fraud_{c}rolling_mean_{l}, 0) AS fraud_{c}rolling_{s}_relative_to_{l}"
                )
        if c:
            for label in SQL_WINDOWS:
                ratios.append(
                    f"fraud_{c}rolling_mean_{label} / nullif(fraud_rolling_mean_{label}, 0) AS fraud_{c}rolling_{label}_relative_to_all_frauds"
                )
    return f"""{merged_sql('orders')},
w AS (SELECT transaction_id, {', '.join(rates)} FROM merged WINDOW {', '.join(windows)}),
f AS (SELECT *, {', '.join(ratios)} FROM w)
SELECT transaction_id, {sql_numbers(RATES + RATIOS + SHARES)} FROM f"""


@query("rolling_unlagged", _unlagged_sql())
def rolling_unlagged(spark, sf):
    df = P.rolling_rates_unlagged(P.user_windows(merged(spark, sf, "orders")))
    return rounded(df.select(ROW_ID, *RATES, *RATIOS, *SHARES), (ROW_ID,))


USER_RATIOS = [c for c in HISTORY if "relative" in c]


def _user_ratio_sql(column: str) -> str:
    short, long = column.split("_relative_to_")
    if column[0].isdigit():
        short = "transaction_frequency_last_" + short.removesuffix("_transaction_frequency")
        long = f"transaction_frequency_{long}"
    else:
        long = f"mean_amount_{long}"
    return f'{sql_rnd(f"{short} / nullif({long}, 0)")} AS "{column}"'


@query(
    "user_ratios_unlagged",
    f"{history_sql('orders')} SELECT transaction_id, {', '.join(map(_user_ratio_sql, USER_RATIOS))} FROM wide",
)
def user_ratios_unlagged(spark, sf):
    """Spend and frequency ratios that stay NULL where the long window is empty."""
    df = P.user_ratios(P.user_windows(merged(spark, sf, "orders")), fill=False)
    return rounded(df.select(ROW_ID, *[F.col(f"`{c}`") for c in USER_RATIOS]), (ROW_ID,))


@query(
    "trailing_event_mean",
    f"""WITH e AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(value AS DECIMAL(12,2)) AS v FROM events)
SELECT event_id, {sql_rnd('coalesce(CAST(sum(v) OVER w AS DOUBLE) / nullif(count(v) OVER w, 0), 0)')} AS mean_value FROM e
WINDOW w AS (ORDER BY sec RANGE BETWEEN {7 * DAY} PRECEDING AND {DAY} PRECEDING)""",
)
def trailing_event_mean(spark, sf):
    """One global trailing mean of a decimal value at second resolution."""
    e = table(spark, sf, "events").select(
        "event_id",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("sec"),
        F.col("value").cast("decimal(12,2)").alias("v"),
    )
    means = range_mean(e, "sec", ["v"], {"w": 7 * DAY}, DAY)
    return attach(e, means, ["sec"]).select(
        "event_id", rnd(F.coalesce("v_w", F.lit(0.0))).alias("mean_value")
    )


UNTIMED = """
rows_ AS (SELECT transaction_id, usr, amount, CASE WHEN transaction_id % 7 > 0 THEN sec END AS sec FROM merged),
timed AS (SELECT transaction_id, coalesce(CAST(sum(amount) OVER w AS DOUBLE) / nullif(count(amount) OVER w, 0), 0) AS m FROM rows_ WHERE sec IS NOT NULL
  WINDOW w AS (PARTITION BY usr ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING))"""
for name, options in (("user_history_untimed", {}), ("user_history_untimed_bucketed", {"hot_rows": 5})):

    @query(
        name,
        f"""{merged_sql('orders')},{UNTIMED}
SELECT transaction_id, count(*) OVER r AS transaction_count, {sql_rnd('coalesce(CAST(sum(amount) OVER r AS DOUBLE) / nullif(count(amount) OVER r, 0), 0)')} AS mean_amount,
  {sql_rnd('coalesce(m, 0)')} AS mean_amount_last_30_days
FROM rows_ LEFT JOIN timed USING (transaction_id)
WINDOW r AS (PARTITION BY usr ORDER BY sec NULLS FIRST, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    )
    def user_history_untimed(spark, sf, options=options):
        """Every seventh payment has lost its time; large and small users treat it alike."""
        df = merged(spark, sf, "orders").select(ROW_ID, EPOCH, "user", "amount", "datetime")
        gone = F.col(ROW_ID) % 7 == 0
        df = df.withColumns({c: F.when(~gone, F.col(c)) for c in (EPOCH, "datetime")})
        out = P.user_windows(df, **options).select(ROW_ID, "transaction_count", "mean_amount", "mean_amount_last_30_days")
        return rounded(out, (ROW_ID, "transaction_count"))
