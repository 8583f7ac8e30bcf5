"""Registry, rounding shared by both engines, and the adapter views as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rnd(value: Column, digits: int = 6) -> Column:
    """Rounding by the same three IEEE operations in both engines."""
    scale = float(10**digits)
    return F.floor(value.cast("double") * scale + 0.5) / F.lit(scale)


def sql_rnd(value: str, digits: int = 6) -> str:
    scale = f"{float(10 ** digits):.1f}"
    return f"floor(CAST({value} AS DOUBLE) * {scale} + 0.5) / {scale}"


def rounded(df: DataFrame, keep: list[str] | tuple[str, ...]) -> DataFrame:
    """Every column outside ``keep`` rounded."""
    text = "floor(CAST(`{c}` AS DOUBLE) * 1000000D + 0.5D) / 1000000D AS `{c}`"
    return df.selectExpr(*keep, *[text.format(c=c) for c in df.columns if c not in keep])


TX = {
    "orders": """
tx AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS usr, o_orderkey % 3 AS card,
    o_orderdate AS dt, year(o_orderdate) AS yr, month(o_orderdate) AS mon,
    CAST(strftime(o_orderdate, '%H') AS INTEGER) AS hr, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'Chip Transaction' WHEN 'O' THEN 'Swipe Transaction' ELSE 'Online Transaction' END AS use_chip,
    5400 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS mcc,
    CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 20 = 0 THEN 1 ELSE 0 END AS is_fraud
  FROM orders)""",
    "events": """
tx AS (
  SELECT event_id AS transaction_id, user_id AS usr, event_id % 3 AS card,
    date_trunc('minute', ts) AS dt, year(ts) AS yr, month(ts) AS mon,
    CAST(strftime(ts, '%H') AS INTEGER) AS hr, CAST(value AS DECIMAL(12,2)) AS amount,
    CASE WHEN event_type = 'error' THEN 'Chip Transaction' WHEN event_type IN ('click', 'view') THEN 'Swipe Transaction' ELSE 'Online Transaction' END AS use_chip,
    CAST(5400 + event_id % 11 AS INTEGER) AS mcc,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 5 THEN 1 ELSE 0 END AS is_fraud
  FROM events)""",
}

HOLIDAYS = """
days AS (SELECT CAST(d AS DATE) AS d FROM generate_series(TIMESTAMP '1980-01-01', TIMESTAMP '2035-12-31', INTERVAL 1 DAY) AS g(d)),
fixed AS (SELECT * FROM (VALUES ('New Year''s Day', 1, 1, 1), ('Juneteenth National Independence Day', 6, 19, 2021),
  ('Independence Day', 7, 4, 1), ('Veterans Day', 11, 11, 1), ('Christmas Day', 12, 25, 1)) AS f(name, m, dd, since)),
holidays AS (
  SELECT d AS date, name FROM days JOIN fixed ON month(d) = m AND day(d) = dd AND year(d) >= since
  UNION ALL
  SELECT days.d, name || ' (Observed)' FROM days JOIN fixed
    ON (month(days.d + 1) = m AND day(days.d + 1) = dd AND year(days.d + 1) >= since AND dayofweek(days.d + 1) = 6)
    OR (month(days.d - 1) = m AND day(days.d - 1) = dd AND year(days.d - 1) >= since AND dayofweek(days.d - 1) = 0)
  UNION ALL
  SELECT d, CASE
    WHEN month(d) = 1 AND dayofweek(d) = 1 AND day(d) BETWEEN 15 AND 21 AND year(d) >= 1986 THEN 'Martin Luther King Jr. Day'
    WHEN month(d) = 2 AND dayofweek(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Washington''s Birthday'
    WHEN month(d) = 5 AND dayofweek(d) = 1 AND day(d) >= 25 THEN 'Memorial Day'
    WHEN month(d) = 9 AND dayofweek(d) = 1 AND day(d) <= 7 THEN 'Labor Day'
    WHEN month(d) = 10 AND dayofweek(d) = 1 AND day(d) BETWEEN 8 AND 14 THEN 'Columbus Day'
    WHEN month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving' END AS n
  FROM days WHERE n IS NOT NULL)"""

HOLDERS = """
users AS (
  SELECT c_custkey AS usr, CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender_text,
    CAST(c_acctbal AS DECIMAL(12,2)) AS income FROM customer),
cards AS (
  SELECT c_custkey AS usr, i AS card_index,
    CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Visa' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Mastercard'
      WHEN c_mktsegment = 'MACHINERY' THEN 'Amex' ELSE 'Discover' END AS brand,
    CASE c_nationkey % 3 WHEN 0 THEN 'Credit' WHEN 1 THEN 'Debit' ELSE 'Debit (Prepaid)' END AS kind,
    i = 0 AS chip, c_custkey % 7 = 0 AS dark
  FROM customer CROSS JOIN (VALUES (0), (1)) AS v(i))"""

MERGED = """
merged AS (
  SELECT transaction_id, dt, yr, CAST(floor(epoch(dt)) AS BIGINT) AS sec, tx.usr, mcc, amount, is_fraud,
    sin(hr / 24.0 * 2 * pi()) AS hour_sin, cos(hr / 24.0 * 2 * pi()) AS hour_cos,
    sin((mon - 1) / 12.0 * 2 * pi()) AS month_sin, cos((mon - 1) / 12.0 * 2 * pi()) AS month_cos,
    dayofweek(dt) + 1 AS day_of_week,
    CASE WHEN dayofweek(dt) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
    CASE WHEN CAST(dt AS DATE) IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_holiday,
    sin((dayofweek(dt) + 6) % 7 / 7.0 * 2 * pi()) AS day_of_week_sin,
    cos((dayofweek(dt) + 6) % 7 / 7.0 * 2 * pi()) AS day_of_week_cos,
    CASE WHEN yr >= 2015 THEN 1 ELSE 0 END AS is_2015_or_later,
    CASE WHEN use_chip = 'Swipe Transaction' THEN 1 ELSE 0 END AS swipe_transaction,
    CASE WHEN use_chip = 'Chip Transaction' THEN 1 ELSE 0 END AS chip_transaction,
    CASE WHEN use_chip = 'Online Transaction' THEN 1 ELSE 0 END AS online_transaction,
    CASE WHEN use_chip IN ('Chip Transaction', 'Swipe Transaction') THEN 1 ELSE 0 END AS card_present_transaction,
    is_fraud * swipe_transaction AS fraud_swipe, is_fraud * chip_transaction AS fraud_chip,
    is_fraud * online_transaction AS fraud_online, is_fraud * card_present_transaction AS fraud_card_present,
    CASE WHEN gender_text = 'Male' THEN 0 ELSE 1 END AS gender,
    CASE WHEN brand = 'Amex' THEN 1 ELSE 0 END AS amex, CASE WHEN brand = 'Discover' THEN 1 ELSE 0 END AS discover,
    CASE WHEN brand = 'Mastercard' THEN 1 ELSE 0 END AS mastercard, CASE WHEN brand = 'Visa' THEN 1 ELSE 0 END AS visa,
    CASE WHEN kind = 'Credit' THEN 1 ELSE 0 END AS credit, CASE WHEN kind = 'Debit' THEN 1 ELSE 0 END AS debit,
    CASE WHEN kind = 'Debit (Prepaid)' THEN 1 ELSE 0 END AS debit_prepaid,
    CASE WHEN chip THEN 1 ELSE 0 END AS has_chip, CASE WHEN dark THEN 1 ELSE 0 END AS card_on_dark_web,
    income AS per_capita_income_zipcode, income * 2 AS yearly_income_person, income * 3 AS total_debt
  FROM tx JOIN cards ON tx.card = cards.card_index AND tx.usr = cards.usr JOIN users ON tx.usr = users.usr)"""


def merged_sql(source: str) -> str:
    return f"WITH {TX[source]},\n{HOLIDAYS},\n{HOLDERS},\n{MERGED}"


DAY = 86_400
DELAY = 7 * DAY
SQL_WINDOWS = {"2_years": 730, "365_days": 365, "60_days": 60, "30_days": 30}
SQL_USER_WINDOWS = {"1_days": 1, "2_days": 2, "7_days": 7, "30_days": 30, "year": 365}
SQL_INDICATORS = {
    "": "is_fraud",
    "swipe_": "fraud_swipe",
    "chip_": "fraud_chip",
    "online_": "fraud_online",
    "card_present_": "fraud_card_present",
}


def sql_ratio(a: str, b: str) -> str:
    return f"coalesce({a} / nullif({b}, 0), 0)"


def history_sql(source: str) -> str:
    """User history, per-category encoding and global rates with plain window functions."""
    amount_mean = "coalesce(CAST(sum(amount) OVER {w} AS DOUBLE) / nullif(count(amount) OVER {w}, 0), 0)"
    user_columns, windows = [], []
    for label, days in SQL_USER_WINDOWS.items():
        windows.append(
            f"u_{label} AS (PARTITION BY usr ORDER BY sec RANGE BETWEEN {days * DAY} PRECEDING AND 1 PRECEDING)"
        )
        user_columns.append(f"{amount_mean.format(w='u_' + label)} AS mean_amount_last_{label}")
        user_columns.append(
            f"CASE WHEN since > 0 THEN CAST(count(*) OVER u_{label} AS DOUBLE) / least({days}, since) ELSE 0 END"
            f" AS transaction_frequency_last_{label}"
        )
    rate_columns = []
    for label, days in SQL_WINDOWS.items():
        windows.append(f"g_{label} AS (ORDER BY sec RANGE BETWEEN {days * DAY} PRECEDING AND {DELAY} PRECEDING)")
        for channel, column in SQL_INDICATORS.items():
            rate_columns.append(
                f"coalesce(CAST(sum({column}) OVER g_{label} AS DOUBLE) / nullif(count({column}) OVER g_{label}, 0), 0)"
                f" AS fraud_{channel}rolling_mean_{label}"
            )
    windows.append(
        f"m_all AS (PARTITION BY mcc ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND {DELAY} PRECEDING)"
    )
    ratios = []
    for long in ("year", "30_days"):
        for short in ("7_days", "2_days", "1_days"):
            ratios.append(
                sql_ratio(f"mean_amount_last_{short}", f"mean_amount_last_{long}")
                + f" AS mean_amount_last_{short}_relative_to_last_{long}"
            )
            ratios.append(
                sql_ratio(f"transaction_frequency_last_{short}", f"transaction_frequency_last_{long}")
                + f' AS "{short}_transaction_frequency_relative_to_last_{long}"'
            )
    for channel in SQL_INDICATORS:
        for short in ("30_days", "60_days"):
            for long in ("365_days", "2_years"):
                ratios.append(
                    sql_ratio(f"fraud_{channel}rolling_mean_{short}", f"fraud_rolling_mean_{long}")
                    + f" AS fraud_{channel}rolling_{short}_relative_to_{long}"
                )
        if channel:
            for label in SQL_WINDOWS:
                ratios.append(
                    sql_ratio(f"fraud_{channel}rolling_mean_{label}", f"fraud_rolling_mean_{label}")
                    + f" AS fraud_{channel}rolling_{label}_relative_to_all_frauds"
                )
    joined = ",\n    "
    return f"""{merged_sql(source)},
hist AS (
  SELECT *, coalesce(CAST(sum(amount) OVER r AS DOUBLE) / nullif(count(amount) OVER r, 0), 0) AS mean_amount,
    count(*) OVER r AS transaction_count,
    date_diff('day', CAST(min(dt) OVER (PARTITION BY usr) AS DATE), CAST(dt AS DATE)) AS since
  FROM merged WINDOW r AS (PARTITION BY usr ORDER BY sec, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
wide AS (
  SELECT *, since AS days_since_first_transaction,
    CASE WHEN since > 0 THEN CAST(transaction_count - 1 AS DOUBLE) / since ELSE 0 END AS transaction_frequency_all,
    coalesce(CAST(sum(is_fraud) OVER m_all AS DOUBLE) / nullif(count(is_fraud) OVER m_all, 0), 0) AS mcc_mean_encoding,
    {joined.join(user_columns + rate_columns)}
  FROM hist WINDOW {joined.join(windows)}),
feat AS (SELECT *, sec AS datetime_unix_seconds, {joined.join(ratios)} FROM wide)"""
