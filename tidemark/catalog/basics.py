"""Projections, filters, joins, scalar rules, small windows, set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.joins import attach, hot_keys
from ..operators.prefix import range_mean, running_totals
from ..operators.quantile import approximate_quantile, discrete_quantile, exact_quantiles
from ..plans import features as P
from ..sources import files as IO
from ..sources.adapters import TRANSACTIONS, cards_from_customer, table, users_from_customer
from ..sources.holidays import holiday_flag, us_holidays
from .base import DAY, HOLDERS, HOLIDAYS, TX, query, rnd, sql_rnd


def order_seconds(spark, sf, *columns):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("sec"), *columns
    )


ORDER_SECONDS = "o AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS sec FROM orders)"


@query(
    "project_except",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount, o_orderdate AS placed_at FROM orders",
)
def project_except(spark, sf):
    df = table(spark, sf, "orders").drop("o_orderpriority", "o_orderstatus")
    return df.withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "amount", "o_orderdate": "placed_at"}
    )


@query(
    "filter_year_between",
    "SELECT o_orderkey, year(o_orderdate) AS placed_year FROM orders WHERE year(o_orderdate) BETWEEN 1998 AND 2000",
)
def filter_year_between(spark, sf):
    # A range of dates reaches the scan; a condition on year(date) would not.
    placed = F.col("o_orderdate")
    df = table(spark, sf, "orders").where((placed >= F.lit("1998-01-01").cast("date")) & (placed < F.lit("2001-01-01").cast("date")))
    return df.select("o_orderkey", F.year(placed).alias("placed_year"))


@query(
    "flags_with_nulls",
    """WITH t AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 2 = 0 END AS b FROM orders)
SELECT o_orderkey, CASE WHEN s = 'F' THEN 1 ELSE 0 END AS is_f, CASE WHEN s = 'F' OR s = 'O' THEN 1 ELSE 0 END AS is_f_or_o,
  CASE WHEN s = 'F' THEN 0 ELSE 1 END AS not_f, CASE WHEN b IS TRUE THEN 1 ELSE 0 END AS b_flag, CAST(b AS INTEGER) AS b_int,
  CASE WHEN b AND s = 'F' THEN 1 ELSE 0 END AS both FROM t""",
)
def flags_with_nulls(spark, sf):
    s, b = F.col("s"), F.col("b")
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("s"),
        F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey") % 2 == 0).alias("b"),
    )
    return df.select(
        "o_orderkey",
        S.flag(s == "F").alias("is_f"),
        S.flag((s == "F") | (s == "O")).alias("is_f_or_o"),
        F.when(s == "F", 0).otherwise(1).alias("not_f"),
        S.bool_flag(b).alias("b_flag"),
        b.cast("int").alias("b_int"),
        S.flag(b & (s == "F")).alias("both"),
    )


@query(
    "guarded_rates",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, floor(l_discount * 100) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, {sql_rnd('CASE WHEN d > 0 THEN q / least(7, d) ELSE 0 END')} AS rate,
  {sql_rnd('coalesce(q / nullif(d, 0), 0)')} AS ratio FROM t""",
)
def guarded_rates(spark, sf):
    q, d = F.col("l_quantity"), F.floor(F.col("l_discount") * 100)
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rnd(F.when(d > 0, q / F.least(F.lit(7), d)).otherwise(0)).alias("rate"),
        rnd(S.safe_ratio(q, d)).alias("ratio"),
    )


@query(
    "clock_parts",
    """WITH t AS (SELECT event_id, strftime(ts, '%H:%M') AS c, ts FROM events)
SELECT event_id, CAST(substr(c, 1, 2) AS INTEGER) AS h, CAST(substr(c, 4, 2) AS INTEGER) AS mi,
  CAST(floor(epoch(date_trunc('minute', ts))) AS BIGINT) AS sec, dayofweek(ts) + 1 AS dow,
  CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
  CAST(date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(ts AS DATE)) AS BIGINT) AS days
FROM t""",
)
def clock_parts(spark, sf):
    events = table(spark, sf, "events")
    first = events.agg(F.min("ts")).scalar()
    clock = F.date_format("ts", "HH:mm")
    at = S.event_time(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), clock)
    return events.select(
        "event_id",
        S.hour_of(clock).alias("h"),
        S.minute_of(clock).alias("mi"),
        S.epoch(at).alias("sec"),
        F.dayofweek("ts").cast("bigint").alias("dow"),
        S.is_weekend(F.col("ts")).alias("weekend"),
        S.days_between(F.col("ts"), first).alias("days"),
    )


@query(
    "cyclic_codes",
    f"""SELECT o_orderkey, {sql_rnd('sin((month(o_orderdate) - 1) / 12.0 * 2 * pi())')} AS month_sin,
  {sql_rnd('cos((month(o_orderdate) - 1) / 12.0 * 2 * pi())')} AS month_cos,
  {sql_rnd('sin((dayofweek(o_orderdate) + 6) % 7 / 7.0 * 2 * pi())')} AS week_sin,
  {sql_rnd('cos((dayofweek(o_orderdate) + 6) % 7 / 7.0 * 2 * pi())')} AS week_cos FROM orders""",
)
def cyclic_codes(spark, sf):
    month, week = S.cyclic(F.month("o_orderdate") - 1, 12), S.cyclic(F.weekday("o_orderdate"), 7)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        rnd(month[0]).alias("month_sin"),
        rnd(month[1]).alias("month_cos"),
        rnd(week[0]).alias("week_sin"),
        rnd(week[1]).alias("week_cos"),
    )


@query(
    "rounding_casts",
    """SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice + 0.5) AS BIGINT) AS price,
  abs((l_orderkey - 1000) % 100) AS bucket FROM lineitem""",
)
def rounding_casts(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        S.round_to_int(F.col("l_extendedprice")).alias("price"),
        S.bucket100(F.col("l_orderkey") - 1000).alias("bucket"),
    )


@query(
    "transaction_features",
    f"""WITH {TX['events']} SELECT transaction_id, dt AS "datetime", yr AS "year", {sql_rnd('sin(hr / 24.0 * 2 * pi())')} AS hour_sin,
  {sql_rnd('cos(hr / 24.0 * 2 * pi())')} AS hour_cos, CASE WHEN use_chip LIKE 'Chip%' THEN 1 ELSE 0 END AS chip_transaction,
  CASE WHEN use_chip LIKE 'Online%' THEN 1 ELSE 0 END AS online_transaction, usr AS "user", card, mcc, amount, is_fraud FROM tx""",
)
def transaction_features(spark, sf):
    df = P.transaction_features(TRANSACTIONS["events"](spark, sf))
    return df.select(
        "transaction_id",
        "datetime",
        "year",
        rnd(F.col("hour_sin")).alias("hour_sin"),
        rnd(F.col("hour_cos")).alias("hour_cos"),
        "chip_transaction",
        "online_transaction",
        "user",
        "card",
        "mcc",
        "amount",
        "is_fraud",
    )


@query(
    "user_features",
    f"""WITH {HOLDERS} SELECT usr AS "user", CASE WHEN gender_text = 'Male' THEN 0 ELSE 1 END AS gender,
  {sql_rnd('income')} AS per_capita_income_zipcode, {sql_rnd('income * 2')} AS yearly_income_person, {sql_rnd('income * 3')} AS total_debt FROM users""",
)
def user_features(spark, sf):
    df = P.user_features(users_from_customer(spark, sf))
    money = ("per_capita_income_zipcode", "yearly_income_person", "total_debt")
    return df.select("user", "gender", *[rnd(F.col(c)).alias(c) for c in money])


@query(
    "card_features",
    f"""WITH {HOLDERS} SELECT usr AS "user", CAST(card_index AS BIGINT) AS card_index, CASE WHEN brand = 'Visa' THEN 1 ELSE 0 END AS visa,
  CASE WHEN brand = 'Amex' THEN 1 ELSE 0 END AS amex, CASE WHEN kind = 'Debit (Prepaid)' THEN 1 ELSE 0 END AS debit_prepaid,
  CASE WHEN chip THEN 1 ELSE 0 END AS has_chip, CASE WHEN dark THEN 1 ELSE 0 END AS card_on_dark_web FROM cards""",
)
def card_features(spark, sf):
    df = P.card_features(cards_from_customer(spark, sf))
    return df.select("user", "card_index", "visa", "amex", "debit_prepaid", "has_chip", "card_on_dark_web")


@query(
    "join_payments",
    f"""WITH {TX['orders']}, {HOLDERS} SELECT brand, count(*) AS payments, CAST(sum(amount) AS DOUBLE) AS spend, sum(is_fraud)::BIGINT AS frauds
FROM tx JOIN cards ON tx.card = card_index AND tx.usr = cards.usr JOIN users ON tx.usr = users.usr GROUP BY brand""",
)
def join_payments(spark, sf):
    tx = P.transaction_features(TRANSACTIONS["orders"](spark, sf)).select("user", "card", "amount", "is_fraud")
    cards = cards_from_customer(spark, sf).select(F.col("User").alias("user"), F.col("CARD_INDEX").alias("card"), F.col("Card_Brand").alias("brand"))
    users = users_from_customer(spark, sf).select(F.col("User").alias("user"))
    return (
        tx.join(cards.join(users, "user"), ["user", "card"])
        .groupBy("brand")
        .agg(
            F.count(F.lit(1)).alias("payments"),
            F.sum("amount").cast("double").alias("spend"),
            F.sum("is_fraud").alias("frauds"),
        )
    )


@query(
    "holiday_flags",
    f"""WITH {HOLIDAYS} SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_holiday FROM orders""",
)
def holiday_flags(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return holiday_flag(df, "o_orderdate", us_holidays(spark)).select("o_orderkey", "is_holiday")


@query(
    "orders_per_holiday",
    f"""WITH {HOLIDAYS} SELECT name, count(*) AS orders, count(DISTINCT date) AS days FROM orders JOIN holidays ON CAST(o_orderdate AS DATE) = date GROUP BY name""",
)
def orders_per_holiday(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return (
        days.join(us_holidays(spark), "date")
        .groupBy("name")
        .agg(F.sum("n").alias("orders"), F.countDistinct("date").alias("days"))
    )


@query("surrogate_id", "SELECT event_id, event_id + 1 AS transaction_id FROM events")
def surrogate_id(spark, sf):
    """Row numbers in file order; the events file is written in key order."""
    return IO.with_file_ordinal(table(spark, sf, "events").select("event_id"), "transaction_id", start=1)


@query(
    "before_this_row",
    f"""SELECT o_orderkey, {sql_rnd('coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0), 0)')} AS mean_amount,
  count(*) OVER w AS earlier FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def before_this_row(spark, sf):
    df = table(spark, sf, "orders")
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(W.unboundedPreceding, -1)
    cents = F.col("o_totalprice").cast("decimal(12,2)")
    mean = F.try_divide(F.sum(cents).over(w).cast("double"), F.count(F.lit(1)).over(w).cast("double"))
    return df.select(
        "o_orderkey", rnd(F.coalesce(mean, F.lit(0.0))).alias("mean_amount"), F.count(F.lit(1)).over(w).alias("earlier")
    )


@query(
    "before_this_row_bucketed",
    "SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) OVER w - CAST(l_quantity AS BIGINT) AS BIGINT) AS quantity_before FROM lineitem "
    "WINDOW w AS (ORDER BY l_orderkey * 8 + l_linenumber, CAST(l_quantity AS BIGINT), CAST(l_extendedprice AS DECIMAL(12,2)) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
)
def before_this_row_bucketed(spark, sf):
    """A running total over one table-wide order, without a one-task window."""
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )
    # The position is not unique, so quantity and price settle ties.
    levels = [F.shiftright("pos", 24), F.shiftright("pos", 10)]
    out = running_totals(df, levels, ["pos", "q", "price"], {"quantity": F.col("q")})
    return out.select("l_orderkey", "l_linenumber", "quantity_before")


@query(
    "days_since_first",
    """SELECT o_orderkey, CAST(date_diff('day', CAST(min(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE), CAST(o_orderdate AS DATE)) AS BIGINT) AS days FROM orders""",
)
def days_since_first(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    first = df.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    return attach(df, first, ["o_custkey"]).select(
        "o_orderkey", S.days_between(F.col("o_orderdate"), F.col("first")).alias("days")
    )


@query(
    "trailing_amount",
    f"""WITH {ORDER_SECONDS} SELECT o_orderkey, {sql_rnd('coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0), 0)')} AS mean_year
FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY sec RANGE BETWEEN {365 * DAY} PRECEDING AND 1 PRECEDING)""",
)
def trailing_amount(spark, sf):
    """A keyed trailing mean of exact decimals by prefix sums."""
    df = order_seconds(spark, sf, "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))
    means = range_mean(df, "sec", ["amount"], {"year": 365 * DAY}, 1, keys=["o_custkey"])
    return attach(df, means, ["o_custkey", "sec"]).select(
        "o_orderkey", rnd(F.coalesce("amount_year", F.lit(0.0))).alias("mean_year")
    )


@query(
    "target_encoding",
    f"""WITH {ORDER_SECONDS} SELECT o_orderkey, {sql_rnd('coalesce(CAST(sum(o_orderkey % 2) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0), 0)')} AS encoded
FROM o WINDOW w AS (PARTITION BY nullif(o_orderpriority, '5-LOW') ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND {30 * DAY} PRECEDING)""",
)
def target_encoding(spark, sf):
    """Delayed mean encoding with a NULL category, which counts as one."""
    df = order_seconds(
        spark, sf, F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("category"), (F.col("o_orderkey") % 2).alias("label")
    )
    out = P.delayed_mean_encoding(df, "category", "sec", "label", 30 * DAY, "encoded")
    return out.select("o_orderkey", rnd(F.col("encoded")).alias("encoded"))


@query(
    "quantile_exact",
    f"""WITH {ORDER_SECONDS} SELECT quantile_disc(sec, 0.7) AS quantile FROM o""",
)
def quantile_exact(spark, sf):
    return discrete_quantile(order_seconds(spark, sf), "sec", 70)


SKEWED = "CASE WHEN l_linenumber = 7 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice * l_extendedprice * l_extendedprice * l_discount END"
PERCENTS = (0, 1, 25, 50, 50.1, 70, 99, 100)


def quantiles_sql(value, kind):
    """NaN shown as -1, since engines compare it differently."""
    rows = [f"SELECT '{kind}' AS kind, CAST({p} AS DOUBLE) AS percent, quantile_disc({value}, {p / 100}) AS value FROM lineitem" for p in PERCENTS]
    return f"SELECT kind, percent, CASE WHEN isnan(CAST(value AS DOUBLE)) THEN -1 ELSE {sql_rnd('value', 2)} END AS value FROM ({' UNION ALL '.join(rows)})"


@query("quantiles_of_any_number", f"{quantiles_sql(SKEWED, 'skewed')} UNION ALL {quantiles_sql('CAST(l_extendedprice AS DECIMAL(18, 2))', 'decimal')}")
def quantiles_of_any_number(spark, sf):
    """Eight percentiles at once of skewed doubles with NaN and of decimals, in narrowing passes."""
    df = table(spark, sf, "lineitem")
    columns = {"skewed": F.expr(SKEWED), "decimal": F.col("l_extendedprice").cast("decimal(18, 2)")}
    out = None
    for kind, value in columns.items():
        found = exact_quantiles(df.select(value.alias("v")), "v", PERCENTS, at_end=1_000)
        shown = found.select(F.lit(kind).alias("kind"), "percent", F.when(F.isnan(F.col("value").cast("double")), F.lit(-1.0)).otherwise(rnd(F.col("value"), 2)).alias("value"))
        out = shown if out is None else out.unionByName(shown)
    return out


@query("quantile_approx")
def quantile_approx(spark, sf):
    return approximate_quantile(order_seconds(spark, sf), "sec", 70)


@query(
    "sorted_by_time",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM events",
)
def sorted_by_time(spark, sf):
    """A full sort, made checkable as each row's place in it."""
    df = table(spark, sf, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    # Day, second, microsecond, then ranges of ids: a crowded instant is cut as well.
    levels = [F.floor(F.col("us") / F.lit(DAY * 1_000_000)), F.floor(F.col("us") / F.lit(1_000_000)), F.col("us"), F.shiftright("event_id", 20)]
    out = running_totals(df.withColumn("one", F.lit(1)), levels, ["us", "event_id"], {"n": F.col("one")})
    return out.select("event_id", (F.col("n_before") + 1).alias("place"))


@query(
    "first_records",
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10",
)
def first_records(spark, sf):
    return IO.preview(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice", "o_orderstatus", "o_orderdate"])


@query(
    "union_year_slices",
    "SELECT year(o_orderdate) AS y, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1",
)
def union_year_slices(spark, sf):
    """Disjoint year slices put together again hold every row once."""
    df = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    slices = [df.where("y <= 1996"), df.where(F.col("y").between(1997, 1999)), df.where("y >= 2000")]
    whole = slices[0].unionByName(slices[1]).unionByName(slices[2])
    return whole.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "hot_users",
    """WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT user_id FROM c WHERE n > greatest(70, (SELECT sum(n) FROM c) / 100000.0)""",
)
def hot_users(spark, sf):
    return hot_keys(table(spark, sf, "events"), "user_id", min_rows=70)


VERSION_NAMES = """names AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'card_frauds_' || strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 86400 AS VARCHAR), 6, '0')
  WHEN 1 THEN 'card_frauds_' || strftime(o_orderdate, '%Y%m%d') || 'T' || lpad(CAST(o_orderkey % 86400 AS VARCHAR), 6, '0')
  ELSE 'other_' || strftime(o_orderdate, '%Y%m%d%H%M%S') END AS name, o_orderkey FROM orders)"""


def version_names(spark, sf):
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    clock = F.lpad((key % 86400).cast("string"), 6, "0")
    return table(spark, sf, "orders").select(
        key,
        F.when(key % 3 == 0, F.concat(F.lit("card_frauds_"), day, clock))
        .when(key % 3 == 1, F.concat(F.lit("card_frauds_"), day, F.lit("T"), clock))
        .otherwise(F.concat(F.lit("other_"), F.date_format("o_orderdate", "yyyyMMddHHmmss")))
        .alias("name"),
    )


@query(
    "latest_version",
    rf"""WITH {VERSION_NAMES}, v AS (SELECT nullif(regexp_extract(name, 'card_frauds_(\d{{8}}T?\d{{6}})', 1), '') AS version FROM names)
SELECT arg_max(version, replace(version, 'T', '')) AS version FROM v""",
)
def latest_version(spark, sf):
    return IO.max_version(version_names(spark, sf), "card_frauds")


@query(
    "valid_versions",
    rf"""WITH {VERSION_NAMES}, v AS (SELECT o_orderkey, regexp_extract(name, '_([0-9T]+)$', 1) AS version FROM names)
SELECT o_orderkey, version, regexp_full_match(version, '[0-9]{{14}}') AND try_strptime(version, '%Y%m%d%H%M%S') IS NOT NULL AS valid FROM v""",
)
def valid_versions(spark, sf):
    """Order keys stand in for the clock, so most hours, minutes or seconds are out of range."""
    df = version_names(spark, sf).select("o_orderkey", F.regexp_extract("name", "_([0-9T]+)$", 1).alias("version"))
    return df.withColumn("valid", IO.valid_version(F.col("version")))
