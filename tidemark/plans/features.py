"""From raw payment tables to the model's feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.joins import attach, hot_keys
from ..operators.prefix import DAY, id_levels, range_mean, range_sums, require_exact, running_totals
from ..schema import EPOCH, FEATURES, FRAUD_DELAY_DAYS, ROW_ID, TARGET
from ..session import stage
from ..sources.holidays import holiday_flag

CHANNELS = ("swipe", "chip", "online", "card_present")
INDICATORS = {"": TARGET, **{f"{c}_": f"fraud_{c}" for c in CHANNELS}}
RATE_WINDOWS = {"2_years": 730 * DAY, "365_days": 365 * DAY, "60_days": 60 * DAY, "30_days": 30 * DAY}
USER_WINDOWS = {"1_days": 1, "2_days": 2, "7_days": 7, "30_days": 30, "year": 365}
SHORT, LONG = ("7_days", "2_days", "1_days"), ("year", "30_days")


def transaction_features(transactions: DataFrame) -> DataFrame:
    """Event time, cyclic codes, channel flags and the label of each payment."""
    hour_sin, hour_cos = S.cyclic(S.hour_of(F.col("Time")), 24)
    month_sin, month_cos = S.cyclic(F.col("Month") - 1, 12)

    def channel(*names: str) -> Column:
        return S.flag(F.col("Use_Chip").isin(*[f"{n} Transaction" for n in names]))

    return transactions.select(
        ROW_ID,
        S.event_time(F.col("Year"), F.col("Month"), F.col("Day"), F.col("Time")).alias("datetime"),
        F.col("Year").alias("year"),
        hour_sin.alias("hour_sin"),
        hour_cos.alias("hour_cos"),
        month_sin.alias("month_sin"),
        month_cos.alias("month_cos"),
        S.flag(F.col("Year") >= 2015).alias("is_2015_or_later"),
        F.col("Amount").alias("amount"),
        channel("Chip").alias("chip_transaction"),
        channel("Swipe").alias("swipe_transaction"),
        channel("Online").alias("online_transaction"),
        channel("Chip", "Swipe").alias("card_present_transaction"),
        F.col("Card").alias("card"),
        F.col("User").alias("user"),
        F.col("MCC").alias("mcc"),
        F.col("Is_Fraud_").cast("int").alias(TARGET),
    )


def user_features(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("User").alias("user"),
        F.when(F.col("Gender") == "Male", 0).otherwise(1).alias("gender"),
        S.money(F.col("Per Capita Income - Zipcode")).alias("per_capita_income_zipcode"),
        S.money(F.col("Yearly Income - Person")).alias("yearly_income_person"),
        S.money(F.col("Total Debt")).alias("total_debt"),
    )


def card_features(cards: DataFrame) -> DataFrame:
    brand, kind = F.col("Card_Brand"), F.col("Card_Type")
    return cards.select(
        F.col("User").alias("user"),
        F.col("CARD_INDEX").alias("card_index"),
        *[S.flag(brand == b).alias(b.lower()) for b in ("Amex", "Discover", "Mastercard", "Visa")],
        S.flag(kind == "Credit").alias("credit"),
        S.flag(kind == "Debit").alias("debit"),
        S.flag(kind == "Debit (Prepaid)").alias("debit_prepaid"),
        F.col("Credit_Limit").alias("credit_limit"),
        S.bool_flag(F.col("Has_Chip")).alias("has_chip"),
        S.bool_flag(F.col("Card_on_Dark_Web")).alias("card_on_dark_web"),
    )


def merge_payments(transactions: DataFrame, users: DataFrame, cards: DataFrame, holidays: DataFrame) -> DataFrame:
    """Payments with card, user and calendar columns; payments without either drop out.

    Cards and users are joined to each other first, so the large side moves once,
    on (user, card), where even a hot user splits by row.
    """
    holders = card_features(cards).join(user_features(users), "user")
    at, weekday = F.col("datetime"), F.dayofweek("datetime")
    week_sin, week_cos = S.cyclic(F.weekday(at), 7)
    rows = transaction_features(transactions)
    rows = rows.join(
        holders.withColumnsRenamed({"user": "_user", "card_index": "_card"}),
        (F.col("card") == F.col("_card")) & (F.col("user") == F.col("_user")),
    ).drop("_user", "_card")
    rows = rows.select(
        "*",
        S.epoch(at).alias(EPOCH),
        weekday.alias("day_of_week"),
        S.is_weekend(at).alias("weekend"),
        week_sin.alias("day_of_week_sin"),
        week_cos.alias("day_of_week_cos"),
        *[
            S.flag((F.col(TARGET) == 1) & (F.col(f"{c}_transaction") == 1)).alias(f"fraud_{c}")
            for c in CHANNELS
        ],
    )
    return holiday_flag(rows, "datetime", holidays).drop("card")


def delayed_mean_encoding(
    df: DataFrame, key: str = "mcc", ts: str = EPOCH, target: str = TARGET, delay: int = FRAUD_DELAY_DAYS * DAY, output: str = "mcc_mean_encoding"
) -> DataFrame:
    """Mean target of the category over all labels settled by now; 0 before the first."""
    means = range_mean(df, ts, [target], {"": None}, delay, keys=[key], names={(target, ""): output})
    return attach(df, means, [key, ts], "left", null_safe=[key]).withColumn(output, F.coalesce(output, F.lit(0.0)))


def _user_history_native(df: DataFrame, user: str, ts: str, amount: str, row_id: str, at: str, days: dict) -> DataFrame:
    """All user sums in one shuffle and one sort.

    A frame that starts at the first row is only ever added to, so each trailing sum
    is a difference of two such frames: linear in rows however long the window is.
    """
    in_order = W.partitionBy(user).orderBy(ts, row_id)
    wide = df.withColumns(
        {
            # In time order the smallest value so far is the first: no second sort.
            "_first": F.min(at).over(in_order.rowsBetween(W.unboundedPreceding, 0)),
            **{
                f"_{n}_rows": F.expr(e).over(in_order.rowsBetween(W.unboundedPreceding, -1))
                for n, e in (("sum", f"sum(`{amount}`)"), ("n", f"count(`{amount}`)"), ("all", f"count(`{row_id}`)"))
            },
        }
    )
    columns = []
    for label, shift in {"now": 1, **{k: d * DAY + 1 for k, d in days.items()}}.items():
        frame = f"OVER (PARTITION BY `{user}` ORDER BY `{ts}` RANGE BETWEEN UNBOUNDED PRECEDING AND {shift} PRECEDING)"
        columns += [
            f"coalesce(sum(`{amount}`) {frame}, 0) AS `sum_{label}`",
            f"count(`{amount}`) {frame} AS `n_{label}`",
            f"count(`{row_id}`) {frame} AS `all_{label}`",
        ]
    return wide.selectExpr("*", *columns)


def _user_history_bucketed(df: DataFrame, user: str, ts: str, amount: str, row_id: str, at: str, days: dict) -> DataFrame:
    """The same columns for users too large for one task.

    Rows without a time stand before all others, in order of id, as they do in the native windows.
    """
    measures = {
        "sum": F.col(amount),
        "n": F.when(F.col(amount).isNotNull(), 1).otherwise(0),
        "all": F.when(F.col(row_id).isNotNull(), 1).otherwise(0),
    }
    offsets = {"now": 1, **{k: d * DAY + 1 for k, d in days.items()}}
    timed, untimed = df.where(F.col(ts).isNotNull()), df.where(F.col(ts).isNull())
    seconds = range_sums(timed, ts, measures, offsets, [user])
    # One row per hot user, and their number is bounded: small enough to send everywhere.
    least = df.groupBy(user).agg(
        F.min(F.when(F.col(ts).isNotNull(), F.col(at))).alias("_first"),
        *[F.coalesce(F.sum(F.when(F.col(ts).isNull(), e)), F.lit(0)).alias(f"_{n}_untimed") for n, e in measures.items()],
    )
    steps = {f"_{n}": F.coalesce(e, F.lit(0)) for n, e in measures.items()}
    levels = id_levels(F.col(row_id))
    ranked = running_totals(timed, levels, [row_id], steps, keys=[user, ts])
    joined = attach(attach(ranked, seconds, [user, ts]), F.broadcast(least), [user])
    rows = {f"_{n}_rows": F.col(f"{n}_now") + F.col(f"_{n}_before") + F.col(f"_{n}_untimed") for n in measures}
    joined = joined.withColumns(rows).drop(*[f"_{n}_untimed" for n in measures])
    none = {f"{n}_{label}": F.lit(0) for n in measures for label in offsets}
    first = running_totals(untimed, levels, [row_id], steps, keys=[user])
    first = first.withColumns({**none, **{f"_{n}_rows": F.col(f"_{n}_before") for n in measures}, "_first": F.col(at)})
    return joined.drop(*[f"_{n}_before" for n in measures]).unionByName(first.select(*joined.drop(*[f"_{n}_before" for n in measures]).columns))


def user_windows(
    df: DataFrame,
    user: str = "user",
    ts: str = EPOCH,
    amount: str = "amount",
    row_id: str = ROW_ID,
    at: str = "datetime",
    days: dict | None = None,
    hot_rows: int = 200_000,
) -> DataFrame:
    """Per-user spend and frequency history of each payment.

    Users are normally handled by native windows.  Users with more rows than one task should
    sort (see `hot_keys`) go through bucketed prefix sums; both give the same values.
    """
    require_exact(df, [amount])
    days = dict(USER_WINDOWS if days is None else days)
    args = (user, ts, amount, row_id, at, days)
    hot = stage(hot_keys(df, user, min_rows=hot_rows), "hot-users")
    if hot.isEmpty():
        wide = _user_history_native(df, *args)
    else:
        df = stage(df, "payments")  # several steps read it
        small = _user_history_native(df.join(F.broadcast(hot), user, "left_anti"), *args)
        large = _user_history_bucketed(df.join(F.broadcast(hot), user, "left_semi"), *args)
        wide = small.unionByName(large.select(*small.columns))
    return _user_columns(wide, df.columns, at, days)


def _user_columns(wide: DataFrame, keep: Sequence[str], at: str, days: dict) -> DataFrame:
    def mean(total: str, n: str) -> str:
        return f"coalesce(try_divide(CAST({total} AS DOUBLE), CAST({n} AS DOUBLE)), 0D)"

    since = "days_since_first_transaction"

    def rate(n: str, span: str) -> str:
        return f"CASE WHEN {since} > 0 THEN CAST({n} AS DOUBLE) / CAST({span} AS DOUBLE) ELSE 0D END"

    base = {
        "mean_amount": mean("_sum_rows", "_n_rows"),
        "transaction_count": "_all_rows",
        since: f"CAST(datediff(to_date(`{at}`), to_date(_first)) AS BIGINT)",
    }
    # The running count already leaves the current payment out and one more is
    # subtracted: the definition the models were trained with.
    columns = {"transaction_frequency_all": rate("(transaction_count - 1)", since)}
    for label, d in days.items():
        columns[f"mean_amount_last_{label}"] = mean(f"(sum_now - `sum_{label}`)", f"(n_now - `n_{label}`)")
        columns[f"transaction_frequency_last_{label}"] = rate(f"(all_now - `all_{label}`)", f"least({d}, {since})")
    return _add(wide, base).selectExpr(
        *[f"`{c}`" for c in keep], *base, *[f"{e} AS `{c}`" for c, e in columns.items()]
    )


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """New columns from SQL text: one call to the JVM each, however long the formula."""
    return df.selectExpr("*", *[f"{e} AS `{c}`" for c, e in columns.items()])


def _quotient(short: str, long: str, fill: bool) -> str:
    """Ratio of two columns; an undefined one is 0, or NULL without ``fill``."""
    ratio = f"try_divide(`{short}`, `{long}`)"
    return f"coalesce({ratio}, 0D)" if fill else ratio


def user_ratios(df: DataFrame, fill: bool = True) -> DataFrame:
    """Short windows relative to long ones: 6 spend and 6 frequency columns."""
    columns = {}
    for long in LONG:
        for short in SHORT:
            columns[f"mean_amount_last_{short}_relative_to_last_{long}"] = _quotient(
                f"mean_amount_last_{short}", f"mean_amount_last_{long}", fill
            )
            columns[f"{short}_transaction_frequency_relative_to_last_{long}"] = _quotient(
                f"transaction_frequency_last_{short}", f"transaction_frequency_last_{long}", fill
            )
    return _add(df, columns)


def global_rates(df: DataFrame, ts: str = EPOCH, delay: int = FRAUD_DELAY_DAYS * DAY, fill: float | None = 0.0, channels: Sequence[str] = tuple(INDICATORS), sums=None) -> DataFrame:
    """Trailing fraud rates over all payments: one row per distinct second."""
    values = [INDICATORS[c] for c in channels]
    names = {
        (INDICATORS[c], w): f"fraud_{c}rolling_mean_{w}" for c in channels for w in RATE_WINDOWS
    }
    rates = range_mean(
        df, ts, values, RATE_WINDOWS, delay, names=names, complete=[v for v in values if v != TARGET], sums=sums
    )
    if fill is None:
        return rates
    return rates.selectExpr(ts, *[f"coalesce(`{c}`, {fill}D) AS `{c}`" for c in names.values()])


def rate_ratios(df: DataFrame, own: bool = False, fill: bool = True, channels: Sequence[str] = tuple(INDICATORS)) -> DataFrame:
    """Short rates relative to long ones.

    The long rate is that of all fraud, or with ``own`` that of the same channel.
    """
    columns = {}
    for c in channels:
        for short in ("30_days", "60_days"):
            for long in ("365_days", "2_years"):
                columns[f"fraud_{c}rolling_{short}_relative_to_{long}"] = _quotient(
                    f"fraud_{c}rolling_mean_{short}", f"fraud_{c if own else ''}rolling_mean_{long}", fill
                )
    return _add(df, columns)


def channel_shares(df: DataFrame, fill: bool = True, channels: Sequence[str] = tuple(INDICATORS)) -> DataFrame:
    """Each channel's rate relative to the rate of all fraud in the same window."""
    columns = {
        f"fraud_{c}rolling_{w}_relative_to_all_frauds": _quotient(
            f"fraud_{c}rolling_mean_{w}", f"fraud_rolling_mean_{w}", fill
        )
        for c in channels
        if c
        for w in RATE_WINDOWS
    }
    return _add(df, columns)


def fraud_rate_features(df: DataFrame, ts: str = EPOCH, delay: int = FRAUD_DELAY_DAYS * DAY, sums=None) -> DataFrame:
    """Rates, ratios and shares per distinct second; computed there, not per payment."""
    return channel_shares(rate_ratios(global_rates(df, ts, delay, sums=sums)))


def build_features(
    transactions: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    holidays: DataFrame,
    delay_days: int = FRAUD_DELAY_DAYS,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """The feature table: row id, epoch, the chosen features, target.

    The merged payments are staged once because four steps read them.  User
    features are computed in place.  Category means and global rates are put
    together per (category, second) first, so the payments move once for both.
    Only columns that a later step reads are staged.
    """
    delay = delay_days * DAY
    merged = merge_payments(transactions, users, cards, holidays)
    needed = {ROW_ID, EPOCH, "user", "mcc", "amount", "datetime", *INDICATORS.values(), *features}
    merged = stage(merged.select(*[c for c in merged.columns if c in needed]), "merged")
    rows = user_ratios(user_windows(merged))
    means = range_mean(merged, EPOCH, [TARGET], {"": None}, delay, keys=["mcc"], names={(TARGET, ""): "mcc_mean_encoding"})
    settled = attach(means, fraud_rate_features(merged, EPOCH, delay), [EPOCH])
    rows = attach(rows, settled, ["mcc", EPOCH], null_safe=["mcc"])
    rows = rows.withColumn("mcc_mean_encoding", F.coalesce("mcc_mean_encoding", F.lit(0.0)))
    return rows.select(ROW_ID, EPOCH, *[F.col(f"`{f}`") for f in features], TARGET)


def rolling_rates_unlagged(df: DataFrame, ts: str = EPOCH) -> DataFrame:
    """The same rates without label delay, NULL where undefined.

    Frames are ``[t - w, t)``: the offline variant used for exploration, whose channel
    ratios divide by the channel's own long rate.  Needs the user windows in ``df``.
    """
    rates = rate_ratios(global_rates(df, ts, delay=1, fill=None), own=True, fill=False)
    return user_ratios(attach(df, channel_shares(rates, fill=False), [ts]), fill=False)
