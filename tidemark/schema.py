"""Table schemas and the model's feature list."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("User", T.LongType()),
        T.StructField("Card", T.LongType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Day", T.IntegerType()),
        T.StructField("Time", T.StringType()),
        T.StructField("Amount", T.StringType()),
        T.StructField("Use_Chip", T.StringType()),
        T.StructField("MCC", T.IntegerType()),
        T.StructField("Is_Fraud_", T.StringType()),
    ]
)

CARDS = T.StructType(
    [
        T.StructField("User", T.LongType()),
        T.StructField("CARD_INDEX", T.LongType()),
        T.StructField("Card_Brand", T.StringType()),
        T.StructField("Card_Type", T.StringType()),
        T.StructField("Credit_Limit", T.StringType()),
        T.StructField("Has_Chip", T.StringType()),
        T.StructField("Card_on_Dark_Web", T.StringType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("Gender", T.StringType()),
        T.StructField("Per Capita Income - Zipcode", T.StringType()),
        T.StructField("Yearly Income - Person", T.StringType()),
        T.StructField("Total Debt", T.StringType()),
    ]
)

HOLIDAYS = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("name", T.StringType())]
)

TARGET = "is_fraud"
ROW_ID = "transaction_id"
EPOCH = "datetime_unix_seconds"
FRAUD_DELAY_DAYS = 7

# The model's 80 input columns, in model order.
FEATURES = (
    "amount",
    "has_chip",
    "gender",
    "online_transaction",
    "amex",
    "discover",
    "mastercard",
    "visa",
    "credit",
    "debit",
    "debit_prepaid",
    "mcc_mean_encoding",
    "card_present_transaction",
    "fraud_rolling_mean_30_days",
    "fraud_rolling_mean_60_days",
    "fraud_rolling_mean_365_days",
    "fraud_rolling_mean_2_years",
    "fraud_online_rolling_mean_30_days",
    "fraud_online_rolling_mean_60_days",
    "fraud_online_rolling_mean_365_days",
    "fraud_online_rolling_mean_2_years",
    "fraud_card_present_rolling_mean_30_days",
    "fraud_card_present_rolling_mean_60_days",
    "fraud_card_present_rolling_mean_365_days",
    "fraud_card_present_rolling_mean_2_years",
    "fraud_rolling_30_days_relative_to_365_days",
    "fraud_rolling_30_days_relative_to_2_years",
    "fraud_rolling_60_days_relative_to_365_days",
    "fraud_rolling_60_days_relative_to_2_years",
    "fraud_online_rolling_30_days_relative_to_365_days",
    "fraud_online_rolling_30_days_relative_to_2_years",
    "fraud_online_rolling_60_days_relative_to_365_days",
    "fraud_online_rolling_60_days_relative_to_2_years",
    "fraud_card_present_rolling_30_days_relative_to_365_days",
    "fraud_card_present_rolling_30_days_relative_to_2_years",
    "fraud_card_present_rolling_60_days_relative_to_365_days",
    "fraud_card_present_rolling_60_days_relative_to_2_years",
    "fraud_online_rolling_30_days_relative_to_all_frauds",
    "fraud_card_present_rolling_30_days_relative_to_all_frauds",
    "fraud_online_rolling_60_days_relative_to_all_frauds",
    "fraud_card_present_rolling_60_days_relative_to_all_frauds",
    "fraud_online_rolling_365_days_relative_to_all_frauds",
    "fraud_card_present_rolling_365_days_relative_to_all_frauds",
    "fraud_online_rolling_2_years_relative_to_all_frauds",
    "fraud_card_present_rolling_2_years_relative_to_all_frauds",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    "is_holiday",
    "weekend",
    "is_2015_or_later",
    "mean_amount",
    "mean_amount_last_year",
    "mean_amount_last_30_days",
    "mean_amount_last_7_days",
    "mean_amount_last_2_days",
    "mean_amount_last_1_days",
    "mean_amount_last_7_days_relative_to_last_year",
    "mean_amount_last_2_days_relative_to_last_year",
    "mean_amount_last_1_days_relative_to_last_year",
    "mean_amount_last_7_days_relative_to_last_30_days",
    "mean_amount_last_2_days_relative_to_last_30_days",
    "mean_amount_last_1_days_relative_to_last_30_days",
    "transaction_count",
    "days_since_first_transaction",
    "transaction_frequency_all",
    "transaction_frequency_last_year",
    "transaction_frequency_last_30_days",
    "transaction_frequency_last_7_days",
    "transaction_frequency_last_2_days",
    "transaction_frequency_last_1_days",
    "1_days_transaction_frequency_relative_to_last_30_days",
    "1_days_transaction_frequency_relative_to_last_year",
    "2_days_transaction_frequency_relative_to_last_30_days",
    "2_days_transaction_frequency_relative_to_last_year",
    "7_days_transaction_frequency_relative_to_last_30_days",
    "7_days_transaction_frequency_relative_to_last_year",
)

# Monitored features and their distance thresholds.
MONITORED = {
    "mean_amount": 0.01,
    "transaction_frequency_all": 0.01,
    "fraud_online_rolling_60_days_relative_to_all_frauds": 0.01,
    "days_since_first_transaction": 0.01,
}
