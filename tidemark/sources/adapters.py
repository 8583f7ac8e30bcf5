"""Views of the star-schema test tables in the shape of the payment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _transactions(df: DataFrame, row_id: str, user: str, at: str, amount: str, chip: Column, mcc: Column, fraud: Column) -> DataFrame:
    return df.select(
        F.col(row_id).alias("transaction_id"),
        F.col(user).alias("User"),
        (F.col(row_id) % 3).alias("Card"),
        F.year(at).alias("Year"),
        F.month(at).alias("Month"),
        F.dayofmonth(at).alias("Day"),
        F.date_format(at, "HH:mm").alias("Time"),
        F.col(amount).cast("decimal(12,2)").alias("Amount"),
        chip.alias("Use_Chip"),
        mcc.cast("int").alias("MCC"),
        fraud.alias("Is_Fraud_"),
    )


def _channel(column: str, chip: list[str], swipe: list[str]) -> Column:
    return (
        F.when(F.col(column).isin(chip), "Chip Transaction")
        .when(F.col(column).isin(swipe), "Swipe Transaction")
        .otherwise("Online Transaction")
    )


def transactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 days of payments at minute resolution."""
    return _transactions(
        table(spark, sf_dir, "events"),
        "event_id",
        "user_id",
        "ts",
        "value",
        _channel("event_type", ["error"], ["click", "view"]),
        F.lit(5400) + F.col("event_id") % 11,
        F.get_json_object("props", "$.k").cast("int") < 5,
    )


def transactions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six and a half years of day-resolution payments, so many equal instants."""
    return _transactions(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_totalprice",
        _channel("o_orderstatus", ["F"], ["O"]),
        F.lit(5400) + F.substring("o_orderpriority", 1, 1).cast("int"),
        F.floor("o_totalprice") % 20 == 0,
    )


TRANSACTIONS = {"events": transactions_from_events, "orders": transactions_from_orders}


def users_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    cents = F.col("c_acctbal").cast("decimal(12,2)")

    def dollars(amount: Column) -> Column:
        return F.concat(F.lit("$"), amount.cast("string"))

    return table(spark, sf_dir, "customer").select(
        key.alias("User"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("Gender"),
        dollars(cents).alias("Per Capita Income - Zipcode"),
        dollars(cents * 2).alias("Yearly Income - Person"),
        dollars(cents * 3).alias("Total Debt"),
    )


def cards_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards 0 and 1 of every customer; card 2 is missing, so its payments drop out."""
    segment = F.col("c_mktsegment")
    kind = F.col("c_nationkey") % 3
    return (
        table(spark, sf_dir, "customer")
        .withColumn("CARD_INDEX", F.explode(F.array(F.lit(0), F.lit(1)).cast("array<bigint>")))
        .select(
            F.col("c_custkey").alias("User"),
            "CARD_INDEX",
            F.when(segment.isin("BUILDING", "HOUSEHOLD"), "Visa")
            .when(segment == "AUTOMOBILE", "Mastercard")
            .when(segment == "MACHINERY", "Amex")
            .otherwise("Discover")
            .alias("Card_Brand"),
            F.when(kind == 0, "Credit").when(kind == 1, "Debit").otherwise("Debit (Prepaid)").alias("Card_Type"),
            F.concat(F.lit("$"), (F.col("c_custkey") % 50 * 100).cast("string")).alias("Credit_Limit"),
            (F.col("CARD_INDEX") == 0).alias("Has_Chip"),
            (F.col("c_custkey") % 7 == 0).alias("Card_on_Dark_Web"),
        )
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, is_fraud, score) with many tied scores, from the payment events."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.when(F.get_json_object("props", "$.k").cast("int") < 5, 1).otherwise(0).alias("is_fraud"),
        (F.col("event_id") * 7919 % 1000 / F.lit(1000.0)).alias("score"),
    )


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payments scored by three stand-in models, in long form."""
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "value",
    )
    models = F.array(
        F.struct(F.lit("hashed").alias("model"), (F.col("row_id") * 7919 % 1000 / F.lit(1000.0)).alias("score")),
        F.struct(F.lit("leaky").alias("model"), (F.lit(1.0) - F.floor(F.col("k") / F.lit(10)) / F.lit(10.0)).alias("score")),
        F.struct(F.lit("spend").alias("model"), F.least(F.col("value") / F.lit(1000.0), F.lit(1.0)).alias("score")),
    )
    return base.select(
        "row_id",
        F.when(F.col("k") < 5, 1).otherwise(0).alias("is_fraud"),
        F.explode(models).alias("m"),
    ).select("row_id", "is_fraud", "m.model", "m.score", F.when(F.col("m.score") >= 0.5, 1).otherwise(0).alias("prediction"))
