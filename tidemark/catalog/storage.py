"""Round trips through every source and sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import tables as B
from ..plans import training as M
from ..schema import FEATURES, ROW_ID, TARGET
from ..session import stage_path
from ..sources import files as IO
from ..sources.adapters import TRANSACTIONS, cards_from_customer, table, users_from_customer
from ..sources.holidays import us_holidays
from .base import HOLDERS, HOLIDAYS, TX, merged_sql, query, rnd, sql_rnd
from .history import inputs
from .modelling import feature_splits, split_sql


def dollars(column):
    return F.concat(F.lit("$"), F.col(column).cast("string")).alias(column)


def yes_no(column):
    return F.when(F.col(column), "Yes").otherwise("No").alias(column)


def csv(df, path):
    df.write.option("header", True).csv(path)
    return path


def raw_names(df, *more):
    """Headers as raw files write them, the columns in reverse order, further columns in between."""
    names = {"Is_Fraud_": "Is Fraud?", **{c: c.replace("_", " ") for c in df.columns if c != "Is_Fraud_"}}
    columns = [F.col(f"`{c}`").alias(names[c]) for c in reversed(df.columns)]
    return df.select(columns[0], *[F.lit(12345).alias(c) for c in more], *columns[1:])


def transactions_csv(spark, sf, source="events"):
    """The payments as the raw file would hold them, in id order: further columns, another order, names with blanks."""
    df = TRANSACTIONS[source](spark, sf).orderBy("transaction_id")
    columns = ["User", "Card", "Year", "Month", "Day", "Time", dollars("Amount"), "Use_Chip", "MCC", yes_no("Is_Fraud_")]
    wide = raw_names(df.select(*columns), "Merchant Name", "Merchant City", "Zip", "Errors?")
    return csv(wide, stage_path(spark, "transactions-csv"))


def cards_csv_file(spark, sf):
    cards = cards_from_customer(spark, sf)
    columns = ["User", "CARD_INDEX", "Card_Brand", "Card_Type", "Credit_Limit", yes_no("Has_Chip"), yes_no("Card_on_Dark_Web")]
    return csv(raw_names(cards.select(*columns), "Card Number", "Expires"), stage_path(spark, "cards-csv"))


def users_csv_file(spark, sf):
    users = users_from_customer(spark, sf).orderBy("User").drop("User")
    return csv(raw_names(users, "Person", "Current Age"), stage_path(spark, "users-csv"))


@query(
    "transactions_csv",
    f"""WITH {TX['events']} SELECT transaction_id + 1 AS transaction_id, usr AS "User", card AS "Card", strftime(dt, '%H:%M') AS "Time",
  {sql_rnd('amount')} AS "Amount", use_chip AS "Use_Chip", mcc AS "MCC", is_fraud = 1 AS "Is_Fraud_" FROM tx""",
)
def transactions_csv_scan(spark, sf):
    df = IO.read_transactions(spark, transactions_csv(spark, sf))
    return df.select(ROW_ID, "User", "Card", "Time", rnd(F.col("Amount")).alias("Amount"), "Use_Chip", "MCC", "Is_Fraud_")


@query(
    "users_csv_ordinal",
    f"""WITH {HOLDERS} SELECT usr AS "User", gender_text AS "Gender" FROM users""",
)
def users_csv(spark, sf):
    """The user key exists only as the row's place in the file."""
    return IO.read_users(spark, users_csv_file(spark, sf)).select("User", "Gender")


@query(
    "cards_csv",
    f"""WITH {HOLDERS} SELECT usr AS "User", CAST(card_index AS BIGINT) AS "CARD_INDEX", brand AS "Card_Brand", kind AS "Card_Type", chip AS "Has_Chip", dark AS "Card_on_Dark_Web" FROM cards""",
)
def cards_csv(spark, sf):
    return IO.read_cards(spark, cards_csv_file(spark, sf)).drop("Credit_Limit")


@query(
    "ingest_report",
    f"""WITH {HOLIDAYS} SELECT 'holidays' AS table_name, count(*) AS "rows", 2 AS "columns" FROM holidays
UNION ALL SELECT 'transactions', count(*), 11 FROM events UNION ALL SELECT 'users', count(*), 5 FROM customer UNION ALL SELECT 'cards', 2 * count(*), 7 FROM customer""",
)
def ingest_report(spark, sf):
    root = stage_path(spark, "datasets")
    files = transactions_csv(spark, sf), users_csv_file(spark, sf), cards_csv_file(spark, sf)
    return IO.ingest(spark, root, "card_frauds_20240101000000", *files)


@query("load_jsonl", "SELECT event_id, user_id, event_type FROM events")
def load_jsonl(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    path = stage_path(spark, "events-jsonl")
    df.write.json(path)
    return IO.load_files(spark, path, stage_path(spark, "loaded"), "jsonl", df.schema)


@query("load_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def load_parquet(spark, sf):
    out = IO.load_files(spark, f"{sf}/supplier.parquet", stage_path(spark, "loaded"), "parquet")
    return out.select("s_suppkey", "s_name", "s_acctbal")


@query("load_prediction_shards", "SELECT event_id, value FROM events WHERE event_type <> 'error'")
def load_prediction_shards(spark, sf):
    """Two result shards are read; the error shard beside them is not."""
    events = table(spark, sf, "events")
    columns = ("event_id", "value")
    folder = stage_path(spark, "batch")
    shards = {"errors-0": ["error"], "results-1": ["click", "view"], "results-2": ["purchase", "signup"]}
    for name, kept in shards.items():
        events.where(F.col("event_type").isin(kept)).select(*columns).write.json(f"{folder}/predictions.{name}")
    schema = events.select(*columns).schema
    return IO.load_files(spark, folder, stage_path(spark, "loaded"), "jsonl", schema, predictions=True)


@query("export_skip_existing", "SELECT p_partkey, p_size FROM part")
def export_skip_existing(spark, sf):
    """The second export finds its target and leaves it alone."""
    df = table(spark, sf, "part").select("p_partkey", "p_size")
    path = stage_path(spark, "export")
    IO.export_table(df, path, rows_per_file=500)
    IO.export_table(df.where("p_partkey < 0"), path)
    return spark.read.parquet(path)


@query("replace_or_keep", "SELECT c_custkey, 'second' AS written FROM customer")
def replace_or_keep(spark, sf):
    """Create, replace, then a create-if-missing that must not change anything."""
    df = table(spark, sf, "customer").select("c_custkey")
    target = stage_path(spark, "table")
    IO.save_as(df.withColumn("written", F.lit("first")), target)
    IO.save_as(df.withColumn("written", F.lit("second")), target)
    IO.save_as(df.withColumn("written", F.lit("third")), target, replace=False)
    return IO.read_table(spark, target)


@query("replaced_in_one_step", "SELECT c_custkey, 'second' AS written, count(*) OVER () AS before FROM customer")
def replaced_in_one_step(spark, sf):
    """A table computed from its own old rows; a reader from before still sees them, and kept rows stay."""
    df = table(spark, sf, "customer").select("c_custkey")
    target = stage_path(spark, "versions")
    IO.save_as(df.withColumn("written", F.lit("first")), target, versioned=True)
    old = IO.read_table(spark, target)
    IO.save_as(old.withColumn("written", F.lit("second")), target, versioned=True)
    IO.save_as(df.withColumn("written", F.lit("third")), target, replace=False)
    before = old.where("written = 'first'").count()
    return IO.read_table(spark, target).withColumn("before", F.lit(before).cast("bigint"))


@query(
    "clustered_scan",
    "SELECT l_suppkey, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem WHERE l_suppkey BETWEEN 3 AND 7 GROUP BY 1",
)
def clustered_scan(spark, sf):
    """Range-clustered files let the filter skip row groups by their min and max."""
    target = stage_path(spark, "clustered")
    df = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    IO.save_as(IO.clustered(df, ["l_suppkey", "l_orderkey"]), target)
    read = IO.read_table(spark, target).where(F.col("l_suppkey").between(3, 7))
    return read.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query(
    "holiday_table",
    f"""WITH {HOLIDAYS} SELECT date, name, count(ts) AS events FROM holidays LEFT JOIN (SELECT ts FROM events) ON CAST(ts AS DATE) = date GROUP BY 1, 2""",
)
def holiday_table(spark, sf):
    """The dimension is written with its schema, read back and joined."""
    target = stage_path(spark, "holidays")
    IO.save_as(us_holidays(spark), target)
    per_day = table(spark, sf, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("events"))
    return IO.read_table(spark, target).join(per_day, "date", "left").withColumn("events", F.coalesce("events", F.lit(0)))


@query("predict_csv", f"{split_sql()} SELECT transaction_id, TRUE AS predicted_as_frame FROM parts WHERE split = 'testing'")
def predict_csv(spark, sf):
    """Feature CSV in, the same CSV with predictions out."""
    train, _, test = feature_splits(spark, sf)
    model, _ = M.train("logistic_regression", train, FEATURES)
    features = test.drop(TARGET)
    source = IO.scan(spark, csv(features, stage_path(spark, "requests")), "csv", features.schema)
    scored = M.score(model, source).withColumnRenamed("prediction", "pred").drop("fraud_probability")
    path = IO.export_table(scored, stage_path(spark, "predictions"), fmt="csv")
    frame = M.score(model, features, [ROW_ID]).select(F.col(ROW_ID).alias("_id"), "prediction")
    read = IO.scan(spark, path, "csv", scored.schema).select(ROW_ID, "pred")
    joined = read.join(frame, F.col(ROW_ID) == F.col("_id"), "left")
    return joined.select(ROW_ID, F.coalesce(F.col("pred") == F.col("prediction"), F.lit(False)).alias("predicted_as_frame"))


@query(
    "feature_and_split_tables",
    f"""{merged_sql('orders')}, cut AS (SELECT quantile_disc(sec, 0.7) AS q FROM merged),
parts AS (SELECT CASE WHEN sec < q THEN 'training' WHEN abs(transaction_id % 100) < 50 THEN 'validation' ELSE 'testing' END AS name, transaction_id, is_fraud FROM merged, cut
  UNION ALL SELECT 'features', transaction_id, is_fraud FROM merged)
SELECT name, count(*) AS "rows", CAST(sum(is_fraud) AS BIGINT) AS frauds, CAST(sum(transaction_id) AS BIGINT) AS ids FROM parts GROUP BY 1""",
)
def feature_and_split_tables(spark, sf):
    """The four stored tables, written, kept by a second run without the replace flag, and read back."""
    root = stage_path(spark, "tables")
    B.write_tables(spark, B.targets(root), *inputs(spark, sf, "orders"), replace=True)
    empty = [df.limit(0) for df in inputs(spark, sf, "orders")[:3]]
    B.write_tables(spark, B.targets(root), *empty, inputs(spark, sf, "orders")[3], replace=False)
    parts = [
        IO.read_table(spark, target).agg(F.count(F.lit(1)).alias("rows"), F.sum(TARGET).cast("bigint").alias("frauds"), F.sum(ROW_ID).cast("bigint").alias("ids")).select(F.lit(name).alias("name"), "*")
        for name, target in B.targets(root).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
