"""File and table I/O: typed scans, loads, exports, versions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as K
from ..functions.scalars import yes_no
from ..session import stage
from . import versions
from .holidays import us_holidays

FORMATS = ("csv", "parquet", "jsonl")
PREDICTION_SHARDS = "predictions.results-*"


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None):
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    if schema is None and fmt != "parquet":
        raise ValueError(f"{fmt} needs a schema: inference reads everything twice and guesses types")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("header", True) if fmt == "csv" else reader


def scan(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None) -> DataFrame:
    """Typed scan of CSV with header, Parquet or JSON lines."""
    return _reader(spark, fmt, schema).format({"jsonl": "json"}.get(fmt, fmt)).load(path)


def scan_predictions(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "jsonl") -> DataFrame:
    """The result shards of a batch prediction, leaving other files in the folder alone."""
    return scan(spark, f"{folder.rstrip('/')}/{PREDICTION_SHARDS}", fmt, schema)


def with_file_ordinal(df: DataFrame, output: str, start: int = 0) -> DataFrame:
    """Adds each row's position in file order: files by path, rows as written.

    ``df`` must be a plain file scan.  The rows are stored once with their input
    split and their number in it; split starts and places both come from that
    stored table, so later settings or retries cannot move an id.  Rows are counted
    per split (one small row each) and never shuffled or sorted.
    """
    rows = stage(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
        ),
        "rows",
    )
    splits = rows.groupBy("_file", "_block").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    # Staged, so its true size decides whether the join below broadcasts it.
    starts = stage(
        splits.select("_file", "_block", "_first", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")),
        "splits",
    )
    offset = F.col("_seq") - F.col("_first")
    place = F.when(offset.between(0, F.col("_n") - 1), F.col("_start") + offset + start)
    lost = F.raise_error(F.lit("a row lies outside its input split")).cast("bigint")
    return (
        rows.join(starts, ["_file", "_block"], "left")
        .withColumn(output, F.coalesce(place, lost))
        .drop("_file", "_block", "_seq", "_first", "_n", "_start")
    )


def column_name(text: str) -> str:
    """A header's name with everything but letters, digits and ``_`` written as ``_``."""
    return re.sub(r"[^0-9A-Za-z_]", "_", text.strip())


def scan_named(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV columns found by the names in the header, in any order, typed as ``schema`` says.

    Names are compared as ``column_name`` writes them; further columns are left alone, a
    missing one raises ValueError, and a value that does not fit its type is NULL.  All
    files of the path must share one header (Spark checks that).
    """
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    found = {column_name(c): c for c in text.columns}
    missing = [f.name for f in schema.fields if column_name(f.name) not in found]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {text.columns}")
    # The schema is given for the whole header, so only the wanted columns are parsed.
    wanted = {found[column_name(f.name)]: f for f in schema.fields}
    full = T.StructType([T.StructField(c, wanted[c].dataType if c in wanted else T.StringType()) for c in text.columns])
    typed = spark.read.schema(full).option("header", True).option("enforceSchema", False).csv(path)
    return typed.select(*[F.col(f"`{c}`").alias(f.name) for c, f in wanted.items()])


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Payments CSV, typed, with a row id counted in file order from 1."""
    raw = with_file_ordinal(scan_named(spark, path, K.TRANSACTIONS), K.ROW_ID, start=1)
    return raw.select(
        K.ROW_ID,
        "User",
        "Card",
        "Year",
        "Month",
        "Day",
        "Time",
        F.replace("Amount", F.lit("$"), F.lit("")).cast("decimal(12,2)").alias("Amount"),
        "Use_Chip",
        "MCC",
        yes_no(F.col("Is_Fraud_")).alias("Is_Fraud_"),
    )


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Card holders CSV; the key is the row's place in the file, from 0."""
    return with_file_ordinal(scan_named(spark, path, K.USERS), "User")


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return scan_named(spark, path, K.CARDS).withColumns(
        {c: yes_no(F.col(c)) for c in ("Has_Chip", "Card_on_Dark_Web")}
    )


def save_as(df: DataFrame, target: str, replace: bool = True, versioned: bool = False) -> None:
    """Create a table from a query: replace it, or keep an existing one.

    ``target`` is a path when it contains a slash, else a catalog table.  A folder
    that a broken-off job left unfinished does not count as existing: it is written anew.  ``versioned`` replaces
    in one step (see `versions`), so that the old rows can be read, also by the query itself, until the new
    ones are complete; a folder once written so is always written so, and read by `read_table`.
    """
    if "/" not in target:
        df.write.mode("overwrite" if replace else "ignore").format("parquet").saveAsTable(target)
    elif replace or not table_exists(df.sparkSession, target):
        if versioned or versions.current(df.sparkSession, target):
            versions.publish(df, target)
        else:
            df.write.mode("overwrite").parquet(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a finished table is there."""
    if "/" not in target:
        return spark.catalog.tableExists(target)
    return versions.current(spark, target) is not None or is_complete(spark, target)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(versions.current(spark, target) or target) if "/" in target else spark.table(target)


def load_files(spark: SparkSession, path: str, target: str, fmt: str = "csv", schema: T.StructType | None = None, predictions: bool = False) -> DataFrame:
    """Load files into a table, replacing its rows."""
    df = scan_predictions(spark, path, schema, fmt) if predictions else scan(spark, path, fmt, schema)
    save_as(df, target)
    return read_table(spark, target)


def _path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing this folder (its success marker is there)."""
    return _path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def export_table(df: DataFrame, path: str, skip_if_exists: bool = True, fmt: str = "parquet", rows_per_file: int = 0) -> str:
    """Sharded export; a finished target is kept and its path still returned, a half-written one is written anew."""
    if skip_if_exists and is_complete(df.sparkSession, path):
        return path
    writer = df.write.mode("overwrite").format({"jsonl": "json"}.get(fmt, fmt))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return path


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows ordered by ``keys`` across and inside files, so Parquet min/max can skip files."""
    parts = [partitions] if partitions else []
    return df.repartitionByRange(*parts, *keys).sortWithinPartitions(*keys)


def valid_version(text: Column) -> Column:
    """True for a real instant written as YYYYmmddHHMMSS."""
    return F.coalesce(
        text.rlike("^[0-9]{14}$") & F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")).isNotNull(), F.lit(False)
    )


def version_of(name: Column, dataset: str) -> Column:
    """Version part of ``<dataset>_<version>`` with or without a T before the time; NULL if none."""
    found = F.regexp_extract(name, re.escape(dataset) + r"_(\d{8}T?\d{6})", 1)
    return F.nullif(found, F.lit(""))


def max_version(names: DataFrame, dataset: str, column: str = "name") -> DataFrame:
    """One row: the newest version among dataset names, NULL when none matches."""
    version = version_of(F.col(column), dataset)
    return names.agg(F.max_by(version, F.replace(version, F.lit("T"), F.lit(""))).alias("version"))


def list_names(spark: SparkSession, root: str | None = None) -> DataFrame:
    """Databases of the catalog, or the folders below a path, as (name)."""
    if root is None:
        return spark.sql("SHOW NAMESPACES").toDF("name")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return spark.createDataFrame([(e.getPath().getName(),) for e in entries], "name string")


def latest_version(spark: SparkSession, dataset: str, requested: str = "", root: str | None = None) -> str:
    """The requested version, else the newest one that exists."""
    if requested:
        return requested
    found = max_version(list_names(spark, root), dataset).first()["version"]
    if found is None:
        raise LookupError(f"no version of {dataset!r} found")
    return found


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column counts, one row per loaded table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def preview(df: DataFrame, order: str, drop: Iterable[str] = (), n: int = 10) -> DataFrame:
    """First ``n`` records in a stated order, without id and target columns."""
    return df.orderBy(order).limit(n).drop(*drop)


def ingest(spark: SparkSession, root: str, version: str, transactions: str, users: str, cards: str) -> DataFrame:
    """Load the four source tables below ``root/<version>``; report counts.

    Each table is loaded unless a finished one is there, so a load that broke off is completed by the next run.
    """
    base = f"{root.rstrip('/')}/{version}"
    tables = {
        "holidays": lambda: us_holidays(spark),
        "transactions": lambda: read_transactions(spark, transactions),
        "users": lambda: read_users(spark, users),
        "cards": lambda: read_cards(spark, cards),
    }
    for name, read in tables.items():
        if not is_complete(spark, f"{base}/{name}"):
            save_as(read(), f"{base}/{name}")
    return load_report({t: spark.read.parquet(f"{base}/{t}") for t in tables})
