"""Sources and sinks."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import shared_dir, stage, stage_path
from tidemark.sources import files as IO
from tidemark.sources import versions


def test_ordinal_follows_files_and_splits(spark):
    """Several files, each cut into many input splits."""
    path = stage_path(spark, "many")
    rows = spark.range(0, 30_000, 1, 3).select("id", F.lpad("id", 40, "x").alias("pad"))
    rows.write.option("header", True).csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        scan = IO.scan(spark, path, "csv", rows.schema)
        assert scan.rdd.getNumPartitions() > 10
        out = IO.with_file_ordinal(scan, "place", start=1)
        assert out.count() == 30_000
        assert out.where("place <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_formats(spark):
    schema = "a long, b string"
    df = spark.createDataFrame([(1, "x"), (2, None)], schema)
    for fmt in IO.FORMATS:
        path = IO.export_table(df, stage_path(spark, fmt), fmt=fmt)
        assert sorted(map(str, IO.load_files(spark, path, stage_path(spark, "t"), fmt, df.schema).collect())) == sorted(map(str, df.collect()))
    for bad in ("avro", "orc", "json"):
        with pytest.raises(ValueError):
            IO.scan(spark, "/nowhere", bad, df.schema)
    with pytest.raises(ValueError):
        IO.scan(spark, "/nowhere", "csv")


def test_export_returns_the_path_either_way(spark):
    path = stage_path(spark, "e")
    df = spark.range(5)
    assert IO.export_table(df, path) == path
    assert IO.export_table(spark.range(9), path) == path and spark.read.parquet(path).count() == 5
    assert IO.export_table(spark.range(9), path, skip_if_exists=False) == path and spark.read.parquet(path).count() == 9


def test_replace_flag(spark):
    path = stage_path(spark, "t")
    for n, replace, want in ((3, True, 3), (4, False, 3), (4, True, 4)):
        IO.save_as(spark.range(n), path, replace)
        assert IO.read_table(spark, path).count() == want


def test_latest_version_below_a_path(spark):
    root = stage_path(spark, "root")
    for name in ("d_20230101000000", "d_20240101T000000", "e_20250101000000"):
        IO.save_as(spark.range(1), f"{root}/{name}")
    assert IO.latest_version(spark, "d", root=root) == "20240101T000000"
    assert IO.latest_version(spark, "d", "20200101000000", root) == "20200101000000"
    with pytest.raises(LookupError):
        IO.latest_version(spark, "f", root=root)


def test_ordinals_survive_other_split_settings(spark):
    path = stage_path(spark, "moving")
    spark.range(0, 9_000, 1, 6).select("id", F.lpad("id", 40, "x").alias("pad")).write.option("header", True).csv(path)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    out = IO.with_file_ordinal(IO.scan(spark, path, "csv", spark.createDataFrame([], "id long, pad string").schema), "place")
    try:
        for size in ("20000", "900000"):
            for k in keys:
                spark.conf.set(k, size)
            assert out.where("place <> id").count() == 0 and out.count() == 9_000
    finally:
        for k in keys:
            spark.conf.set(k, old[k])


def test_csv_columns_are_found_by_name(spark):
    schema = spark.createDataFrame([], "User long, Has_Chip string").schema
    path = stage_path(spark, "swapped")
    spark.createDataFrame([("YES", 7, "x")], "`Has Chip` string, Other long, User string").write.option("header", True).csv(path)
    row = IO.scan_named(spark, path, schema).first()
    assert (row["Has_Chip"], row["User"]) == ("YES", None)
    with pytest.raises(ValueError, match="lacks"):
        IO.scan_named(spark, path, spark.createDataFrame([], "Gone long").schema)


def test_half_written_export_is_written_anew(spark):
    path = stage_path(spark, "half")
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert not IO.is_complete(spark, path)
    assert IO.export_table(spark.range(5), path) == path and spark.read.parquet(path).count() == 5


def test_ingest_keeps_finished_tables_and_completes_others(spark, sf):
    from tidemark.catalog.storage import cards_csv_file, transactions_csv, users_csv_file

    root = stage_path(spark, "data")
    payments, users, cards = transactions_csv(spark, sf), users_csv_file(spark, sf), cards_csv_file(spark, sf)
    with pytest.raises(Exception):
        IO.ingest(spark, root, "d_20230101000000", payments, users, "/gone")
    first = IO.ingest(spark, root, "d_20230101000000", "/gone", "/gone", cards).collect()
    again = IO.ingest(spark, root, "d_20230101000000", "/gone", "/gone", "/gone").collect()
    assert first == again and len(first) == 4


def test_staged_empty_table_keeps_its_schema(spark):
    df = stage(spark.range(5).where("id < 0"))
    assert df.columns == ["id"] and df.isEmpty()
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named.rstrip("/") if named else shared_dir(spark))


def test_clustered_files_do_not_overlap(spark):
    path = stage_path(spark, "c")
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("k"))
    IO.save_as(IO.clustered(df, ["k"], 4), path)
    bounds = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert len(bounds) == 4 and all(x["b"] < y["a"] for x, y in zip(bounds, bounds[1:]))


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS tidemark_test")
    IO.save_as(spark.range(3), "tidemark_test")
    IO.save_as(spark.range(9), "tidemark_test", replace=False)
    assert IO.read_table(spark, "tidemark_test").count() == 3
    assert "default" in {r["name"] for r in IO.list_names(spark).collect()}
    spark.sql("DROP TABLE tidemark_test")


def test_an_unfinished_folder_is_no_table(spark, tmp_path):
    """What a killed write leaves is written anew; a finished table is kept."""
    target = str(tmp_path / "kept")
    (tmp_path / "kept" / "_temporary" / "0").mkdir(parents=True)
    (tmp_path / "kept" / "part-0.parquet").write_bytes(b"half")
    IO.save_as(spark.range(3), target, replace=False)
    assert IO.read_table(spark, target).count() == 3
    IO.save_as(spark.range(9), target, replace=False)
    assert IO.read_table(spark, target).count() == 3
    IO.save_as(spark.range(9), target)
    assert IO.read_table(spark, target).count() == 9


def test_a_failed_write_leaves_the_old_rows(spark):
    target = stage_path(spark, "versions")
    broken = spark.range(100).select(F.when(F.col("id") < 50, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        IO.save_as(broken, target, versioned=True)
    assert not IO.table_exists(spark, target)
    IO.save_as(spark.range(3), target, replace=False, versioned=True)
    old = IO.read_table(spark, target)
    with pytest.raises(Exception, match="killed"):
        IO.save_as(broken, target, versioned=True)
    assert IO.read_table(spark, target).count() == 3
    IO.save_as(old.select((F.col("id") + 7).alias("id")), target)  # reads what it replaces, and stays versioned
    assert old.count() == 3 and {r["id"] for r in IO.read_table(spark, target).collect()} == {7, 8, 9}
    IO.save_as(spark.range(9), target, replace=False)
    assert IO.read_table(spark, target).count() == 3


def test_old_versions_go_and_the_current_one_stays(spark):
    target = stage_path(spark, "versions")
    assert versions.current(spark, target) is None
    for n in range(1, 4):
        versions.publish(spark.range(n), target)
    assert versions.drop_old(spark, target, older_than_hours=1) == 0
    assert versions.drop_old(spark, target, older_than_hours=-1) == 2
    assert IO.read_table(spark, target).count() == 3 and versions.drop_old(spark, target, -1) == 0
