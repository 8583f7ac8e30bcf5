"""Tables replaced in one step: each write has a folder of its own, a pointer file names the one that counts.

A table's folder holds ``data-<id>`` folders and the file ``_current`` with the name of one of them.
A write that ends early leaves a folder that nothing points at; a reader
sees the old rows or the new ones, never none or half of them, and goes on with the files it
has opened when the pointer moves.  One writer at a time per table; of two, the last to finish counts.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> str | None:
    """Folder with the table's rows; None where nothing was published."""
    pointer = _path(spark, f"{root.rstrip('/')}/{POINTER}")
    system = _system(spark, pointer)
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{root.rstrip('/')}/{name}"


def publish(df: DataFrame, root: str) -> str:
    """Write the rows beside those that count, then point at them in one rename; returns their folder."""
    spark, root = df.sparkSession, root.rstrip("/")
    name = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    draft, pointer = _path(spark, f"{root}/_draft-{uuid.uuid4().hex}"), _path(spark, f"{root}/{POINTER}")
    stream = _system(spark, draft).create(draft, False)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs
    context = files.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    options[0] = files.Options.Rename.OVERWRITE
    qualified = [context.makeQualified(p) for p in (draft, pointer)]
    context.rename(*qualified, options)
    return f"{root}/{name}"


def drop_old(spark: SparkSession, root: str, older_than_hours: float = 24.0) -> int:
    """Remove folders that do not count and were last changed before that time; returns how many.

    Choose the time above the longest read and the longest write: a running write does not count yet either.
    """
    kept, folder = current(spark, root), _path(spark, root)
    if kept is None:
        return 0
    system, limit, dropped = _system(spark, folder), (time.time() - older_than_hours * 3600) * 1000, 0
    for entry in system.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("data-") and name != kept.rsplit("/", 1)[1] and entry.getModificationTime() < limit:
            system.delete(entry.getPath(), True)
            dropped += 1
    return dropped
