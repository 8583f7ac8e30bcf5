"""Two-step merging for results that every task contributes to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARDS = 256


def shard() -> Column:
    """Group of the task that reads the row.

    With hundreds of thousands of tasks, sketches or top-k lists from all of
    them are too much for one final task; merged per group first, at most 256 remain.
    Only for results that do not depend on how rows are grouped.
    """
    return F.spark_partition_id() % SHARDS
