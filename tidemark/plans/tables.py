"""The stored outputs of the pipeline: feature table and the three splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schema import EPOCH
from ..sources.files import clustered, read_table, save_as, table_exists
from .features import build_features
from .split import temporal_split

NAMES = ("features", "training", "validation", "testing")


def targets(root: str) -> dict[str, str]:
    """Paths of the four tables below a folder."""
    return {name: f"{root.rstrip('/')}/{name}" for name in NAMES}


def write_tables(
    spark: SparkSession,
    where: Mapping[str, str],
    transactions: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    holidays: DataFrame,
    replace: bool = True,
    valid: float = 0.15,
    test: float = 0.15,
    **options,
) -> None:
    """Write the feature table, range-clustered by event second, and its splits.

    ``where`` names a path or catalog table for each of ``NAMES``.  Without ``replace`` finished
    tables are kept, and nothing is computed if all four are there; splits of a feature
    table that is built anew are built anew as well.  Each path is replaced in one step: read it by `read_table`.
    """
    due = {name for name in NAMES if replace or not table_exists(spark, where[name])}
    if "features" in due:
        due = set(NAMES)
        built = build_features(transactions, users, cards, holidays, **options)
        save_as(clustered(built, [EPOCH]), where["features"], versioned=True)
    if due - {"features"}:
        splits = temporal_split(read_table(spark, where["features"]), valid, test)
        for name, part in zip(NAMES[1:], splits):
            if name in due:
                save_as(part, where[name], versioned=True)
