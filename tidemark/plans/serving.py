"""Features of incoming payments from stored totals, and a feature table that grows by days.

A feature needs sums over rows before some time, and a sum over a frame is the
difference of two running sums.  The running sums of all payments so far are stored once, one row
per second, per category and second, and per user and second; a new payment looks
each of its frame edges up in them.  Tables over disjoint payments add up, so a day of
payments is a further small table and nothing stored is rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import cumulative, totals_as_of
from ..operators.joins import attach
from ..operators.prefix import DAY, id_levels, mean_measures, range_mean, require_exact, running_totals
from ..schema import EPOCH, FEATURES, FRAUD_DELAY_DAYS, ROW_ID, TARGET
from ..session import stage
from .features import INDICATORS, USER_WINDOWS, _user_columns, fraud_rate_features, user_ratios

UNTIMED = -(1 << 40)  # payments without a time stand before all others of their user
RATE_VALUES = list(INDICATORS.values())
COMPLETE = [v for v in RATE_VALUES if v != TARGET]
HISTORY = ("sum", "n", "all")


@dataclass(frozen=True)
class Totals:
    """Running sums of some payments; ``firsts`` is each user's first second.  Without labels only the user parts are known."""

    users: DataFrame
    firsts: DataFrame
    categories: DataFrame | None = None
    rates: DataFrame | None = None


def totals(merged: DataFrame, labelled: bool = True) -> Totals:
    """Running sums of merged payments, staged."""
    require_exact(merged, ["amount"])
    history = {
        "sum": F.col("amount"),
        "n": F.when(F.col("amount").isNotNull(), 1).otherwise(0),
        "all": F.when(F.col(ROW_ID).isNotNull(), 1).otherwise(0),
    }
    placed = merged.withColumn(EPOCH, F.coalesce(EPOCH, F.lit(UNTIMED)))
    users = stage(cumulative(placed, EPOCH, history, ["user"]), "user-totals")
    firsts = stage(merged.groupBy("user").agg(F.min(EPOCH).alias("first")), "first-payments")
    if not labelled:
        return Totals(users, firsts)
    categories = stage(cumulative(merged, EPOCH, mean_measures([TARGET])[0], ["mcc"]), "category-totals")
    return Totals(users, firsts, categories, stage(cumulative(merged, EPOCH, mean_measures(RATE_VALUES, COMPLETE)[0]), "rate-totals"))


def _user_history(rows: DataFrame, known: Sequence[Totals], peers: DataFrame) -> DataFrame:
    """User features of timed rows; ``peers`` are all payments of the same users and seconds, the rows among them."""
    offsets = {"now": 1, **{label: d * DAY + 1 for label, d in USER_WINDOWS.items()}}
    sums = stage(totals_as_of(rows, [t.users for t in known], EPOCH, HISTORY, offsets, ["user"]), "user-sums")
    steps = {
        "_sum": F.coalesce(F.col("amount"), F.lit(0)),
        "_n": F.when(F.col("amount").isNotNull(), 1).otherwise(0),
        "_all": F.when(F.col(ROW_ID).isNotNull(), 1).otherwise(0),
    }
    ranked = running_totals(peers.select("user", EPOCH, ROW_ID, "amount"), id_levels(F.col(ROW_ID)), [ROW_ID], steps, keys=["user", EPOCH])
    ranked = ranked.select(ROW_ID, *[f"{n}_before" for n in steps])
    first = known[0].firsts
    for t in known[1:]:
        first = first.unionByName(t.firsts)
    first = first.groupBy("user").agg(F.min("first").alias("_first"))
    wide = attach(attach(attach(rows, ranked, [ROW_ID]), sums, ["user", EPOCH]), first, ["user"])
    wide = wide.withColumns(
        {**{f"_{n}_rows": F.col(f"{n}_now") + F.col(f"_{n}_before") for n in HISTORY}, "_first": F.timestamp_seconds(F.least("_first", EPOCH))}
    )
    return user_ratios(_user_columns(wide, rows.columns, "datetime", USER_WINDOWS))


def features_as_of(
    rows: DataFrame, known: Sequence[Totals], payments: DataFrame, delay_days: int = FRAUD_DELAY_DAYS, features: Sequence[str] = FEATURES
) -> DataFrame:
    """The feature table's rows of some merged payments, from stored totals: row id, epoch, the features, target.

    ``known`` covers every payment known by now once, the rows themselves included; their own labels
    may be missing (totals without labels), since only labels a delay older than a payment are read.  ``payments`` holds
    at least the known payments of the rows' users and seconds, with unique ids: payments of one
    second are ordered by id.  Rows need a time; without one they are an error.
    """
    delay = delay_days * DAY
    late = F.raise_error(F.lit("an incoming payment needs a time")).cast("bigint")
    rows = stage(rows.withColumn(EPOCH, F.coalesce(EPOCH, late)), "rows")
    seconds = rows.select("user", EPOCH).distinct()
    span = rows.agg(F.min(EPOCH).alias("low"), F.max(EPOCH).alias("high")).first()
    near = payments.where(F.col(EPOCH).between(span["low"], span["high"])) if span["low"] is not None else payments.limit(0)
    peers = near.join(seconds, ["user", EPOCH], "left_semi")
    out = _user_history(rows, known, peers)
    labelled = [t for t in known if t.rates is not None]

    def stored(part: str, keys: list[str]):
        def sums(measures, offsets):
            return stage(totals_as_of(rows, [getattr(t, part) for t in labelled], EPOCH, list(measures), offsets, keys), f"{part}-sums")

        return sums

    means = range_mean(
        rows, EPOCH, [TARGET], {"": None}, delay, keys=["mcc"], names={(TARGET, ""): "mcc_mean_encoding"}, sums=stored("categories", ["mcc"])
    )
    settled = attach(means, fraud_rate_features(rows, EPOCH, delay, sums=stored("rates", [])), [EPOCH])
    out = attach(out, settled, ["mcc", EPOCH], null_safe=["mcc"])
    out = out.withColumn("mcc_mean_encoding", F.coalesce("mcc_mean_encoding", F.lit(0.0)))
    return out.select(ROW_ID, EPOCH, *[F.col(f"`{f}`") for f in features], TARGET)


def incoming_features(requests: DataFrame, known: Sequence[Totals], payments: DataFrame, **options) -> DataFrame:
    """Features of a batch of merged requests whose labels nobody knows; ``payments`` are those known before.

    Requests of one batch see each other's amounts, as rows of the feature table do, but no label of each other.
    """
    both = payments.select(ROW_ID, EPOCH, "user", "amount").unionByName(requests.select(ROW_ID, EPOCH, "user", "amount"))
    return features_as_of(requests, [*known, totals(requests, labelled=False)], both, **options)


def append_payments(
    table: DataFrame, payments: DataFrame, known: Sequence[Totals], new: DataFrame, delay_days: int = FRAUD_DELAY_DAYS, features: Sequence[str] = FEATURES
) -> tuple[DataFrame, list[Totals]]:
    """The feature table with further merged payments, and the totals that now hold.

    Rows older than every new payment stay as they are; the others (none but the new ones, unless some come late) are
    worked out anew.  The result equals a full rebuild.  A payment without a time stands before all others
    and would change every row of its user: that needs the rebuild, so it raises ValueError.
    """
    found = new.agg(F.min(EPOCH).alias("oldest"), F.count_if(F.col(EPOCH).isNull()).alias("untimed")).first()
    if found["untimed"]:
        raise ValueError(f"{found['untimed']} new payments have no time; build the table anew")
    if found["oldest"] is None:
        return table, list(known)
    known = [*known, totals(new)]
    together = payments.select(*new.columns).unionByName(new)
    built = features_as_of(together.where(F.col(EPOCH) >= found["oldest"]), known, together, delay_days, features)
    return table.where(F.col(EPOCH).isNull() | (F.col(EPOCH) < found["oldest"])).unionByName(built), known
