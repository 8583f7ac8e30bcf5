"""Incoming payments and growing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import features as P
from ..plans import serving as V
from ..plans import training as M
from ..plans.split import assign_split
from ..schema import EPOCH, FEATURES, ROW_ID, TARGET
from ..session import stage
from .base import ORACLES, merged_sql, query, rounded
from .history import inputs


def parts(spark, sf, *conditions):
    """Raw payments cut by conditions on the raw columns, each merged and staged."""
    transactions, *others = inputs(spark, sf, "events")
    return [stage(P.merge_payments(transactions.where(c), *others), "payments") for c in conditions]


LATE = "(Day BETWEEN 24 AND 27 AND transaction_id % 50 = 0)"


@query("appended_days", ORACLES["features_events"])
def appended_days(spark, sf):
    """The feature table of all payments but the last days and some late ones, then twice appended to."""
    transactions, *others = inputs(spark, sf, "events")
    old = f"Day <= 27 AND NOT {LATE}"
    first, late, last = parts(spark, sf, old, f"Day = 28 OR {LATE}", "Day > 28")
    table = stage(P.build_features(transactions.where(old), *others), "features")
    table, known = V.append_payments(table, first, [V.totals(first)], late)
    table, _ = V.append_payments(stage(table, "features"), first.unionByName(late), known, last)
    return rounded(table, (ROW_ID, EPOCH, TARGET))


@query(
    "score_incoming",
    f"""{merged_sql('events')} SELECT transaction_id, TRUE AS scored_as_batch FROM merged WHERE day(dt) >= 28""",
)
def score_incoming(spark, sf):
    """Two batches of raw requests without labels, scored on features as of their second: the feature table's scores."""
    table = stage(P.build_features(*inputs(spark, sf, "events")), "features")
    model, _ = M.train("logistic_regression", assign_split(table).where("split = 'training'"), FEATURES)
    payments, *batches = parts(spark, sf, "Day < 28", "Day = 28", "Day > 28")
    known, out = [V.totals(payments)], None
    for batch in batches:
        requests = batch.withColumns({c: F.lit(None).cast("int") for c in V.RATE_VALUES})
        scored = M.score(model, V.incoming_features(requests, known, payments), [ROW_ID])
        out = scored if out is None else out.unionByName(scored)
        known, payments = [*known, V.totals(requests, labelled=False)], payments.unionByName(requests)
    want = M.score(model, table, [ROW_ID]).select(F.col(ROW_ID).alias("_id"), F.col("fraud_probability").alias("_p"))
    same = F.coalesce(F.abs(F.col("fraud_probability") - F.col("_p")) < 1e-9, F.lit(False))
    return out.join(want, F.col(ROW_ID) == F.col("_id"), "left").select(ROW_ID, same.alias("scored_as_batch"))
