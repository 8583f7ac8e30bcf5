"""Statistics, skew, drift and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import stats as D
from ..plans import features as P
from ..plans import training as M
from ..plans.split import assign_split
from ..schema import EPOCH, FEATURES, MONITORED, ROW_ID, TARGET
from ..session import stage, stage_path
from ..sources.adapters import table
from ..streaming import monitor, scoring
from .base import merged_sql, query, rnd, rounded, sql_rnd
from .history import inputs, merged
from .modelling import feature_splits, split_sql

NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
STATS = "mean std_dev min max".split()


def _stats_sql():
    parts = [
        f"""SELECT '{c}' AS feature, count({c}) AS present, count(*) - count({c}) AS missing, count(*) FILTER ({c} = 0) AS zeros,
  {sql_rnd(f'avg({c})', 4)} AS mean, {sql_rnd(f'stddev_pop({c})', 4)} AS std_dev, {sql_rnd(f'min({c})', 4)} AS min, {sql_rnd(f'max({c})', 4)} AS max FROM lineitem"""
        for c in NUMERIC
    ]
    return " UNION ALL ".join(parts)


@query("feature_stats", _stats_sql())
def feature_stats(spark, sf):
    out = D.feature_stats(table(spark, sf, "lineitem"), NUMERIC)
    return out.select("feature", "present", "missing", "zeros", *[rnd(F.col(c), 4).alias(c) for c in STATS])


@query("feature_stats_sketches")
def feature_stats_sketches(spark, sf):
    """Medians and distinct counts, from sketches."""
    return D.feature_stats(table(spark, sf, "lineitem")).select("feature", "type", "median", "approx_distinct")


SCHEMA_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 'FLOAT' AS type, count(*) = count({c}) AS required, {sql_rnd(f'min({c})')} AS low, {sql_rnd(f'max({c})')} AS high, env AS environment, NOT ('{c}' = 'l_tax' AND env = 'SERVING') AS expected FROM lineitem CROSS JOIN (VALUES ('TRAINING'), ('SERVING')) AS v(env) GROUP BY env"
    for c in NUMERIC
)


@query("written_profile", SCHEMA_SQL)
def written_profile(spark, sf):
    """Statistics and schema written as tables; the schema read back."""
    _, schema = D.write_profile(table(spark, sf, "lineitem"), "l_tax", stage_path(spark, "profile"), NUMERIC)
    return schema.withColumns({c: rnd(F.col(c)) for c in ("low", "high")})


@query("feature_schema", SCHEMA_SQL)
def feature_schema(spark, sf):
    stats = D.feature_stats(table(spark, sf, "lineitem"), NUMERIC)
    out = D.infer_schema(stats, "l_tax")
    return out.withColumns({c: rnd(F.col(c)) for c in ("low", "high")})


@query(
    "schema_anomalies",
    """WITH t AS (SELECT * FROM lineitem WHERE l_quantity <= 40), s AS (SELECT * FROM lineitem)
SELECT 'l_quantity' AS feature, 'OUT_OF_RANGE' AS anomaly FROM t HAVING (SELECT max(l_quantity) FROM s) > max(l_quantity)
UNION ALL SELECT 'l_tax', 'UNEXPECTED_IN_ENVIRONMENT' FROM s HAVING count(*) > 0
UNION ALL SELECT 'l_linenumber', 'NEW_COLUMN' FROM s HAVING count(*) > 0""",
)
def schema_anomalies(spark, sf):
    df = table(spark, sf, "lineitem")
    known = df.select("l_quantity", "l_discount", "l_tax").where("l_quantity <= 40")
    expected = D.infer_schema(D.feature_stats(known), "l_tax")
    return D.validate(df.select("l_quantity", "l_discount", "l_tax", "l_linenumber"), expected, "SERVING")


def _bin_sql(c, source="lineitem", reference="lineitem"):
    return f"""SELECT '{c}' AS feature, CAST(greatest(0, least(9, floor((CAST({c} AS DOUBLE) - lo) / (hi - lo) * 10))) AS INTEGER) AS bin, count(*) AS n
  FROM {source}, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {reference}) GROUP BY 1, 2"""


@query("histograms", " UNION ALL ".join(_bin_sql(c) for c in NUMERIC))
def histograms(spark, sf):
    df = table(spark, sf, "lineitem").select(*NUMERIC)
    return D.histograms(df, NUMERIC, D.bin_edges(df, NUMERIC))


@query("quantile_histogram")
def quantile_histogram(spark, sf):
    return D.quantile_histogram(table(spark, sf, "lineitem"), NUMERIC)


@query(
    "top_values",
    """WITH l AS (SELECT 'o_orderstatus' AS feature, o_orderstatus AS value FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
c AS (SELECT feature, value, count(*) AS n FROM l GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rank FROM c)
SELECT feature, value, n, rank FROM r WHERE rank <= 2""",
)
def top_values(spark, sf):
    return D.top_values(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], 2)


DISTANCE = """
ps AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS p FROM a), qs AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS q FROM b),
j AS (SELECT feature, coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM ps FULL JOIN qs USING (feature, bin)),
d AS (SELECT feature, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js, max(abs(p - q)) AS linf FROM j GROUP BY 1)"""


@query(
    "training_serving_skew",
    f"""{merged_sql('orders')}, cut AS (SELECT quantile_disc(sec, 0.7) AS q FROM merged), tr AS (SELECT merged.* FROM merged, cut WHERE sec < q), se AS (SELECT merged.* FROM merged, cut WHERE sec >= q),
a AS ({_bin_sql('amount', 'tr', 'tr')} UNION ALL {_bin_sql('month_sin', 'tr', 'tr')}), b AS ({_bin_sql('amount', 'se', 'tr')} UNION ALL {_bin_sql('month_sin', 'se', 'tr')}), {DISTANCE}
SELECT feature, {sql_rnd('js')} AS distance, CAST(0.01 AS DOUBLE) AS threshold, js > 0.01 AS alert FROM d""",
)
def training_serving_skew(spark, sf):
    df = stage(assign_split(merged(spark, sf, "orders").select(ROW_ID, EPOCH, "amount", "month_sin")), "split")
    train, serving = df.where("split = 'training'"), df.where("split <> 'training'")
    return D.skew(train, serving, {"amount": 0.01, "month_sin": 0.01}).withColumn("distance", rnd(F.col("distance")))


@query(
    "categorical_skew",
    f"""WITH a AS (SELECT 'o_orderstatus' AS feature, o_orderstatus AS bin, count(*) AS n FROM orders WHERE year(o_orderdate) < 2000 GROUP BY 2),
b AS (SELECT 'o_orderstatus' AS feature, o_orderstatus AS bin, count(*) AS n FROM orders WHERE year(o_orderdate) >= 2000 GROUP BY 2), {DISTANCE}
SELECT feature, {sql_rnd('linf')} AS distance, CAST(0.01 AS DOUBLE) AS threshold, linf > 0.01 AS alert FROM d""",
)
def categorical_skew(spark, sf):
    df = table(spark, sf, "orders")
    old, new = df.where(F.year("o_orderdate") < 2000), df.where(F.year("o_orderdate") >= 2000)
    out = D.skew(old, new, {"o_orderstatus": 0.01}, categorical=["o_orderstatus"])
    return out.withColumn("distance", rnd(F.col("distance")))


WINDOWED = """
w AS (SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS window_start, CAST(greatest(0, least(9, floor((value - lo) / (hi - lo) * 10))) AS INTEGER) AS bin, count(*) AS n
  FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY 1, 2)"""


@query(
    "serving_drift",
    f"""WITH {WINDOWED}, prev AS (SELECT window_start, lag(window_start) OVER (ORDER BY window_start) AS before FROM (SELECT DISTINCT window_start FROM w)),
a AS (SELECT prev.window_start AS feature, bin, n FROM prev JOIN w ON w.window_start = prev.before), b AS (SELECT w.window_start AS feature, bin, n FROM w JOIN prev USING (window_start) WHERE before IS NOT NULL), {DISTANCE}
SELECT feature AS window_start, 'value' AS feature, {sql_rnd('js')} AS distance, CAST(0.01 AS DOUBLE) AS threshold, js > 0.01 AS alert FROM d""",
)
def serving_drift(spark, sf):
    events = table(spark, sf, "events").select("ts", "value")
    h = monitor.window_histograms(events, "ts", ["value"], D.bin_edges(events, ["value"]))
    out = monitor.drift_report(h, {"value": 0.01})
    return out.withColumns({"distance": rnd(F.col("distance")), "window_start": F.col("window_start").cast("timestamp_ntz")})


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query(
    "stream_histograms",
    f"""WITH {WINDOWED} SELECT window_start, 'value' AS feature, bin, n FROM w
WHERE window_start + INTERVAL 6 HOURS <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_histograms(spark, sf):
    """Closed six-hour windows of a stream equal the batch result."""
    edges = stage(D.bin_edges(table(spark, sf, "events"), ["value"]), "edges")
    h = monitor.window_histograms(event_stream(spark, sf), "ts", ["value"], edges)
    path, mark = stage_path(spark, "histograms"), stage_path(spark, "progress")
    monitor.write_histograms(h, path, mark).awaitTermination()
    return spark.read.schema(h.schema).parquet(path).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_log", f"SELECT event_id, user_id, {sql_rnd('value')} AS value FROM events")
def stream_log(spark, sf):
    """An append-only log of the whole stream."""
    stream = scoring.sampled(event_stream(spark, sf), "event_id").select("event_id", "user_id", rnd(F.col("value")).alias("value"))
    path, mark = stage_path(spark, "log"), stage_path(spark, "progress")
    scoring.append_log(stream, path, mark).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_log_sampled")
def stream_log_sampled(spark, sf):
    stream = scoring.sampled(event_stream(spark, sf), "event_id", 0.25).select("event_id")
    path, mark = stage_path(spark, "log"), stage_path(spark, "progress")
    scoring.append_log(stream, path, mark).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_scoring", f"{split_sql()} SELECT transaction_id, TRUE AS scored_as_batch FROM parts WHERE split = 'testing'")
def stream_scoring(spark, sf):
    """Requests arrive as files, leave as scored records in the log."""
    train, valid, test = feature_splits(spark, sf)
    model, _ = M.train("logistic_regression", train, FEATURES)
    requests = stage_path(spark, "requests")
    test.drop(TARGET).write.parquet(requests)
    stream = spark.readStream.schema(test.drop(TARGET).schema).parquet(requests)
    out = scoring.score_stream(stream, model, [ROW_ID])
    path, mark = stage_path(spark, "responses"), stage_path(spark, "progress")
    scoring.append_log(out, path, mark).awaitTermination()
    log = spark.read.schema(out.schema).parquet(path)
    batch = M.score(model, test, [ROW_ID]).select(F.col(ROW_ID).alias("_id"), F.col("fraud_probability").alias("_p"))
    same = F.abs(F.col("fraud_probability") - F.col("_p")) < 1e-12
    return log.join(batch, F.col(ROW_ID) == F.col("_id"), "left").select(ROW_ID, F.coalesce(same, F.lit(False)).alias("scored_as_batch"))


SMALL = {"n_estimators": 20}  # trees of the explained models; the values are exact at any number


def explained_model(train, name):
    recipe = M.Recipe(scaling="none" if name in ("random_forest", "xgboost", "lightgbm") else "standard", params={name: SMALL})
    return M.train(name, train, FEATURES, recipe=recipe)[0]


@query(
    "attribution_exact",
    f"""{split_sql()} SELECT model, count(*) AS "rows", TRUE AS adds_up FROM parts
CROSS JOIN (VALUES ('logistic_regression'), ('sgd_classifier'), ('random_forest'), ('xgboost'), ('lightgbm')) AS m(model) WHERE split = 'testing' GROUP BY model""",
)
def attribution_exact(spark, sf):
    """Base and Shapley values of all five models add up to the margin on every row."""
    train, _, test = feature_splits(spark, sf)
    found = None
    for name in M.MODELS:
        rows = A.explain(explained_model(train, name), test, [ROW_ID])
        total = F.aggregate("contributions", F.col("base"), lambda a, b: a + b)
        part = rows.agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(F.abs(total - F.col("margin"))) < 1e-9, F.lit(False)).alias("adds_up")
        )
        found = part if found is None else found.unionByName(part)
    return found


LIMITS = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({t} AS DOUBLE) AS threshold" for f, t in MONITORED.items())


def _fits(out):
    fits = F.col("distance").between(0, 1) & (F.col("alert") == (F.col("distance") > F.col("threshold")))
    return F.coalesce(fits, F.lit(False)).alias("fits")


@query("attribution_skew", f"SELECT feature, threshold, TRUE AS fits FROM ({LIMITS})")
def attribution_skew(spark, sf):
    """The monitored features' shares in serving against training, for boosted trees."""
    train, _, test = feature_splits(spark, sf)
    out = A.attribution_skew(explained_model(train, "xgboost"), train, test, MONITORED)
    return out.select("feature", "threshold", _fits(out))


@query(
    "attribution_drift",
    f"""{merged_sql('events')}, cut AS (SELECT quantile_disc(sec, 0.7) AS q FROM merged), w AS (SELECT DISTINCT sec // 21600 * 21600 AS h FROM merged, cut WHERE sec >= q),
steps AS (SELECT h, lag(h) OVER (ORDER BY h) AS before FROM w) SELECT CAST(h AS BIGINT) AS window_epoch, feature, threshold, TRUE AS fits FROM steps CROSS JOIN ({LIMITS}) WHERE before IS NOT NULL""",
)
def attribution_drift(spark, sf):
    """The monitored features' shares in consecutive six-hour windows of served rows."""
    rows = assign_split(stage(P.build_features(*inputs(spark, sf, "events")), "features"))
    train, served = rows.where("split = 'training'"), rows.where("split <> 'training'").withColumn("at", F.timestamp_seconds(EPOCH))
    out = A.attribution_drift(explained_model(train, "lightgbm"), served, "at", MONITORED)
    return out.select(F.unix_seconds("window_start").alias("window_epoch"), "feature", "threshold", _fits(out))


FILE_ROWS = 200_000


def files_each(counts, batches):
    """Files of every batch: as the largest needs, but no more than the smallest fills (an empty task leaves no file)."""
    if len(counts) < batches:
        return 1
    return max(1, min(-(-max(counts) // FILE_ROWS), min(counts) // 1000))


def arriving(spark, rows, ts, batches=3):
    """The rows as a stream of files, in order of time: one micro-batch a write, whose files hold at most about ``FILE_ROWS`` rows."""
    path = stage_path(spark, "arriving")
    low, high = rows.agg(F.min(F.unix_seconds(F.col(ts).cast("timestamp"))), F.max(F.unix_seconds(F.col(ts).cast("timestamp")))).first()
    part = F.least(F.floor((F.unix_seconds(F.col(ts).cast("timestamp")) - low) * batches / F.lit(max(high - low, 1))), F.lit(batches - 1))
    files = files_each([r["count"] for r in rows.where(part.isNotNull()).groupBy(part.alias("part")).count().collect()], batches)
    for i in range(batches):
        batch = rows.where(part == i)
        (batch.repartition(files) if files > 1 else batch.coalesce(1)).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def replayed(write):
    """Every batch handled twice, as after a failure between its writes and its commit."""

    def twice(df, batch_id):
        write(df, batch_id)
        write(df, batch_id)

    return twice


CLOSED = "WHERE window_start + INTERVAL 6 HOURS <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(
    "stream_drift_alerts",
    f"""WITH {WINDOWED}, c AS (SELECT * FROM w {CLOSED}), prev AS (SELECT window_start, lag(window_start) OVER (ORDER BY window_start) AS before FROM (SELECT DISTINCT window_start FROM c)),
a AS (SELECT prev.window_start AS feature, bin, n FROM prev JOIN c ON c.window_start = prev.before), b AS (SELECT c.window_start AS feature, bin, n FROM c JOIN prev USING (window_start) WHERE before IS NOT NULL), {DISTANCE}
SELECT feature AS window_start, 'value' AS feature, {sql_rnd('js')} AS distance, CAST(0.01 AS DOUBLE) AS threshold, js > 0.01 AS alert FROM d""",
)
def stream_drift_alerts(spark, sf):
    """Alerts written batch by batch, each batch replayed, equal those of the closed windows taken together."""
    events, limits, folder = table(spark, sf, "events").select("ts", "value"), {"value": 0.01}, stage_path(spark, "alerts")
    edges = stage(D.bin_edges(events, ["value"]), "edges")
    closed = monitor.window_histograms(arriving(spark, events, "ts"), "ts", ["value"], edges)
    monitor.watch(closed, folder, limits, writer=replayed(monitor.alert_writer(folder, limits))).awaitTermination()
    out = monitor.read_alerts(spark, folder)
    return out.withColumns({"distance": rnd(F.col("distance")), "window_start": F.col("window_start").cast("timestamp_ntz")})


@query(
    "stream_attribution_alerts",
    f"""{merged_sql('events')}, cut AS (SELECT quantile_disc(sec, 0.7) AS q FROM merged), served AS (SELECT sec FROM merged, cut WHERE sec >= q),
w AS (SELECT DISTINCT sec // 21600 * 21600 AS h FROM served WHERE sec // 21600 * 21600 + 21600 <= (SELECT max(sec) - 3600 FROM served)),
steps AS (SELECT h, lag(h) OVER (ORDER BY h) AS before FROM w) SELECT CAST(h AS BIGINT) AS window_epoch, feature, threshold, TRUE AS as_batch FROM steps CROSS JOIN ({LIMITS}) WHERE before IS NOT NULL""",
)
def stream_attribution_alerts(spark, sf):
    """Alerts on the monitored features' attributions in a live stream, each batch replayed, against those of the whole table."""
    rows = assign_split(stage(P.build_features(*inputs(spark, sf, "events")), "features"))
    served = rows.where("split <> 'training'").withColumn("at", F.timestamp_seconds(EPOCH)).drop(TARGET, "split")
    model, folder = explained_model(rows.where("split = 'training'"), "logistic_regression"), stage_path(spark, "alerts")
    closed = A.window_attributions(model, arriving(spark, served, "at"), "at")
    monitor.watch(closed, folder, MONITORED, writer=replayed(monitor.alert_writer(folder, MONITORED, A.share_steps))).awaitTermination()
    batch = A.attribution_drift(model, served, "at", MONITORED).select("window_start", "feature", F.col("distance").alias("_batch"))
    both = monitor.read_alerts(spark, folder).join(batch, ["window_start", "feature"], "left")
    same = F.coalesce(F.abs(F.col("distance") - F.col("_batch")) < 1e-9, F.lit(False))
    return both.select(F.unix_seconds("window_start").alias("window_epoch"), "feature", "threshold", same.alias("as_batch"))


LABEL_GRACE, LATE = 21600, 3607  # seconds: how long after the delay a label may come, and how late any record may be


@query(
    "stream_labelled_log",
    f"""{merged_sql('events')}, served AS (SELECT transaction_id, sec, amount, is_fraud, transaction_id % 10 = 0 AS silent FROM merged), newest AS (SELECT max(sec) - {LATE} AS mark FROM served)
SELECT transaction_id, {sql_rnd('amount')} AS amount, CAST(CASE WHEN NOT silent THEN is_fraud END AS INTEGER) AS label, TRUE AS scored_as_batch
FROM served, newest WHERE NOT silent OR sec + 7 * 86400 + {LABEL_GRACE} < mark""",
)
def stream_labelled_log(spark, sf):
    """Requests, scores and labels that settle seven days later in one log; every tenth label never comes."""
    rows = assign_split(stage(P.build_features(*inputs(spark, sf, "events")), "features"))
    model, _ = M.train("logistic_regression", rows.where("split = 'training'"), FEATURES)
    requests, labels = stage_path(spark, "requests"), stage_path(spark, "labels")
    timed = rows.withColumn("requested_at", F.timestamp_seconds(EPOCH)).drop("split", EPOCH)
    timed.drop(TARGET).write.parquet(requests)
    lag = F.make_dt_interval(F.lit(7), F.lit(0), F.lit(0), F.pmod(F.col(ROW_ID), F.lit(LABEL_GRACE)))
    settled = timed.where(F.col(ROW_ID) % 10 != 0).select(ROW_ID, (F.col("requested_at") + lag).alias("settled_at"), F.col(TARGET).cast("int").alias("label"))
    settled.write.parquet(labels)
    requests_, labels_ = (spark.readStream.schema(df.schema).parquet(path) for df, path in ((timed.drop(TARGET), requests), (settled, labels)))
    out = scoring.labelled_log(requests_, labels_, model, ROW_ID, "requested_at", "settled_at", 7, f"{LABEL_GRACE} seconds", f"{LATE} seconds")
    path, mark = stage_path(spark, "log"), stage_path(spark, "progress")
    scoring.append_log(out, path, mark).awaitTermination()
    scoring.append_log(out, path, mark).awaitTermination()  # a restart adds nothing
    log = spark.read.schema(out.schema).parquet(path)
    batch = M.score(model, timed, [ROW_ID]).select(F.col(ROW_ID).alias("_id"), F.col("fraud_probability").alias("_p"))
    same = F.coalesce(F.abs(F.col("fraud_probability") - F.col("_p")) < 1e-12, F.lit(False))
    return log.join(batch, F.col(ROW_ID) == F.col("_id"), "left").select(ROW_ID, rnd(F.col("amount")).alias("amount"), "label", same.alias("scored_as_batch"))
