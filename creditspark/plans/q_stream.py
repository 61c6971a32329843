"""Time buckets and streams; every stream has a batch twin or equivalent SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.functions.numeric import round_half_even as R
from creditspark.operators import alerts as AL, explain as E, model as MO, scoring as SC, split as SP
from creditspark.plans.fixtures import ctes, loans, metric_events, table
from creditspark.plans.q_drift import PSI_FEATURES, PSI_HOUR, psi_histogram
from creditspark.plans.q_metrics import r6
from creditspark.plans.q_model import DECLARED as GBT, INTERCEPT, LIN, LINEAR, _MARGIN, split_loans
from creditspark.plans.q_monitor import ALARM, ALARM_SQL, TRANSITIONS, _declared_sql, alarm_rows, hourly_auc
from creditspark.plans.registry import query
from creditspark.session import fresh_dir
from creditspark.sources.tables import dated_log, read_predictions
from creditspark.streaming import alarm as SA, drift as SD, labels as SL, monitor as SM, score as SS, sink as SK
from creditspark.streaming.run import append_available, follow, play, run_available, stream_table, timed_files

def batch_events(spark, sf):
    return metric_events(table(spark, sf, "events"))


def stream_events(spark, sf):
    return metric_events(stream_table(spark, f"{sf}/events.parquet"))


def played_raw(spark, sf):
    """The events in time order, over several micro-batches, with the tail flushed."""
    events = table(spark, sf, "events")
    return play(spark, timed_files(events, "ts", "events"), events.schema)


def played_events(spark, sf):
    return metric_events(played_raw(spark, sf))


def rounded(df, *cols):
    return df.withColumns({c: R(F.col(c), 6) for c in cols})


def both(name: str, sql: str, build):
    """Register the batch query and its streaming twin: the same rows."""
    query(name, sql)(lambda spark, sf: build(batch_events(spark, sf)))
    query(f"{name}_stream", sql)(lambda spark, sf: run_available(build(played_events(spark, sf)), name))


EV = ctes("metric_events")
both(
    "prediction_volume_5m",
    EV + """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, decision, risk_tier, count(*) AS n_predictions
    FROM metric_events GROUP BY 1, 2, 3""",
    SM.prediction_volume,
)
both(
    "latency_5m",
    EV + f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n, {r6('avg(latency_ms)')} AS avg_latency,
    {r6('quantile_cont(latency_ms, 99e-2)')} AS p99_latency FROM metric_events GROUP BY 1""",
    lambda ev: rounded(SM.latency(ev), "avg_latency", "p99_latency"),
)
both(
    "probability_5m",
    EV + f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n, {r6('avg(probability)')} AS avg_probability,
    {r6('quantile_cont(probability, 95e-2)')} AS p95_probability FROM metric_events GROUP BY 1""",
    lambda ev: rounded(SM.probability(ev), "avg_probability", "p95_probability"),
)
both(
    "hourly_metric_max_avg",
    f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type AS metric, max(value) AS max_value, {r6('avg(value)')} AS avg_value
    FROM events GROUP BY 1, 2""",
    lambda ev: rounded(
        SM.hourly_metrics(ev.select("ts", F.col("event_type").alias("metric"), F.col("latency_ms").alias("value"))), "avg_value"
    ),
)
both(
    "error_rate_1m",
    EV + f"""SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, count(*) FILTER (WHERE is_error) AS errors, count(*) FILTER (WHERE NOT is_error) AS requests,
    {r6('1e2 * count(*) FILTER (WHERE is_error) / greatest(count(*) FILTER (WHERE is_error), count(*) FILTER (WHERE NOT is_error))')} AS error_rate
    FROM metric_events GROUP BY 1""",
    lambda ev: rounded(SM.error_rate(ev), "error_rate"),
)

JOIN_SQL = """SELECT p.event_id AS prediction_id, l.event_id AS label_id, p.user_id, p.ts AS predicted_at, l.ts AS labeled_at
    FROM events p JOIN events l ON p.user_id = l.user_id AND l.ts BETWEEN p.ts + INTERVAL 3 DAY AND p.ts + INTERVAL 9 DAY
    WHERE p.event_type = 'view' AND l.event_type = 'purchase'"""


def _sides(ev, closing=False):
    """Predictions and labels; ``closing``: each with the row that ends a played stream, whose ids are null.

    A row without the key of the join would be filtered out before it moves the watermark, so that row gets one.
    """
    def of(kind):
        own = F.col("event_type") == kind
        if not closing:
            return ev.filter(own)
        return ev.filter(own | F.col("event_id").isNull()).withColumn("user_id", F.coalesce("user_id", F.lit(-1)))

    predictions = of("view").select(F.col("event_id").alias("prediction_id"), "user_id", "ts")
    feed = of("purchase").select(F.col("event_id").alias("label_id"), "user_id", F.col("ts").alias("label_ts"))
    return predictions, feed


def _joined(left, right, how="inner"):
    out = SL.label_join(left, right, "user_id", "3 DAYS", "9 DAYS", how)
    return out.select(
        "prediction_id",
        "label_id",
        "user_id",
        F.col("ts").cast("timestamp_ntz").alias("predicted_at"),
        F.col("label_ts").cast("timestamp_ntz").alias("labeled_at"),
    )


@query("stream_label_join_batch", JOIN_SQL)
def _(spark, sf):
    return _joined(*_sides(batch_events(spark, sf)))


@query("stream_label_join", JOIN_SQL)
def _(spark, sf):
    return run_available(_joined(_sides(stream_events(spark, sf))[0], _sides(stream_events(spark, sf))[1]), "label-join")


LEFT_SQL = JOIN_SQL.replace("FROM events p JOIN events l ON", "FROM events p LEFT JOIN events l ON l.event_type = 'purchase' AND").replace(
    " AND l.event_type = 'purchase'", ""
)


@query("stream_label_join_left_batch", LEFT_SQL)
def _(spark, sf):
    return _joined(*_sides(batch_events(spark, sf)), "left")


@query("stream_label_join_left", LEFT_SQL)
def _(spark, sf):
    """Unmatched predictions come out when the watermark passes the last time a label could count."""
    events = table(spark, sf, "events")
    played = timed_files(events, "ts", "events", close_after="30 days")
    sides = [_sides(metric_events(play(spark, played, events.schema)), closing=True)[k] for k in (0, 1)]
    return run_available(_joined(*sides, "left"), "label-join-left").where("prediction_id is not null")


@query(
    "stream_consecutive_alarm",
    "WITH " + ALARM_SQL.strip() + TRANSITIONS,
)
def _(spark, sf):
    rows = alarm_rows(played_raw(spark, sf)).withColumn("ts", F.col("ts").cast("timestamp"))
    buckets = follow(SA.bucket_values(rows, ALARM), "buckets")
    return run_available(SA.alarm_stream(buckets, ALARM), "alarms", keyed=True)


@query(
    "retrain_signal_stream",
    """WITH RECURSIVE hourly AS (SELECT event_type AS model, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n_rows, max(value) > 200 AS critical
      FROM events GROUP BY 1, 2),
    seen AS (SELECT *, sum(n_rows) OVER (PARTITION BY model ORDER BY hour ROWS UNBOUNDED PRECEDING) AS s FROM hourly),
    due AS (SELECT model, hour FROM seen WHERE critical AND s >= 1000),
    sig AS (SELECT model, min(hour) AS h FROM due GROUP BY model
      UNION ALL SELECT sig.model, (SELECT min(hour) FROM due WHERE due.model = sig.model AND due.hour >= sig.h + INTERVAL 24 HOUR) FROM sig WHERE sig.h IS NOT NULL)
    SELECT model, h AS signal_at FROM sig WHERE h IS NOT NULL""",
)
def _(spark, sf):
    rows = played_raw(spark, sf).select(
        F.col("event_type").alias("model"), F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    hourly = follow(SA.hourly_activity(rows, 200.0), "hours")
    return run_available(SA.retrain_stream(hourly), "retrain", keyed=True)


@query(
    "stream_score",
    ctes("loans", extra=LIN + f""",
scored AS (SELECT loan_id, 1 / (1 + exp(-({_MARGIN}))) AS p FROM lin)""")
    + """SELECT s.loan_id, round_even(p * 10000, 0) / 10000 AS default_probability, 'linear' AS model_version,
    'req_' || substr(md5(s.loan_id), 1, 16) AS request_id, l.as_of AS ts, CAST(date_trunc('month', l.as_of) AS DATE) AS dt
    FROM scored s JOIN loans l ON l.loan_id = s.loan_id""",
)
def _(spark, sf):
    train = SP.hash_split(loans(spark, sf)).filter(F.col("split") == "train")
    means = E.baseline_means(train, list(LINEAR))
    arriving = loans(spark, sf, orders=stream_table(spark, f"{sf}/orders.parquet"))
    scored = SC.score_linear(arriving, means, LINEAR, INTERCEPT, carry=("as_of",))
    log = dated_log(SC.as_log_rows(scored, F.col("as_of")), period="month")
    path = append_available(log, "scored-log", ["dt"])
    return read_predictions(spark, path).drop("actual_default")


@query("stream_score_gbt", ctes("loans") + "SELECT loan_id, 'gbt-1' AS model_version, as_of AS ts, TRUE AS as_in_batch FROM loans")
def _(spark, sf):
    """The stream's records, by a stored and reloaded model, next to those of the batch."""
    df = split_loans(spark, sf)
    path = fresh_dir(spark, "model")
    MO.save_model(*MO.train(df, GBT), path)
    features, model = MO.load_model(spark, path)
    arriving = loans(spark, sf, orders=stream_table(spark, f"{sf}/orders.parquet"))
    streamed = run_available(SS.score_stream(arriving, features, model, "gbt-1", carry=("as_of",)), "gbt-scored")
    batch = SS.score_stream(loans(spark, sf), features, model, "gbt-1").select(
        F.col("loan_id").alias("id"), *[F.col(c).alias(f"b_{c}") for c in SCORED]
    )
    same = F.lit(True)
    for c in SCORED:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    return streamed.join(batch, F.col("loan_id") == F.col("id"), "left").select(
        "loan_id", "model_version", F.col("as_of").alias("ts"), same.alias("as_in_batch")
    )


SCORED = ["prediction", "default_probability", "confidence", "risk_tier", "request_id"]

def _psi_both(name, sql, build):
    query(name, sql)(lambda spark, sf: build(batch_events(spark, sf), psi_histogram(spark, sf)))
    query(f"{name}_stream", sql)(lambda spark, sf: run_available(build(played_events(spark, sf), psi_histogram(spark, sf)), name))


_psi_both(
    "hourly_psi",
    ctes("metric_events", extra=PSI_HOUR) + f"SELECT window_start, feature, n, {r6('psi')} AS psi FROM psi_hour",
    lambda ev, hist: rounded(SD.psi_by_time(ev, hist, PSI_FEATURES), "psi"),
)

PSI_ALARM_SQL = _declared_sql("psi_alarms", "SELECT 'psi:' || feature AS metric, window_start AS ts, psi AS value FROM psi_hour", "max", "v > 15e-2", 1, 3600)


@query(
    "psi_alarm_stream",
    ctes("metric_events", extra=PSI_HOUR + "," + PSI_ALARM_SQL)
    + "SELECT metric, alarm_at AS at, 'ALARM' AS state FROM psi_alarms UNION ALL SELECT metric, ok_at, 'OK' FROM psi_alarms WHERE ok_at IS NOT NULL",
)
def _(spark, sf):
    """PSI by the hour, its alarm and the return to OK, as streams one after the other."""
    hours = SD.psi_by_time(played_events(spark, sf), psi_histogram(spark, sf), PSI_FEATURES)
    # the hours a micro-batch completes go to one file a metric, as the alarm's state reads them; a feature is a metric
    rows = hours.select(
        F.concat(F.lit("psi:"), F.col("feature")).alias("metric"), F.col("window_start").cast("timestamp").alias("period"), F.col("psi").alias("value")
    ).repartition(len(PSI_FEATURES), "metric")
    return run_available(SA.alarm_stream(follow(rows, "psi-hours"), AL.PSI_ALARM), "psi-alarms", keyed=True, keys=len(PSI_FEATURES))


@query(
    "hourly_monitor_metrics",
    ctes("metric_events", extra=PSI_HOUR + """,
hr AS (SELECT date_trunc('hour', ts) AS hour, is_error AS y, rank() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY probability)
  + (count(*) OVER (PARTITION BY date_trunc('hour', ts), probability) - 1) / 2 AS mr FROM metric_events),
ha AS (SELECT hour, count(*) AS n, count(*) FILTER (WHERE y) AS p, sum(mr) FILTER (WHERE y) AS s FROM hr GROUP BY 1),
mm AS (SELECT 'PSI' AS metric, window_start AS ts, psi AS value FROM psi_hour
  UNION ALL SELECT 'LiveAUC', hour, (s - CAST(p AS DOUBLE) * (p + 1) / 2) / nullif(CAST(p AS DOUBLE) * (n - p), 0) FROM ha)""")
    + f"SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, metric, {r6('max(value)')} AS max_value, {r6('avg(value)')} AS avg_value FROM mm GROUP BY 1, 2",
)
def _(spark, sf):
    """The declared hourly statistics on the metrics they are declared for: PSI over the features, and live AUC."""
    ev = batch_events(spark, sf)
    psi = SD.psi_by_time(ev, psi_histogram(spark, sf), PSI_FEATURES).select(F.lit("PSI").alias("metric"), F.col("window_start").alias("ts"), F.col("psi").alias("value"))
    auc = hourly_auc(ev).select(F.lit("LiveAUC").alias("metric"), "ts", "value")
    return rounded(SM.hourly_metrics(psi.unionByName(auc)), "max_value", "avg_value")


@query(
    "metric_sink_stream",
    ctes("metric_events") + """SELECT 'PredictionCount' AS metric, '{"Decision":"' || decision || '","RiskTier":"' || risk_tier || '"}' AS dims, 1e0 AS value, 'Count' AS unit, ts FROM metric_events
    UNION ALL SELECT 'PredictionLatency', '{}', latency_ms, 'Milliseconds', ts FROM metric_events
    UNION ALL SELECT 'DefaultProbability', '{}', probability, 'None', ts FROM metric_events""",
)
def _(spark, sf):
    """The long metric table that a stream of predictions leaves; the closing row is no prediction."""
    path = fresh_dir(spark, "metric-table")
    SK.emit_metrics(played_events(spark, sf).where("event_id is not null"), path)
    return SK.read_metrics(spark, path).select("metric", F.to_json("dims").alias("dims"), "value", "unit", F.col("ts").cast("timestamp_ntz").alias("ts"))


AUC_DAY = """
dr AS (SELECT CAST(ts AS DATE) AS day, event_type = 'error' AS y, rank() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY probability)
  + (count(*) OVER (PARTITION BY CAST(ts AS DATE), probability) - 1) / 2 AS mr FROM metric_events),
da AS (SELECT day, count(*) AS n, count(*) FILTER (WHERE y) AS p, sum(mr) FILTER (WHERE y) AS s FROM dr GROUP BY 1)"""


@query(
    "live_auc_stream",
    ctes("metric_events", extra=AUC_DAY) + f"""SELECT day, {r6('(s - CAST(p AS DOUBLE) * (p + 1) / 2) / nullif(CAST(p AS DOUBLE) * (n - p), 0)')} AS live_auc,
    n AS n_labeled FROM da""",
)
def _(spark, sf):
    rows = stream_events(spark, sf).select(
        F.to_date("ts").alias("day"), "probability", F.col("is_error").cast("int").alias("y")
    )
    store, out = fresh_dir(spark, "auc-counts"), fresh_dir(spark, "auc")
    SL.live_auc_stream(rows, ["day"], "probability", "y", store, out)
    return rounded(SL.current_auc(spark, out, ["day"]), "live_auc")
