"""Streams over several files and micro-batches against the batch operators."""

import tempfile

import pytest
from pyspark.sql import Window, functions as F

from creditspark.operators import alerts as AL
from creditspark.plans.fixtures import metric_events, table
from creditspark.session import fresh_dir
from creditspark.streaming import alarm as SA, drift as SD, labels as SL, monitor as SM, score as SS, sink as SK
from creditspark.streaming.run import append_available, file_sink, keyed_state, play, run_available, run_batches, timed_files


@pytest.fixture
def pieces(spark, sf):
    """The events in time order, as several files read one per micro-batch."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/events"
    events = table(spark, sf, "events").orderBy("ts")
    bounds = [0, 0.3, 0.6, 1.01]
    ranked = events.withColumn("r", F.percent_rank().over(Window.orderBy("ts")))
    for lo, hi in zip(bounds, bounds[1:]):
        ranked.filter((F.col("r") >= lo) & (F.col("r") < hi)).drop("r").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_volume_over_batches(spark, sf, pieces):
    batch = SM.prediction_volume(metric_events(table(spark, sf, "events")))
    stream = run_available(SM.prediction_volume(metric_events(pieces)), "volume")
    assert stream.exceptAll(batch).isEmpty()
    last = table(spark, sf, "events").agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(last) - F.expr("INTERVAL 10 MINUTES"))
    assert closed.exceptAll(stream).isEmpty()


def test_alarms_across_batches(spark, sf, pieces):
    rule = AL.AlarmRule("avg", "above", 60.0, 2, 3600)
    rows = pieces.select(F.col("event_type").alias("metric"), F.col("ts").cast("timestamp").alias("ts"), "value")
    path = append_available(SA.bucket_values(rows, rule), "buckets")
    schema = "metric string, period timestamp, value double"
    buckets = spark.readStream.schema(schema).parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    stream = run_available(SA.alarm_stream(buckets, rule), "alarms", keyed=True)
    batch = AL.alarm_transitions(AL.alarm_intervals(stored.withColumn("period", F.col("period").cast("timestamp_ntz")), rule))
    assert stream.count() > 0
    assert stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty()


def test_a_silent_metric_returns_to_ok(spark):
    """One metric breaches and falls silent; another one shows that time goes on."""
    rule = AL.AlarmRule("max", "above", 10.0, 2, 3600)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/buckets"
    hours = [[("a", 1, 50.0), ("b", 1, 0.0)], [("a", 2, 50.0), ("b", 2, 0.0)], [("b", 3, 0.0)], [("b", 4, 99.0), ("b", 5, 99.0)]]
    schema = "metric string, period timestamp, value double"
    for rows in hours:
        part = spark.createDataFrame(rows, "metric string, h int, value double")
        part.selectExpr("metric", "make_timestamp(2024, 1, 1, h, 0, 0) AS period", "value").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = sorted((r.metric, r.at.hour, r.state) for r in run_available(SA.alarm_stream(stream, rule), "alarms", keyed=True).collect())
    assert got == [("a", 2, "ALARM"), ("a", 3, "OK"), ("b", 5, "ALARM")]
    stored = spark.read.schema(schema).parquet(folder).withColumn("period", F.col("period").cast("timestamp_ntz"))
    batch = AL.alarm_transitions(AL.alarm_intervals(stored, rule)).collect()
    assert sorted((r.metric, r.at.hour, r.state) for r in batch) == got


def test_a_silent_model_leaves_no_state_and_starts_anew(spark):
    """Model a falls silent for longer than the cool-down and returns; b shows that time goes on."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/hours"
    batches = [[("a", 0, 60, True), ("a", 1, 60, True), ("b", 0, 1, False)], [("b", 5, 1, False)], [("b", 12, 1, False)]]
    batches += [[("a", 13, 60, True), ("b", 13, 1, False)], [("a", 14, 60, True)], [("b", 40, 1, False)], [("b", 41, 1, False)]]
    schema = "model string, hour timestamp, n_rows long, critical boolean"
    for rows in batches:
        part = spark.createDataFrame(rows, "model string, h int, n_rows long, critical boolean")
        hour = "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, h) AS hour"
        part.selectExpr("model", hour, "n_rows", "critical").coalesce(1).write.mode("append").parquet(folder)
    hours = spark.read.schema(schema).parquet(folder).withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    for forget, want in [(None, [1, 13]), (6, [1, 14])]:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        out, state = fresh_dir(spark, "signals"), fresh_dir(spark, "signals-state")
        with keyed_state(spark):
            query = file_sink(SA.retrain_stream(stream, 100, 4, forget), out, state).trigger(availableNow=True).start()
        query.awaitTermination()
        got = spark.read.parquet(out)
        assert sorted((r.model, r.signal_at.hour) for r in got.collect()) == [("a", h) for h in want]
        batch = AL.retrain_signals(hours, 100, 4, forget)
        assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
        left = spark.read.format("statestore").option("path", state).option("stateVarName", "value").load()
        assert {r.key[0] for r in left.select("key").collect()} == ({"a", "b"} if forget is None else {"b"})
    with pytest.raises(ValueError):
        AL.retrain_signals(hours, 100, 4, 3)


def test_played_back_streams_give_all_buckets(spark, sf):
    events = table(spark, sf, "events")
    stream = SM.error_rate(metric_events(play(spark, timed_files(events, "ts", "events"), events.schema)))
    batch = SM.error_rate(metric_events(events))
    got = run_available(stream, "rates")
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert timed_files(events.limit(0), "ts", "none")


def test_stream_quantile_state_names_a_bucket_by_one_time(spark, sf):
    """Missing and equal values, buckets of none and rows without a time; those with values against the batch."""
    events = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    events = events.withColumn("value", F.when((F.col("event_id") % 3 != 0) & (F.hour("ts") != 5), F.round("value")))
    stream = SM.latency(metric_events(play(spark, timed_files(events, "ts", "events"), events.schema)))
    path, state = fresh_dir(spark, "latency"), fresh_dir(spark, "latency-state")
    query = file_sink(stream, path, state).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.window_start: (r.n, r.avg_latency, r.p99_latency) for r in spark.read.schema(stream.schema).parquet(path).collect()}
    want = {r.window_start: (r.n, r.avg_latency, r.p99_latency) for r in SM.latency(metric_events(events)).collect()}
    assert want and {k: v for k, v in got.items() if v[0]} == {k: (n, pytest.approx(mean), pytest.approx(q)) for k, (n, mean, q) in want.items()}
    empty = events.where("ts is not null").groupBy(F.window("ts", "5 minutes")["start"].alias("w")).agg(F.count("value").alias("n")).where("n = 0")
    assert {k: v for k, v in got.items() if not v[0]} == {r.w: (0, None, None) for r in empty.collect()} != {}
    keys = [spark.read.format("statestore").option("path", state).option("operatorId", k).load().schema["key"].dataType for k in (0, 1)]
    assert sorted([f.dataType.simpleString() for f in key.fields] for key in keys) == [["timestamp"], ["timestamp", "double"]]


def test_join_over_batches(spark, sf, pieces):
    def sides(ev):
        ev = metric_events(ev)
        return (
            ev.filter("event_type = 'view'").select(F.col("event_id").alias("p"), "user_id", "ts"),
            ev.filter("event_type = 'purchase'").select(F.col("event_id").alias("l"), "user_id", F.col("ts").alias("label_ts")),
        )

    stream = run_available(SL.label_join(*sides(pieces), "user_id", "3 DAYS", "9 DAYS", salts=3), "join")
    batch = SL.label_join(*sides(table(spark, sf, "events")), "user_id", "3 DAYS", "9 DAYS")
    assert stream.select("p", "l").exceptAll(batch.select("p", "l")).isEmpty()
    assert batch.select("p", "l").exceptAll(stream.select("p", "l")).isEmpty()


def test_live_auc_over_batches(spark, sf, pieces):
    from creditspark.operators.curve import rank_metrics

    def rows(ev):
        return metric_events(ev).select(F.to_date("ts").alias("day"), "probability", F.col("is_error").cast("int").alias("y"))

    store, out = fresh_dir(spark, "counts"), fresh_dir(spark, "auc")
    SL.live_auc_stream(rows(pieces), ["day"], "probability", "y", store, out)
    got = {r.day: (r.live_auc, r.n_labeled) for r in SL.current_auc(spark, out, ["day"]).collect()}
    want = {r.day: (r.auc_roc, r.n_samples) for r in rank_metrics(rows(table(spark, sf, "events")), "probability", "y", ["day"]).collect()}
    assert set(got) == set(want)
    for day, (auc, n) in want.items():
        assert got[day][1] == n and got[day][0] == (pytest.approx(auc) if auc is not None else None)


def test_shared_dir_is_required_on_a_cluster(spark, monkeypatch):
    from creditspark import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Fake:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_played_stretches_keep_rows_without_a_time(spark, sf):
    """Every row of the table is played once, null times with the first stretch, in batches of one stretch."""
    events = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    played = timed_files(events.repartition(3), "ts", "events", parts=4, files=3)
    seen = []
    run_batches(play(spark, played, events.schema), lambda batch, n: seen.append((n, batch.count(), batch.agg(F.min("ts"), F.max("ts")).first())), "seen")
    assert len(seen) == 5 and sum(n for _, n, _ in seen) == events.count() + 1
    assert all(a[2][1] <= b[2][0] for a, b in zip(seen, seen[1:])) and seen[-1][1] == 1


def test_stretches_with_few_rows_are_filled_up(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 100)], "k int, day int").selectExpr("k", "timestamp_seconds(day * 86400) AS ts")
    played = timed_files(rows, "ts", "few", parts=3, files=4)
    seen = []
    run_batches(play(spark, played, rows.schema), lambda batch, n: seen.append(sorted(r.k or 0 for r in batch.collect())), "seen")
    assert seen == [[1, 2], [], [3], [0]]


def test_hourly_psi_in_batch_and_stream(spark, pieces, sf):
    import math

    features = ["latency_ms", "probability", "empty", "constant"]

    def rows(ev):
        return metric_events(ev).withColumn("empty", F.lit(None).cast("double")).withColumn("constant", F.lit(3.0))

    batch_rows = rows(table(spark, sf, "events"))
    path = fresh_dir(spark, "histogram")
    SD.save_histogram(SD.reference_histogram(batch_rows.where("user_id % 2 = 0"), features, 5), path)
    histogram = SD.load_histogram(spark, path)
    assert {r.feature: sum(r.counts) for r in histogram.collect()} == {f: batch_rows.where("user_id % 2 = 0").count() for f in ("latency_ms", "probability", "constant")}
    batch = SD.psi_by_time(batch_rows, histogram, features)
    stream = run_available(SD.psi_by_time(rows(pieces), histogram, features), "psi")
    last = batch.agg(F.max("window_start")).first()[0]
    want = {(r.window_start, r.feature): (r.n, r.psi) for r in batch.collect()}
    got = {(r.window_start, r.feature): (r.n, r.psi) for r in stream.collect()}
    assert got and all(want[k] == pytest.approx(v) for k, v in got.items())
    assert all(k in got for k in want if (last - k[0]).total_seconds() > 2 * 3600)
    # one hour by hand
    h = {r.feature: r for r in histogram.collect()}["latency_ms"]
    hour = next(w for w, f in want if f == "latency_ms")
    values = [r.latency_ms for r in batch_rows.where(F.date_trunc("hour", "ts") == F.lit(hour)).collect()]
    current = [0] * 5
    for v in values:
        current[min(max(math.floor((v - h.low) / h.step), 0), 4)] += 1
    psi = 0.0
    for r, c in zip(h.counts, current):
        r, c = (r + 1e-4) / (sum(h.counts) + 5e-4), (c + 1e-4) / (len(values) + 5e-4)
        psi += (c - r) * math.log(c / r)
    assert want[hour, "latency_ms"] == (len(values), pytest.approx(psi))
    assert all(v[1] < 1e-3 for (_, f), v in want.items() if f == "constant")  # the smoothing term only


def test_hourly_psi_has_one_state_row_a_bucket_and_feature(spark, sf):
    """Missing, NaN and far values, rows without a time, features of different bins and of none, against the batch."""
    features = ["latency_ms", "probability", "constant", "unknown"]

    def rows(ev):
        n = F.col("event_id")
        odd = F.when(n % 7 == 0, None).when(n % 11 == 0, float("nan")).when(n % 13 == 0, 1e9).when(n % 17 == 0, -5.0)
        odd = F.when((n % 7 == 0) | (n % 11 == 0) | (n % 13 == 0) | (n % 17 == 0), odd).otherwise(F.col("latency_ms"))
        return metric_events(ev).withColumns({"latency_ms": odd, "constant": F.lit(3.0), "unknown": F.lit(1.0)})

    events = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    plain = metric_events(events).withColumn("constant", F.lit(3.0))
    histogram = SD.reference_histogram(plain, ["latency_ms", "constant"], 4).unionByName(SD.reference_histogram(plain, ["probability"], 7)).localCheckpoint()
    played = timed_files(events, "ts", "events")
    for known in (histogram, histogram.limit(0)):
        stream = SD.psi_by_time(rows(play(spark, played, events.schema)), known, features)
        path, state = fresh_dir(spark, "psi"), fresh_dir(spark, "psi-state")
        query = file_sink(stream, path, state).trigger(availableNow=True).start()
        query.awaitTermination()
        want = {(r.window_start, r.feature): (r.n, r.psi) for r in SD.psi_by_time(rows(events), known, features).collect()}
        got = {(r.window_start, r.feature): (r.n, r.psi) for r in spark.read.schema(stream.schema).parquet(path).collect()}
        # the closing row, a day behind the others, has a constant too, but its bucket stays open
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())
        assert len(got) > 0 or known is not histogram
        assert {len(p.stateOperators) for p in query.recentProgress} == {1}


def test_few_keys_take_few_state_partitions(spark):
    """An alarm over two metrics has two state partitions, not as many as the session's, and the same transitions."""
    rule = AL.AlarmRule("max", "above", 10.0, 1, 3600)
    folder = fresh_dir(spark, "buckets")
    spark.createDataFrame([(m, h, 50.0 * (h % 3)) for m in "ab" for h in range(9)], "metric string, h int, value double").selectExpr(
        "metric", "make_timestamp(2024, 1, 1, h, 0, 0) AS period", "value"
    ).write.parquet(folder)
    schema, before = "metric string, period timestamp, value double", spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for keys in (None, 2, 1000):
        stream = SA.alarm_stream(spark.readStream.schema(schema).parquet(folder), rule)
        path, state = fresh_dir(spark, "alarms"), fresh_dir(spark, "alarms-state")
        with keyed_state(spark, keys):
            query = file_sink(stream, path, state).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert {o.numShufflePartitions for p in query.recentProgress for o in p.stateOperators} == {min(keys or int(before), int(before))}
        found.append(sorted(map(tuple, spark.read.parquet(path).collect())))
    assert found[0] and found[0] == found[1] == found[2]


def test_live_auc_store_does_not_grow_with_age(spark, sf):
    rows = metric_events(table(spark, sf, "events")).select(F.lit("a").alias("g"), "event_id", "probability", F.col("is_error").cast("int").alias("y"))
    folder = fresh_dir(spark, "rows")
    for k in range(6):
        rows.where(F.col("event_id") % 6 == k).coalesce(1).write.mode("append").parquet(folder)
    store, out = fresh_dir(spark, "counts"), fresh_dir(spark, "auc")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    SL.live_auc_stream(stream, ["g"], "probability", "y", store, out)
    versions = SL.group_folders(spark, store)["g=a"]
    assert sorted(versions) == [4, 5]  # the newest, and the one before for a repeated batch
    from creditspark.operators.curve import rank_metrics

    want = rank_metrics(rows, "probability", "y", ["g"]).first()
    got = SL.current_auc(spark, out, ["g"]).first()
    assert (got.live_auc, got.n_labeled) == (pytest.approx(want.auc_roc), want.n_samples)


def test_metric_table_is_the_same_after_a_repeated_batch(spark, sf):
    events = metric_events(table(spark, sf, "events"))
    path = fresh_dir(spark, "metrics")
    histogram = SD.reference_histogram(events, ["probability"])
    rows = SK.batch_metrics(events, histogram, ["probability"], "is_error")
    for batch_id in (0, 1, 1):
        SK.write_metrics(rows.where(F.col("metric") != "PSI") if batch_id == 0 else rows, path, batch_id)
    stored = SK.read_metrics(spark, path)
    per_batch = {(r.batch, r.metric): r.n for r in stored.groupBy("batch", "metric").agg(F.count("*").alias("n")).collect()}
    hours = events.select(F.date_trunc("hour", "ts")).distinct().count()
    assert per_batch[1, "PSI"] == hours and per_batch[1, "LiveAUC"] == 1 and (0, "PSI") not in per_batch
    assert all(per_batch[b, m] == events.count() for b in (0, 1) for m in ("PredictionCount", "PredictionLatency", "DefaultProbability"))


def test_champion_changes_between_micro_batches(spark):
    from creditspark.operators import model as MO, split as SP
    from creditspark.sources import generate as G

    loans = SP.hash_split(G.generate_loans(spark.range(1, 801), "id")).cache()
    models = {v: MO.train(loans, {"n_estimators": n, "max_depth": 2}) for v, n in (("one", 2), ("two", 5))}
    registry, folder, out = (fresh_dir(spark, n) for n in ("registry", "arriving", "scored"))
    for v, m in models.items():
        MO.save_model(*m, f"{registry}-{v}")
    SS.publish(spark, registry, 1, "one", f"{registry}-one")
    for k in range(2):
        loans.where(F.col("num_open_accounts") % 2 == k).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(loans.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    step = SS.score_stream

    def scored_then_published(batch, features, model, version, *rest):
        SS.publish(spark, registry, 2, "two", f"{registry}-two")  # a new champion while a batch is scored
        return step(batch, features, model, version, *rest)

    SS.score_stream = scored_then_published
    try:
        SS.score_by_champion(stream, registry, out)
    finally:
        SS.score_stream = step
    got = spark.read.parquet(out)
    assert [r.model_version for r in got.groupBy("batch", "model_version").count().orderBy("batch").collect()] == ["one", "two"]
    for k, v in enumerate(models):
        want = step(loans.where(F.col("num_open_accounts") % 2 == k), *models[v], v)
        assert got.where(F.col("batch") == k).select(*want.columns).exceptAll(want).isEmpty()
    assert got.count() == 800
