import pytest
from conftest import BASE_MS, as_multiset, make_logs, plan_of
from pyspark.sql import functions as F

import sievelog as sl

MINUTE = 60_000


def series(spark, counts, extra=()):
    """ERROR rows per 5-minute window, and INFO rows that fix the extent."""
    rows = [(-1, 0, "INFO"), (-2, len(counts) * 5 * MINUTE - 1000, "info")]
    for window, n in enumerate(counts):
        rows += [(window * 100 + i, window * 5 * MINUTE + 1000 + i, "Error") for i in range(n)]
    df = spark.createDataFrame(rows, "log_id BIGINT, d BIGINT, level STRING")
    logs = df.select(
        "log_id",
        sl.format_epoch(F.lit(BASE_MS) + F.col("d")).alias("timestamp"),
        (F.lit(BASE_MS) + F.col("d")).alias("epoch_ms"),
        F.timestamp_millis(F.lit(BASE_MS) + F.col("d")).alias("ts"),
        F.lit(True).alias("ts_valid"),
        "level",
        F.lit("API").alias("service"),
        F.lit("m").alias("message"),
    )
    return logs.unionByName(make_logs(spark, list(extra))) if extra else logs


def test_top_k(sample):
    got = [tuple(r) for r in sl.top_k_errors(sample, 3).collect()]
    assert got == [
        ("API: High memory threshold exceeded host_0", 34),
        ("API: Server worker thread started host_5", 34),
        ("Auth: Authentication token expired host_2", 34),
    ]
    counts = [r["count"] for r in sl.top_k_errors(sample, 100).collect()]
    assert counts == [34] * 7 + [33] * 13
    with pytest.raises(ValueError):
        sl.top_k_errors(sample, 0)
    assert "TakeOrderedAndProject" in plan_of(sl.top_k_errors(sample, 3))


def test_anomaly_on_sample(sample):
    alerts, baseline = sl.detect_anomalies(sample)
    assert alerts.count() == 0
    row = baseline.first()
    assert (row.status, row.num_windows, row["mean"], row.stddev) == ("ok", 4, 83.25, 33.5)


def test_spike(spark):
    logs = series(spark, [1, 1, 1, 1, 1, 1, 20, 1, 1, 1, 1, 1])
    alerts, baseline = sl.detect_anomalies(logs)
    row = baseline.first()
    assert row.num_windows == 12
    assert row["mean"] == pytest.approx(2.583333, abs=1e-6)
    assert row.stddev == pytest.approx(5.484828, abs=1e-6)
    (alert,) = alerts.collect()
    assert (alert.bucket, alert.errors) == (6, 20)
    assert alert.start_ms == BASE_MS + 30 * MINUTE and alert.end_ms == BASE_MS + 35 * MINUTE
    assert alert.z == pytest.approx(3.175426, abs=1e-6)


def test_five_windows_never_alert(spark):
    alerts, _ = sl.detect_anomalies(series(spark, [1, 1, 50, 1, 1]))
    assert alerts.count() == 0
    alerts, _ = sl.detect_anomalies(series(spark, [1, 1, 50, 1, 1]), z=1.7)
    assert [round(r.z, 6) for r in alerts.collect()] == [1.788854]


def test_flat_and_insufficient(spark):
    alerts, baseline = sl.detect_anomalies(series(spark, [2] * 6))
    assert baseline.first().status == "flat" and alerts.count() == 0
    alerts, baseline = sl.detect_anomalies(series(spark, [2, 3]))
    assert baseline.first().status == "insufficient" and alerts.count() == 0
    alerts, baseline = sl.detect_anomalies(series(spark, [0]).where("level = 'none'"))
    assert baseline.first().status == "insufficient" and alerts.count() == 0


def test_no_errors_at_all(spark):
    logs = make_logs(spark, [(i, "2024-01-01 00:00:00", "INFO", "API", "m") for i in range(12)])
    alerts, baseline = sl.detect_anomalies(logs)
    row = baseline.first()
    assert (row.status, row.num_windows, row["mean"]) == ("flat", 3, 0.0)


def test_one_window_is_padded_to_three(spark):
    alerts, baseline = sl.detect_anomalies(series(spark, [12]))
    row = baseline.first()
    assert (row.num_windows, row["mean"]) == (3, 4.0)
    assert row.stddev == pytest.approx(6.928203, abs=1e-6)


def test_epoch_zero_row_stretches_the_baseline(spark):
    bad = [(999, "bad time", "INFO", "API", "m")]
    logs = series(spark, [1, 1, 1, 1, 1, 1, 20, 1, 1, 1, 1, 1], bad)
    alerts, baseline = sl.detect_anomalies(logs)
    assert baseline.first().num_windows == 5_680_236
    assert alerts.count() == 12
    alerts, baseline = sl.detect_anomalies(logs, valid_only=True)
    assert baseline.first().num_windows == 12 and alerts.count() == 1


def test_closed_form_equals_the_dense_windows(messy):
    logs = messy.where("ts_valid")
    width = 3_600_000
    extent = sl.time_extent(logs).first()
    n = max(3, (extent.max_ms - extent.min_ms) // width + 1)
    counts = [0] * n
    for r in logs.where("upper(level) = 'ERROR'").collect():
        counts[(r.epoch_ms - extent.min_ms) // width] += 1
    mean = sum(counts) / n
    sd = (sum((c - mean) ** 2 for c in counts) / (n - 1)) ** 0.5
    row = sl.error_baseline(logs, width).first()
    assert (row.num_windows, row["mean"]) == (n, pytest.approx(mean))
    assert row.stddev == pytest.approx(sd)
    alerts, _ = sl.detect_anomalies(logs, z=-100.0, window_ms=width)
    assert [r.errors for r in alerts.orderBy("bucket").collect()] == counts


def test_templates(sample):
    got = {r.template: r["count"] for r in sl.template_counts(sample, limit=None).collect()}
    assert got == {
        "Connection failed to replica <*>": 166,
        "Connection timeout on port <*> <*>": 167,
        "Authentication token expired <*>": 167,
        "Payment transaction completed <*>": 167,
        "High memory threshold exceeded <*>": 167,
        "Server worker thread started <*>": 166,
    }
    assert sl.template_counts(sample).count() == 5


def test_shard_load(spark, sample):
    got = [tuple(r) for r in sl.shard_load(sample, 3).orderBy("shard").collect()]
    assert got == [(0, 333, 33.3), (1, 333, 33.3), (2, 334, 33.4)]
    empty = sl.shard_load(sample.where("log_id = 100001"), 3).orderBy("shard").collect()
    assert [r.records for r in empty] == [0, 0, 1]
    none = sl.shard_load(sample.where("log_id < 0"), 2).collect()
    assert [(r.records, r.pct) for r in none] == [(0, 0.0), (0, 0.0)]


def test_sample_source(spark, sample):
    first = sample.orderBy("log_id").first()
    assert (first.log_id, first.timestamp, first.level, first.service) == (
        100001,
        "2024-01-01 00:00:01",
        "WARN",
        "Database",
    )
    assert first.message == "Connection timeout on port 5432 host_1"
    assert sl.row_count(sample).first()["records"] == 1000
    assert as_multiset(sl.sample_logs(spark, 1000, BASE_MS)) == as_multiset(sample)
