"""A baseline kept in stream state gives the alerts of the same rows as a table, restarts included."""

import random

import pytest
from conftest import make_logs
from pyspark.sql import functions as F

import sievelog as sl
from sievelog import streaming

MINUTE = 60_000


def rows_of(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def logs_of(spark, minutes):
    """Rows of three services, in the order of ``minutes``, with bursts of errors."""
    rng, rows = random.Random(4), []
    for n, m in enumerate(minutes):
        level = "ERROR" if rng.random() < (0.9 if m % 41 == 0 else 0.2) else "INFO"
        for _ in range(12 if m % 41 == 0 else 1):
            rows.append((n, f"2024-01-01 {m // 60:02d}:{m % 60:02d}:{n % 60:02d}", level, rng.choice(["API", "auth", None]), "x"))
    return make_logs(spark, rows + [(1, "bad", "ERROR", "API", "x")])


def brute(logs, z, window_ms, least):
    counts = {}
    for r in logs.collect():
        if r.ts_valid:
            key = (r.service or "", r.epoch_ms // window_ms)
            counts[key] = counts.get(key, 0) + ((r.level or "").upper() == "ERROR")
    out = []
    for (service, bucket), errors in counts.items():
        first = min(b for s, b in counts if s == service)
        past = [counts.get((service, b), 0) for b in range(first, bucket)]
        if len(past) >= least:
            mean = sum(past) / len(past)
            sd = (sum((x - mean) ** 2 for x in past) / (len(past) - 1)) ** 0.5
            if sd >= 0.001 and (errors - mean) / sd >= z:
                out.append((service, bucket * window_ms, (bucket + 1) * window_ms, errors, len(past), round(mean, 6), round(sd, 6), round((errors - mean) / sd, 6)))
    return sorted(out)


def test_moving_baseline_of_a_table(spark):
    logs = logs_of(spark, [m for m in range(0, 700) if m % 7])
    for z, window_ms, least in ((2.0, 5 * MINUTE, 3), (0.5, 7 * MINUTE, 10)):
        want = brute(logs, z, window_ms, least)
        assert len(want) > 3 and rows_of(streaming.moving_alerts(logs, z, window_ms, least)) == want
    assert streaming.moving_alerts(logs.where("false")).count() == 0
    with pytest.raises(ValueError, match="positive"):
        streaming.moving_alerts(logs, 0)


def test_stream_equals_table_over_restarts(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    streaming.use_rocksdb(spark)
    try:
        source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        late = lambda ms: [m + (3 if i % 5 == 0 else 0) - (2 if i % 6 == 0 else 0) for i, m in enumerate(ms)]  # out of order within the delay
        parts = [logs_of(spark, late([m for m in range(a, a + 240) if m % 7])) for a in (10, 250, 490)]
        end = make_logs(spark, [(0, "2024-02-01 00:00:00", "INFO", "end", "x")])
        for part in [*parts, end]:  # a new query, from the same checkpoint, for each
            part.coalesce(1).write.mode("append").parquet(source)
            logs = spark.readStream.schema(sl.LOG_SCHEMA).parquet(source)
            alerts = streaming.stream_moving_alerts(logs, 1.5)
            streaming.start_moving_alerts(alerts, sink, state, availableNow=True).awaitTermination()
        every = parts[0].unionByName(parts[1]).unionByName(parts[2])
        want = rows_of(streaming.moving_alerts(every, 1.5))
        assert len(want) > 3 and rows_of(spark.read.schema(streaming.error_alerts.MOVING_SCHEMA).parquet(sink)) == want
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
