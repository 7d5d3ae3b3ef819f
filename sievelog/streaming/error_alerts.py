"""Error counts per time window on a stream of log rows, and alerts against a baseline."""

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from sievelog.operators.analytics import FLAT_STDDEV, MIN_WINDOWS, score_windows
from sievelog.schema import DEFAULT_WINDOW_MS, DEFAULT_Z
from sievelog.sources.batches import stream_batch, stream_id


def stream_error_counts(
    logs: DataFrame, window: str = "5 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Errors per window once the watermark has passed it: start_ms, end_ms, errors.

    Windows align to the epoch. Rows without a valid timestamp are left out; they would
    count as infinitely late.
    """
    counts = (
        logs.where("ts_valid")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"))
        .agg(F.count_if(F.upper("level") == "ERROR").alias("errors"))
    )
    return counts.select(
        F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"), "errors"
    )


def start_counts(counts: DataFrame, sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append closed windows to a Parquet folder."""
    writer = counts.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def start_alerts(
    counts: DataFrame,
    baseline: DataFrame,
    sink: str,
    checkpoint: str,
    z: float = DEFAULT_Z,
    **trigger,
) -> StreamingQuery:
    """Write windows at or above ``z`` by micro-batch, against a stored one-row baseline.

    Each micro-batch is a folder in a range of numbers that only this stream, known by the id
    in its checkpoint, writes: several streams may share a sink. A computed ``baseline`` would
    be computed again for every micro-batch.
    """
    spark, known = counts.sparkSession, []

    def score(batch: DataFrame, micro_batch: int) -> None:
        if not known:
            known.append(stream_batch(spark, sink, stream_id(spark, checkpoint), 0))
        alerts = score_windows(batch, baseline, z)
        alerts.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={known[0] + micro_batch}")

    writer = counts.writeStream.outputMode("append").foreachBatch(score)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


# ---- a baseline that follows the stream -------------------------------------------

MOVING_SCHEMA = "service STRING, start_ms BIGINT, end_ms BIGINT, errors BIGINT, windows BIGINT, mean DOUBLE, stddev DOUBLE, z DOUBLE"
_STATE = "first BIGINT, sum BIGINT, squares BIGINT"


def service_windows(logs: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """Errors per service and window of a batch of rows; windows without rows have no row."""
    bucket = F.floor(F.col("epoch_ms") / F.lit(window_ms)).alias("bucket")
    return logs.where("ts_valid").groupBy(F.coalesce("service", F.lit("")).alias("service"), bucket).agg(
        F.count_if(F.upper("level") == "ERROR").alias("errors")
    )


def moving_alerts(
    logs: DataFrame, z: float = DEFAULT_Z, window_ms: int = DEFAULT_WINDOW_MS, least: int = MIN_WINDOWS
) -> DataFrame:
    """Windows whose errors lie ``z`` deviations above the service's own windows before, of a table.

    The baseline of a window are all windows from the service's first row up to it, empty
    ones included; it needs ``least`` of them and some spread. Running sums give it in one
    pass over the windows, which are as many as the calendar has, not as there are rows.
    """
    _check_z(z)
    before = Window.partitionBy("service").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = service_windows(logs, window_ms).select(
        "service", "bucket", "errors",
        (F.col("bucket") - F.min("bucket").over(Window.partitionBy("service"))).alias("windows"),
        F.coalesce(F.sum("errors").over(before), F.lit(0)).alias("sum"),
        F.coalesce(F.sum(F.col("errors") * F.col("errors")).over(before), F.lit(0)).alias("squares"),
    )
    n, s = F.col("windows"), F.col("sum").cast("double")
    spread = F.sqrt(F.greatest(F.col("squares") - s * s / n, F.lit(0.0)) / (n - 1))
    scored = counts.where(n >= max(least, 2)).withColumns({"mean": s / n, "stddev": spread}).where(F.col("stddev") >= FLAT_STDDEV)
    scored = scored.withColumn("z", (F.col("errors") - F.col("mean")) / F.col("stddev")).where(F.col("z") >= z)
    start = F.col("bucket") * F.lit(window_ms)
    return scored.select("service", start.alias("start_ms"), (start + window_ms).alias("end_ms"), "errors", "windows", "mean", "stddev", "z")


def _check_z(z: float) -> None:
    if z <= 0:
        raise ValueError("z must be positive: windows without rows are not looked at")


class _Baseline(StatefulProcessor):
    """Per service: bucket of the first window, sum and sum of squares of the errors so far."""

    def __init__(self, z: float, window_ms: int, least: int):
        self.z, self.window_ms, self.least = z, window_ms, least

    def init(self, handle) -> None:
        self.seen = handle.getValueState("baseline", _STATE)

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows)).sort_values("bucket")
        first, total, squares = self.seen.get() if self.seen.exists() else (int(new["bucket"].iloc[0]), 0, 0)
        out = []
        for bucket, errors in zip(new["bucket"].tolist(), new["errors"].tolist(), strict=True):
            n = bucket - first
            if n >= max(self.least, 2):
                mean, spread = total / n, math.sqrt(max(squares - total * total / n, 0.0) / (n - 1))
                if spread >= FLAT_STDDEV and (errors - mean) / spread >= self.z:
                    start = bucket * self.window_ms
                    out.append((key[0], start, start + self.window_ms, errors, n, mean, spread, (errors - mean) / spread))
            total, squares = total + errors, squares + errors * errors
        self.seen.update((first, total, squares))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in MOVING_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


def stream_moving_alerts(
    logs: DataFrame, z: float = DEFAULT_Z, window_ms: int = DEFAULT_WINDOW_MS, delay: str = "10 minutes", least: int = MIN_WINDOWS
) -> DataFrame:
    """:func:`moving_alerts` of a stream: each window is told once, when the watermark has passed it.

    Rows up to ``delay`` late count in their window, which only then joins the baseline; so
    no count in the state has to be taken back. Spark's window aggregation closes windows;
    what follows keeps three numbers a service and sees a row per service and window. Windows
    without rows need no timer: they are the difference of two window numbers. The session
    must use the RocksDB state store, see :func:`use_rocksdb`.
    """
    _check_z(z)
    counts = (
        logs.where("ts_valid")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{window_ms} milliseconds").alias("w"), F.coalesce("service", F.lit("")).alias("service"))
        .agg(F.count_if(F.upper("level") == "ERROR").alias("errors"))
        .select("service", F.floor(F.unix_millis("w.start") / F.lit(window_ms)).alias("bucket"), "errors")
    )
    return counts.groupBy("service").transformWithStateInPandas(_Baseline(z, window_ms, least), MOVING_SCHEMA, "Append", "None")


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Queries started from now on keep their state in RocksDB, which the moving baseline needs."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


def start_moving_alerts(alerts: DataFrame, sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the alerts of :func:`stream_moving_alerts` to a Parquet folder, each once."""
    return start_counts(alerts, sink, checkpoint, **trigger)
