"""Summaries of a log table: frequent errors, error spikes, templates, extent."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelog.functions.text import signature, template
from sievelog.schema import DEFAULT_TEMPLATES, DEFAULT_TOP_K, DEFAULT_WINDOW_MS, DEFAULT_Z
from sievelog.session import materialise

# Fixed values of the spike detector.
MIN_ROWS = 10
MIN_WINDOWS = 3
FLAT_STDDEV = 0.001


def row_count(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count("*").alias("records"))


def time_extent(logs: DataFrame) -> DataFrame:
    """Earliest and latest time of all rows, one row."""
    return logs.agg(F.min("epoch_ms").alias("min_ms"), F.max("epoch_ms").alias("max_ms"))


def top_k_errors(logs: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The ``k`` most frequent ERROR and WARN signatures, ties by signature."""
    if k <= 0:
        raise ValueError("k must be positive")
    errors = logs.where(F.upper("level").isin("ERROR", "WARN"))
    counts = errors.groupBy(
        signature(F.col("service"), F.col("message")).alias("signature")
    ).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "signature").limit(k)


def template_counts(logs: DataFrame, limit: int | None = DEFAULT_TEMPLATES) -> DataFrame:
    """Messages grouped by template, most frequent first; ``limit=None`` gives all."""
    counts = logs.groupBy(template(F.col("message")).alias("template")).agg(
        F.count("*").alias("count")
    )
    ordered = counts.orderBy(F.desc("count"), "template")
    return ordered if limit is None else ordered.limit(limit)


def _extent(logs: DataFrame) -> DataFrame:
    """Minimum, maximum and row count of the table as one struct in one row."""
    return logs.agg(
        F.struct(
            F.min("epoch_ms").alias("lo"),
            F.max("epoch_ms").alias("hi"),
            F.count("*").alias("rows"),
        ).alias("extent")
    )


def _count_windows(logs: DataFrame, anchor: Column, window_ms: int) -> DataFrame:
    errors = logs.where(F.upper("level") == "ERROR").select("epoch_ms", anchor.alias("_lo"))
    bucket = F.expr(f"(epoch_ms - _lo) div {int(window_ms)}L")
    counts = errors.select(bucket.alias("bucket"), "_lo").groupBy("bucket", "_lo")
    return counts.agg(F.count("*").alias("errors")).select(
        "bucket", *_window_bounds(F.col("_lo"), window_ms), "errors"
    )


def _window_bounds(anchor: Column, window_ms: int) -> list[Column]:
    start = anchor + F.col("bucket") * window_ms
    return [start.alias("start_ms"), (start + window_ms).alias("end_ms")]


def error_windows(logs: DataFrame, window_ms: int = DEFAULT_WINDOW_MS) -> DataFrame:
    """ERROR rows per window, windows counted from the earliest row of any level.

    Windows without an error have no row. The anchor is a scalar subquery over one
    column, so no join is needed.
    """
    check_window(window_ms)
    return _count_windows(logs, _extent(logs).scalar().getField("lo"), window_ms)


def check_window(window_ms: int) -> None:
    if window_ms <= 0:
        raise ValueError("window_ms must be positive")


def _baseline(windows: DataFrame, extent: Column, window_ms: int) -> DataFrame:
    """One row of statistics from the windows with errors and the table's extent."""
    total = windows.agg(
        F.count("*").alias("k"),
        F.coalesce(F.sum("errors"), F.lit(0)).cast("double").alias("s"),
        F.coalesce(F.var_pop("errors"), F.lit(0.0)).alias("v"),
    ).select("*", extent.alias("e"))
    total = total.withColumn(
        "n", F.greatest(F.expr(f"(e.hi - e.lo) div {int(window_ms)}L + 1"), F.lit(MIN_WINDOWS))
    )
    # The k windows with errors and the n - k empty ones as two groups: their squared
    # deviations add up, plus one term for the distance of the group means.
    k, n, s = F.col("k"), F.col("n"), F.col("s")
    apart = F.when(k > 0, F.pow(s / F.greatest(k, F.lit(1)), F.lit(2)) * k * (n - k) / n)
    spread = F.sqrt((F.col("v") * k + F.coalesce(apart, F.lit(0.0))) / (n - 1))
    enough = F.col("e.rows") >= MIN_ROWS
    return total.select(
        F.when(~enough, "insufficient")
        .when(spread < FLAT_STDDEV, "flat")
        .otherwise("ok")
        .alias("status"),
        F.when(enough, n).alias("num_windows"),
        F.when(enough, s / n).alias("mean"),
        F.when(enough, spread).alias("stddev"),
    )


def error_baseline(
    logs: DataFrame, window_ms: int = DEFAULT_WINDOW_MS, valid_only: bool = False
) -> DataFrame:
    """Status, window count, mean and sample deviation of errors per window, one row.

    Empty windows count, in closed form: one row of 1970 among rows of today costs
    nothing. ``valid_only`` leaves out rows whose timestamp did not parse.
    """
    logs = logs.where("ts_valid") if valid_only else logs
    return _baseline(error_windows(logs, window_ms), _extent(logs).scalar(), window_ms)


def detect_anomalies(
    logs: DataFrame,
    z: float = DEFAULT_Z,
    window_ms: int = DEFAULT_WINDOW_MS,
    valid_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(alerts, baseline)``: windows whose error count lies ``z`` deviations up or more.

    No alerts unless the baseline status is ``ok``. The logs are read twice, once for
    the extent and once for the windows, which are written out because both results
    need them.
    """
    check_window(window_ms)
    logs = logs.where("ts_valid") if valid_only else logs
    extent = _extent(logs).first()["extent"]
    counted = _count_windows(logs, F.lit(extent["lo"]).cast("bigint"), window_ms)
    return _scored(counted, extent["lo"], extent["hi"], extent["rows"], z, window_ms)


def anomalies_from_counts(
    error_times: DataFrame, lo: int | None, hi: int | None, rows: int, z: float = DEFAULT_Z, window_ms: int = DEFAULT_WINDOW_MS
) -> tuple[DataFrame, DataFrame]:
    """:func:`detect_anomalies` from errors per ``epoch_ms`` and the table's ends and row count."""
    check_window(window_ms)
    anchor = F.lit(lo).cast("bigint")
    bucket = F.expr(f"(epoch_ms - _lo) div {int(window_ms)}L").alias("bucket")
    counted = error_times.withColumn("_lo", anchor).select(bucket, "errors").groupBy("bucket").agg(F.sum("errors").alias("errors"))
    counted = counted.where("errors > 0").select("bucket", *_window_bounds(anchor, window_ms), "errors")
    return _scored(counted, lo, hi, rows, z, window_ms)


def _scored(counted: DataFrame, lo, hi, rows, z: float, window_ms: int) -> tuple[DataFrame, DataFrame]:
    lo, hi = (F.lit(v).cast("bigint") for v in (lo, hi))
    windows = materialise(counted, "error-windows")
    whole = F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(rows).alias("rows"))
    baseline = _baseline(windows, whole, window_ms)
    if z <= 0:
        # Only now can an empty window qualify.
        spine = counted.sparkSession.range(baseline.first()["num_windows"] or 0)
        spine = spine.withColumnRenamed("id", "bucket")
        filled = spine.join(windows.select("bucket", "errors"), "bucket", "left")
        windows = filled.select(
            "bucket",
            *_window_bounds(lo, window_ms),
            F.coalesce("errors", F.lit(0).cast("bigint")).alias("errors"),
        )
    return score_windows(windows, baseline, z), baseline


def score_windows(windows: DataFrame, baseline: DataFrame, z: float = DEFAULT_Z) -> DataFrame:
    """Windows at or above ``z`` against a one-row baseline."""
    stats = baseline.select(F.struct("status", "mean", "stddev").alias("b")).scalar()
    score = (F.col("errors") - F.col("_b.mean")) / F.col("_b.stddev")
    scored = windows.withColumn("_b", stats).where("_b.status = 'ok'").withColumn("z", score)
    return scored.where(F.col("z") >= z).drop("_b")
