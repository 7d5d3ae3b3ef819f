import pytest
from conftest import BASE_MS, make_logs

import sievelog as sl
from sievelog import streaming


def rows(spark, *items):
    text = lambda second: f"2024-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"
    return make_logs(
        spark, [(i, text(s) if s is not None else "bad", level, "API", "m") for i, (s, level) in enumerate(items)]
    )


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")

    def add(*items):
        rows(spark, *items).coalesce(1).write.mode("append").parquet(path)

    return path, add


def stream(spark, path):
    return spark.readStream.schema(sl.LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_counts_and_late_rows(spark, source, tmp_path):
    path, add = source
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")
    add((10, "error"), (20, "ERROR"), (30, "INFO"), (400, "ERROR"), (None, "ERROR"))
    run = lambda: streaming.start_counts(
        streaming.stream_error_counts(stream(spark, path)), sink, state, availableNow=True
    ).awaitTermination()
    run()
    add((7200, "INFO"))
    run()
    # Its window closed when the watermark went past it.
    add((40, "ERROR"))
    run()
    add((20_000, "INFO"))
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    start = lambda n: BASE_MS + n * 300_000
    assert got == [(start(0), start(1), 2), (start(1), start(2), 1), (start(24), start(25), 0)]


def test_alerts(spark, source, tmp_path):
    path, add = source
    calm = [(n * 300 + 5, "ERROR") for n in range(12)]
    spike = [(6 * 300 + 10 + n, "ERROR") for n in range(19)]
    baseline = sl.error_baseline(rows(spark, *calm, *spike), 300_000)
    add(*calm, *spike)
    add((80_000, "INFO"))
    sink = str(tmp_path / "out")
    streaming.start_alerts(
        streaming.stream_error_counts(stream(spark, path)),
        baseline,
        sink,
        str(tmp_path / "state"),
        availableNow=True,
    ).awaitTermination()
    (alert,) = spark.read.parquet(sink).collect()
    assert (alert.start_ms, alert.errors) == (BASE_MS + 6 * 300_000, 20)
    assert alert.z > 2
