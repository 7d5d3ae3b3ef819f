"""No writer replaces rows that another wrote."""

import pytest
from conftest import as_multiset, make_logs
from pyspark.sql import functions as F

import sievelog as sl
from sievelog import streaming
from sievelog.plans import postings as postings_module
from sievelog.sources.csv_logs import ingest_csv


def rows(spark, *ids):
    return make_logs(spark, [(i, "2024-01-01 00:00:00", "ERROR", "API", f"word{i} more") for i in ids])


def refused(call):
    with pytest.raises(ValueError, match="batch 0"):
        call()


def test_clustered_tables_and_postings(spark, tmp_path):
    path, words, dictionary = (str(tmp_path / n) for n in ("c", "p", "d"))
    first, other = rows(spark, 1, 2), rows(spark, 3)
    sl.write_clustered(first, path)
    sl.write_postings(sl.build_postings(first), words)
    refused(lambda: sl.append_clustered(other, path, 0))
    refused(lambda: sl.append_postings(other, words, 0))
    for _ in range(2):  # the same rows under the same number replace themselves
        sl.append_clustered(other, path, 1)
        sl.append_postings(other, words, 1)
        sl.append_dictionary(sl.build_postings(first), dictionary, 0)
    refused(lambda: sl.append_dictionary(sl.build_postings(other), dictionary, 0))
    sl.append_dictionary(sl.build_postings(other), dictionary, 1)
    every = first.unionByName(other)
    assert as_multiset(sl.open_clustered(spark, path).drop("log_date")) == as_multiset(every)
    assert sl.open_postings(spark, words).count() == sl.build_postings(every).count()
    assert {r.token: r.df for r in sl.open_dictionary(spark, dictionary).collect()}["error"] == 3
    sl.compact_clustered(sl.open_clustered(spark, path, with_batch=True), str(tmp_path / "cc"))
    with pytest.raises(ValueError, match="batch 1"):
        sl.append_clustered(other, str(tmp_path / "cc"), 1)
    sl.append_clustered(rows(spark, 9), path, 5, source="mine")
    sl.append_clustered(rows(spark, 8), path, 5, source="mine")  # a named source may change its rows
    assert sl.open_clustered(spark, path).count() == 4


def test_named_records_and_rotated_files(spark, tmp_path):
    table, source = str(tmp_path / "t"), tmp_path / "in"
    sl.append_logs(spark, table, rows(spark, 1, 2), 0)
    sl.append_logs(spark, table, rows(spark, 1, 2), 0)
    refused(lambda: sl.append_logs(spark, table, rows(spark, 3), 0))
    assert sl.open_logs(spark, table).count() == 2
    source.mkdir()
    (source / "a.csv").write_text("1,2024-01-01 00:00:00,INFO,API,x\n")
    csv = str(tmp_path / "csv")
    for _ in range(2):
        ingest_csv(spark, f"{source}/*.csv", csv, batch_id=0)
    (source / "b.csv").write_text("2,2024-01-01 00:00:00,INFO,API,y\n")
    refused(lambda: ingest_csv(spark, f"{source}/*.csv", csv, batch_id=0))
    assert sl.open_logs(spark, csv).count() == 1


def test_postings_that_broke_off_can_grow(spark, tmp_path, monkeypatch):
    words = str(tmp_path / "p")
    with monkeypatch.context() as m:
        m.setattr(postings_module, "_sorted", lambda keyed: keyed.withColumn("gone", F.raise_error(F.lit("lost")).cast("int")))
        with pytest.raises(Exception, match="lost"):
            sl.append_postings(rows(spark, 1), words, 0)
    sl.append_postings(rows(spark, 1), words, 0)
    with pytest.raises(ValueError, match="index_fields"):
        sl.append_postings(rows(spark, 2), words, 1, index_fields=False)
    assert sl.open_postings(spark, words).count() == 4


def test_alert_streams_share_a_sink(spark, tmp_path):
    sink, times = str(tmp_path / "alerts"), "2024-01-01 00:%02d:00"
    baseline = spark.createDataFrame([("ok", 0.5, 0.5)], "status string, mean double, stddev double")
    for stream, n in (("a", 5), ("b", 2), ("a", 5)):
        source = str(tmp_path / f"in-{stream}")
        logs = make_logs(spark, [(i, times % (i * 5), "ERROR", "API", "x") for i in range(n) for _ in range(4)] + [(99, "2024-02-01 00:00:00", "INFO", "API", "x")])
        logs.write.mode("overwrite" if stream == "b" else "append").parquet(source)
        counts = streaming.stream_error_counts(spark.readStream.schema(sl.LOG_SCHEMA).parquet(source))
        streaming.start_alerts(counts, baseline, sink, str(tmp_path / stream), availableNow=True).awaitTermination()
    assert spark.read.parquet(sink).count() == 7


def test_quoted_lines_with_the_separator_inside(spark, tmp_path):
    (tmp_path / "z.csv").write_text('1,2024-01-01 00:00:00,INFO,API,"a\0b,c"\n2,2024-01-01 00:00:00,INFO,API,"d,""e""",more\n3,"x\n')
    logs, rejects = sl.read_logs_csv(spark, str(tmp_path / "z.csv"))
    assert {r.log_id: r.message for r in logs.collect()} == {1: "a\0b,c", 2: 'd,"e"'}
    assert [r.reason for r in rejects.collect()] == ["too_few_columns"]
