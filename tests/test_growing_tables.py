"""Batches that never meet, ids without scans, appended tables, zones, and one answer on every plan."""

import os
import sys

import pytest
from conftest import as_multiset, make_logs, plan_of
from pyspark.sql import functions as F

import sievelog as sl
from sievelog import streaming
from sievelog.functions.timestamps import bound_ms
from sievelog.operators.lifecycle import with_defaults, with_ids
from sievelog.session import shared_dir
from sievelog.sources.batches import highest_id
from sievelog.sources.csv_logs import ingest_csv


def csv(path, name, *rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(f"{i},2024-01-01 00:00:00,INFO,API,{text}\n" for i, text in rows))
    return str(path)


def test_calls_without_a_batch_append(spark, tmp_path):
    table = str(tmp_path / "t")
    first = csv(tmp_path / "a", "a.csv", (1, "one"), (2, "two"), ("x", "bad"))
    for _ in range(2):
        assert ingest_csv(spark, first, table)["accepted"] == 2
    ingest_csv(spark, csv(tmp_path / "b", "b.csv", (3, "three")), table)
    assert sl.open_logs(spark, table).count() == 5 and sl.open_rejects(spark, table).count() == 2
    assert {r.batch_id for r in sl.open_logs(spark, table).collect()} == {0, 1, 2}


def test_a_named_batch_is_replaced_only_by_its_source(spark, tmp_path):
    table = str(tmp_path / "t")
    a, b = csv(tmp_path / "a", "a.csv", (1, "one")), csv(tmp_path / "b", "b.csv", (3, "three"))
    ingest_csv(spark, a, table, batch_id=7)
    ingest_csv(spark, a, table, batch_id=7)
    for call in (
        lambda: ingest_csv(spark, b, table, batch_id=7),
        lambda: sl.append_logs(spark, table, make_logs(spark, [(9, None, "INFO", "API", "x")]), 7),
    ):
        with pytest.raises(ValueError, match="batch 7"):
            call()
    assert [r.message for r in sl.open_logs(spark, table).collect()] == ["one"]
    assert ingest_csv(spark, b, table) and sl.open_logs(spark, table).agg(F.max("batch_id")).first()[0] == 8


def test_streams_meet_neither_batches_nor_each_other(spark, tmp_path):
    table, source = str(tmp_path / "t"), csv(tmp_path / "in", "a.csv", (1, "one"))
    ingest_csv(spark, source, table)
    for state in ("s1", "s2", "s1"):
        parsed = streaming.stream_logs_csv(spark, source)
        streaming.start_ingest(parsed, table, str(tmp_path / state), availableNow=True).awaitTermination()
    assert sl.open_logs(spark, table).count() == 3
    csv(tmp_path / "in", "b.csv", (2, "two"))
    parsed = streaming.stream_logs_csv(spark, source)
    streaming.start_ingest(parsed, table, str(tmp_path / "s1"), availableNow=True).awaitTermination()
    ingest_csv(spark, source, table)
    assert sl.open_logs(spark, table).count() == 6


def test_appends_read_no_earlier_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    row = lambda i, text: (i, "2024-01-01 00:00:00", "INFO", "API", text)
    sl.append_logs(spark, table, make_logs(spark, [row(41, "a")]))
    stored = next((tmp_path / "t" / "batch_id=0").glob("*.parquet"))
    os.chmod(stored, 0)
    stored.rename(stored.with_suffix(".away"))  # nothing is left to read
    late = sl.append_logs(spark, table, make_logs(spark, [row(None, "b"), row(7, "c")]))
    assert sorted(r.log_id for r in late.collect())[0] == 7
    assert late.agg(F.max("log_id")).first()[0] > 41
    assert highest_id(spark, table)[0] == late.agg(F.max("log_id")).first()[0]


def test_complete_ids_need_no_table(spark):
    rows = make_logs(spark, [(1, None, "INFO", "API", "x")])
    gone = spark.createDataFrame([(1,)], "log_id BIGINT").withColumn("log_id", F.raise_error(F.lit("read")).cast("bigint"))
    assert with_ids(rows, gone).count() == 1


def test_compaction_keeps_rejects_and_used_ids(spark, tmp_path):
    table, target, stones = (str(tmp_path / n) for n in ("t", "c", "s"))
    ingest_csv(spark, csv(tmp_path / "a", "a.csv", (1, "one"), (99, "gone"), ("x", "bad")), table)
    sl.append_logs(spark, table, make_logs(spark, [(5, None, "INFO", "API", "x")]))
    sl.add_tombstones(spark.createDataFrame([(99,)], "log_id BIGINT"), stones, 0)
    sl.compact(spark, table, sl.open_tombstones(spark, stones), target)
    assert {r.log_id for r in sl.open_logs(spark, target).collect()} == {1, 5}
    assert [r.reason for r in sl.open_rejects(spark, target).collect()] == ["bad_id"]
    new = sl.append_logs(spark, target, make_logs(spark, [(None, None, "INFO", "API", "x")]))
    assert new.first().log_id > 99 and new.first().batch_id == 2


def test_lines_of_any_length(spark, tmp_path):
    comma, head = "," * 60_000, "{},2024-01-01 00:00:00,INFO,API,"
    lines = [head.format(1) + f'"a{comma}b"', head.format(2) + "c" + comma, head.format(3) + '"d ""e"""' + comma, head.format(4) + "f" * 3_000_000]
    (tmp_path / "l.csv").write_text("\n".join(lines) + "\n")
    logs, rejects = sl.read_logs_csv(spark, str(tmp_path / "l.csv"))
    got = {r.log_id: r.message for r in logs.collect()}
    assert got == {1: f"a{comma}b", 2: "c", 3: 'd "e"', 4: "f" * 3_000_000} and rejects.count() == 0


def test_appended_tables_and_deletions(spark, messy, tmp_path):
    path, words, stones = (str(tmp_path / n) for n in ("c", "p", "s"))
    halves = [messy.where(F.col("log_id") % 2 == b) for b in (0, 1)]
    for batch, half in enumerate(halves):
        for _ in range(2):  # a repeat replaces
            sl.append_clustered(half, path, batch)
            sl.append_postings(half, words, batch)
    assert as_multiset(sl.open_clustered(spark, path).drop("log_date")) == as_multiset(messy)
    gone = spark.createDataFrame([(i,) for i in range(1, 60)], "log_id BIGINT")
    sl.add_tombstones(gone, stones, 0)
    tombs = sl.open_tombstones(spark, stones)
    live = halves[1].unionByName(halves[0].where("log_id >= 60"))
    logs, postings = sl.open_clustered(spark, path, tombs), sl.open_postings(spark, words, tombs)
    assert as_multiset(logs.drop("log_date")) == as_multiset(live)
    for filters in ({"keyword": "error"}, {"prefix": "con", "level": "ERROR"}):
        assert as_multiset(sl.search_indexed(logs, postings, **filters).drop("log_date")) == as_multiset(sl.matching(live, **filters))
    sl.compact_clustered(sl.open_clustered(spark, path, tombs, with_batch=True), str(tmp_path / "cc"))
    assert as_multiset(sl.open_clustered(spark, str(tmp_path / "cc")).drop("log_date")) == as_multiset(live)


def test_postings_know_how_they_were_built(spark, messy, tmp_path):
    path = str(tmp_path / "p")
    sl.append_postings(messy, path, 0, index_fields=False)
    with pytest.raises(ValueError, match="index_fields"):
        sl.append_postings(messy, path, 1, index_fields=True)
    postings = sl.open_postings(spark, path)
    clustered = str(tmp_path / "c")
    sl.write_clustered(messy, clustered)
    logs = sl.open_clustered(spark, clustered)
    with pytest.raises(ValueError, match="index_fields"):
        sl.search_indexed(logs, postings, index_fields=True, keyword="error")
    got = sl.search_indexed(logs, postings, keyword="error")
    assert got.count() == sl.matching(messy, keyword="error").count() > 0


def test_rare_hits_select_hours(spark, tmp_path):
    rows = [(i, f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", "INFO", "API", "rare" if i == 30 else "common") for i in range(240)]
    logs = make_logs(spark, rows)
    stored, path = sl.materialise(logs, "hours"), str(tmp_path / "c")
    sl.write_clustered(stored, path)
    found = sl.search_indexed(sl.open_clustered(spark, path), sl.build_postings(stored), keyword="rare")
    assert [r.log_id for r in found.collect()] == [30]
    assert "epoch_ms#" in plan_of(found) and str(1_704_067_200_000 + 30 * 3_600_000) in plan_of(found)


QUERIES = "query_id BIGINT, keyword STRING, prefix STRING, wildcard STRING, start_ms BIGINT, end_ms BIGINT, level STRING, service STRING"


def test_batch_search_has_one_answer(spark, messy):
    day = 86_400_000
    base = 1_704_067_200_000
    asked = [
        (1, "error", None, None, None, None, "ERROR", None),
        (1, "error", None, None, None, None, "ERROR", None),
        (2, None, None, None, base, base + 3_600_000, None, "API"),
        (3, None, None, None, base, base + 30 * day, "error", None),
        (4, None, "con", None, None, None, None, None),
        (5, None, None, "*on*", base, base + day, None, None),
        (6, None, None, None, None, None, None, "auth"),
        (7, None, None, None, None, None, None, None),
    ]
    queries = spark.createDataFrame(asked, QUERIES)
    want = None
    for postings in (None, sl.build_postings(messy), sl.build_postings(messy, index_fields=False)):
        for limit in (500_000, 5, 0):
            got = as_multiset(sl.batch_search(messy, queries, postings=postings, broadcast_rows=limit))
            want = want or got
            assert got == want
    by_hand = sum((r.query_id == 1) * n for r, n in ((type("R", (), {"query_id": k[0]}), n) for k, n in want.items()))
    assert by_hand == sl.matching(messy, keyword="error", level="ERROR").count()


def test_rows_carry_only_keys_that_are_asked(spark, messy, monkeypatch):
    plan = sys.modules[sl.batch_search.__module__]
    hour, day, base = 3_600_000, 86_400_000, 1_704_067_200_000
    carried = []
    keys_of = plan._slot_keys
    monkeypatch.setattr(plan, "_slot_keys", lambda slots: carried.append(slots) or keys_of(slots))
    for n, (level, service) in enumerate([(None, "auth"), ("error", None), (None, None), ("error", "auth")]):
        for span, slot in ((hour, plan._HOUR), (9 * day, plan._DAY)):
            queries = spark.createDataFrame([(n, None, None, None, base, base + span, level, service)], QUERIES)
            want = as_multiset(sl.matching(messy, start_ms=base, end_ms=base + span, level=level, service=service))
            for limit in (500_000, 0):
                got = sl.batch_search(messy, queries, broadcast_rows=limit)
                assert as_multiset(got.drop("query_id")) == want
                field = plan._SERVICE if service else plan._LEVEL if level else plan._ALWAYS
                assert carried.pop() == [(slot, field)]
    none = spark.createDataFrame([(1, None, None, None, base, base - 1, None, None)], QUERIES)
    assert sl.batch_search(messy, none, broadcast_rows=0).count() == 0


def test_zones(spark):
    session = spark.conf.get("spark.sql.session.timeZone")
    row = [(1, "2024-07-01 00:00:00", "INFO", "API", "x"), (2, None, "INFO", "API", "y")]
    raw = spark.createDataFrame(row, "log_id BIGINT, timestamp STRING, level STRING, service STRING, message STRING")
    try:
        for other in ("Asia/Tokyo", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", other)
            now = F.timestamp_millis(F.lit(1_704_067_200_000))
            got = {r.log_id: r for r in with_defaults(raw, now, "America/New_York").select("log_id", "timestamp", "epoch_ms").collect()}
            assert got[1].epoch_ms == 1_719_806_400_000
            assert (got[2].timestamp, got[2].epoch_ms) == ("2023-12-31 19:00:00", 1_704_067_200_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", session)
    assert bound_ms("2024-07-01 00:00:00", "America/New_York") == 1_719_806_400_000


def test_scratch_scope_clears_up(spark):
    with sl.scratch_scope(spark):
        path = sl.scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
    assert shared_dir(spark)


def test_broad_ranges_may_skip_the_deal(messy):
    rows = sl.search_time_range(messy, 0, 2**60, deal=False)
    times = [(r.epoch_ms, r.log_id) for r in rows.collect()]
    assert times == sorted(times) and len(times) == messy.count()
    assert "_dealt" not in plan_of(rows) and "_dealt" in plan_of(sl.search_time_range(messy, 0, 2**60))
