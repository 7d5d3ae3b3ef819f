from conftest import BASE_MS, as_multiset, make_logs
from pyspark.sql import functions as F

import sievelog as sl
from sievelog.operators.lifecycle import with_defaults, with_ids

RAW = "log_id BIGINT, timestamp STRING, level STRING, service STRING, message STRING"


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "log_id BIGINT")


def test_defaults(spark):
    raw = spark.createDataFrame(
        [(7, " ", " error ", "\t", "  hi "), (None, "2024-01-01 00:00:05", None, "Auth", None)], RAW
    )
    rows = with_defaults(raw, F.timestamp_millis(F.lit(BASE_MS + 999))).collect()
    assert tuple(rows[0])[:2] == (7, "2024-01-01 00:00:00")
    assert (rows[0].level, rows[0].service, rows[0].message) == ("ERROR", "API", "hi")
    assert (rows[1].level, rows[1].service, rows[1].message) == ("INFO", "Auth", "")
    assert rows[1].epoch_ms == BASE_MS + 5000 and rows[1].ts_valid
    assert with_defaults(raw).where("ts_valid").count() == 2


def test_new_ids_are_free(spark, messy):
    raw = messy.withColumn("log_id", F.when(F.col("log_id") % 2 == 0, F.col("log_id"))).repartition(5)
    rows = with_ids(raw, messy)
    new = rows.where("log_id > 150")
    assert new.count() == raw.where("log_id IS NULL").count()
    assert new.select("log_id").distinct().count() == new.count()
    assert with_ids(raw.where("log_id IS NULL")).agg(F.min("log_id")).first()[0] == 1


def test_append_returns_what_is_stored(spark, messy, tmp_path):
    table = str(tmp_path / "t")
    first = sl.append_logs(spark, table, messy.where("log_id < 100"), 0)
    second = sl.append_logs(spark, table, messy.where("log_id >= 100").withColumn("log_id", F.lit(None)), 1)
    assert first.count() + second.count() == messy.count() == sl.open_logs(spark, table).count()
    assert second.agg(F.min("log_id")).first()[0] > first.agg(F.max("log_id")).first()[0]
    # Repeating a batch replaces it.
    sl.append_logs(spark, table, messy.where("log_id < 100"), 0)
    assert sl.open_logs(spark, table).count() == messy.count()


def test_delete(spark, messy):
    gone = ids(spark, 5, 7, 9, 7, 100_000)
    kept = sl.delete_by_id(messy, gone)
    assert as_multiset(kept) == as_multiset(messy.where("log_id NOT IN (5, 7, 9)"))
    found = {r.log_id: r.found for r in sl.found_ids(messy, gone).collect()}
    present = {r.log_id for r in messy.select("log_id").distinct().collect()}
    assert found == {i: i in present for i in (5, 7, 9, 100_000)}
    postings = sl.delete_by_id(sl.build_postings(messy), gone)
    assert as_multiset(postings) == as_multiset(sl.build_postings(kept))


def test_append_then_delete_is_the_original(spark, messy, tmp_path):
    extra = make_logs(spark, [(900, "2024-01-01 00:00:00", "INFO", "API", "x"), (901, None, "INFO", "API", "y")])
    both = sl.delete_by_id(messy.unionByName(extra), ids(spark, 900, 901))
    assert as_multiset(both) == as_multiset(messy)


def test_tombstones_and_compaction(spark, tmp_path):
    table, stones, target = (str(tmp_path / n) for n in ("t", "s", "c"))
    row = lambda i, text: (i, "2024-01-01 00:00:00", "INFO", "API", text)
    sl.append_logs(spark, table, make_logs(spark, [row(1, "old"), row(1, "twin"), row(2, "kept")]), 0)
    sl.add_tombstones(ids(spark, 1, 3), stones, 0)
    sl.append_logs(spark, table, make_logs(spark, [row(1, "new"), row(3, "late")]), 1)
    tombs = sl.open_tombstones(spark, stones)
    live = sl.live_rows(sl.open_logs(spark, table), tombs)
    assert {r.message for r in live.collect()} == {"kept", "new", "late"}
    sl.compact(spark, table, tombs, target)
    assert as_multiset(sl.open_logs(spark, target)) == as_multiset(live)
    sl.append_postings(sl.open_logs(spark, table).where("batch_id = 0"), str(tmp_path / "p"), 0)
    sl.append_postings(sl.open_logs(spark, table).where("batch_id = 1"), str(tmp_path / "p"), 1)
    postings = sl.open_posting_batches(spark, str(tmp_path / "p"))
    left = sl.live_rows(postings, tombs).where("token IN ('old', 'twin', 'kept', 'new', 'late')")
    assert {r.token for r in left.collect()} == {"kept", "new", "late"}
    sl.compact_postings(spark, str(tmp_path / "p"), tombs, str(tmp_path / "pc"))
    kept = sl.open_postings(spark, str(tmp_path / "pc"))
    assert kept.count() == sl.live_rows(postings, tombs).count()
    assert sl.posting_hits(kept, keyword="late").count() == 1
    assert sl.posting_hits(kept, keyword="twin").count() == 0
