"""The store: one call for all tables, nothing visible before its entry, the same answers as a scan."""

import itertools
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import as_multiset, make_logs
from pyspark.sql import functions as F

import sievelog as sl
from sievelog import streaming
from sievelog.plans import store as store_module
from sievelog.sources import manifest
from sievelog.sources.batches import write_mark


def records(rows):
    """Raw records of log rows: times in whole seconds, as text."""
    return rows.select("log_id", "timestamp", "level", "service", "message")


def same_as_records(store, rows, windows=1):
    """The store holds ``rows`` in every table."""
    logs = store.logs().drop("log_date")
    assert as_multiset(logs) == as_multiset(rows)
    fields = store.state.settings["index_fields"]
    postings = sl.build_postings(rows, fields)
    assert as_multiset(store.postings().drop("head")) == as_multiset(postings)
    days = store_module.token_days(rows)
    want = days.groupBy("token").agg(
        sum(F.sum(f"h{i:02d}") for i in range(24)).alias("df"), F.min("log_date").alias("a"), F.max("log_date").alias("b")
    )
    assert as_multiset(store.dictionary()) == as_multiset(want)
    assert as_multiset(store.token_days()) == as_multiset(days) if not store.state.deletions else True
    for z, window_ms, valid in ((0.5, 300_000, False), (-5.0, 86_400_000, True))[:windows]:
        got = store.anomalies(z, window_ms, valid)
        want = sl.detect_anomalies(rows, z, window_ms, valid)
        for a, b in zip(got, want, strict=True):
            round_ = lambda df: [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]
            assert sorted(round_(a), key=str) == sorted(round_(b.select(*a.columns)), key=str)


@pytest.fixture(scope="module")
def rows(spark, messy):
    """The messy rows as a store keeps them: defaults filled in."""
    from sievelog.operators.lifecycle import with_defaults

    return sl.materialise(with_defaults(records(messy), F.timestamp_millis(F.lit(1_704_067_200_000))), "kept")


def in_batches(spark, path, rows, n=3, **settings):
    store = sl.create_store(spark, path, **settings)
    for i in range(n):
        store.append(records(rows.where(F.col("log_id") % n == i)))
    return store


@pytest.mark.parametrize("fields", [False])
def test_batches_deletions_and_gathering(spark, rows, tmp_path, fields):
    store = in_batches(spark, str(tmp_path / "s"), rows, 2, index_fields=fields)
    gone = spark.createDataFrame([(i,) for i in [*range(1, 60), 5000]] + [(3,), (None,)], "log_id BIGINT")
    left = rows.where("log_id >= 60")
    before = sl.open_store(spark, store.path)
    assert store.delete(gone) == rows.where("log_id < 60").count()
    assert store.delete(gone) == 0
    same_as_records(store, left, 2)
    assert as_multiset(before.logs().drop("log_date")) == as_multiset(rows)  # a reader keeps its state
    again = rows.where("log_id < 20")
    store.append(records(again))  # the same ids again are not deleted
    store.compact()
    assert len(store.state.batches) == 1 and not store.state.deletions
    same_as_records(sl.open_store(spark, store.path), left.unionByName(again))
    assert store.delete(gone) == again.count()
    assert store.sweep(10**9) == [] and len(store.sweep(-1000)) > 0
    same_as_records(sl.open_store(spark, store.path), left)
    store.delete(rows.select("log_id"))
    assert store.logs().count() == 0 and store.dictionary().count() == 0
    assert store.anomalies()[1].first()["status"] == "insufficient"


FILTERS = [
    {"keyword": "error"}, {"keyword": "conn", "level": "error"}, {"prefix": "con", "service": "auth-service"},
    {"wildcard": "*ton"}, {"wildcard": "c*n", "level": " warn "}, {"level": "ERROR"}, {"service": "nobody"}, {},
    {"keyword": "t", "start_ms": 1_704_067_200_000, "end_ms": 1_704_150_000_000}, {"prefix": "straße"}, {"level": "ALL", "wildcard": "*"},
]


@pytest.mark.parametrize(("fields", "few"), [(True, False), (False, True)])
def test_searches_equal_scans(spark, rows, tmp_path, monkeypatch, fields, few):
    if not few:
        monkeypatch.setattr(store_module, "DAYS", 1)
    store = in_batches(spark, str(tmp_path / "s"), rows, 2, index_fields=fields)
    store.delete(rows.where("log_id % 7 = 0").select("log_id"))
    live = rows.where("log_id % 7 != 0")
    for filters in FILTERS[:: 1 if few else 3]:
        assert as_multiset(store.search(**filters).drop("log_date")) == as_multiset(sl.matching(live, **filters)), filters
    for words in (("error", "conn"), ("conn", "api", "ton"), ("error", "nothing"), ("",)):
        want = live
        for w in words:
            want = sl.search_exact(want, w)
        assert as_multiset(store.search(words=words).drop("log_date")) == as_multiset(want), words
    for filters in ({"prefix": "con", "level": "error"}, {"wildcard": "*n"}):
        want = sl.matching(live, unique_ids=False, **filters)
        assert as_multiset(store.search(unique_ids=False, **filters).drop("log_date")) == as_multiset(want)


def test_globs_without_a_head_are_resolved_to_tokens(spark, rows, tmp_path, monkeypatch):
    store = in_batches(spark, str(tmp_path / "s"), rows, 2)
    tokens = [r.token for r in store.dictionary().collect()]
    read, plain = [], store_module.Store._read
    monkeypatch.setattr(store_module.Store, "_read", lambda self, table, a: (read.append(table), plain(self, table, a))[1])
    for glob in ("*ton", "*ection", "*onn*", "*onn*tio*", "*e*ice", "*o*n", "*zzz*", "*%", "*straße*"):
        want = sorted(t for t in tokens if re.fullmatch(".*".join(map(re.escape, glob.split("*"))), t, re.DOTALL))
        assert store._resolved(glob) == want, glob
    assert set(read) == {"tails", "grams"}  # neither postings nor token days
    assert store._resolved("*n*") is None  # nothing to look up
    plan = store.token_days(store._asks(wildcard="*ection"))._jdf.queryExecution().executedPlan().toString()
    assert "In(token" in plan or "EqualTo(token" in plan
    monkeypatch.setattr(store_module, "TOKENS", 1)
    assert store._resolved("*n") is None  # too many
    for glob in ("*n", "*ection", "*on*"):
        assert as_multiset(store.search(wildcard=glob).drop("log_date")) == as_multiset(sl.matching(rows, wildcard=glob))


def test_nothing_counts_before_its_entry_and_a_rerun_is_whole(spark, rows, tmp_path, monkeypatch):
    store = in_batches(spark, str(tmp_path / "s"), rows, 1)
    extra = rows.where("log_id < 30")
    writes = [store_module.write_observed, manifest.write_mark]
    plain = store_module.Store._write
    for broken in (0, 1, 4, 7, 8):  # raw, five tables, two more, the entry
        calls = itertools.count()

        def failing(*args, _plain, **kwargs):
            if next(calls) == broken:
                raise RuntimeError("lost")
            return _plain(*args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(store_module, "write_observed", lambda *a: failing(*a, _plain=writes[0]))
            m.setattr(store_module.Store, "_write", lambda self, *a: failing(self, *a, _plain=plain))
            m.setattr(manifest, "write_mark", lambda *a: failing(*a, _plain=writes[1]))
            with pytest.raises(RuntimeError, match="lost"):
                store.append(records(extra), call="extra")
        if broken in (4, 8):
            same_as_records(sl.open_store(spark, store.path), rows, 0)
    counts = store.append(records(extra), call="extra")
    assert store.append(records(extra), call="extra") == counts and counts["accepted"] == extra.count()
    assert store.sweep(-1000)
    same_as_records(sl.open_store(spark, store.path), rows.unionByName(extra))
    with pytest.raises(ValueError, match="other rows"):
        store.append(records(rows), call="extra")
    with pytest.raises(ValueError, match="settings"):
        sl.create_store(spark, store.path, index_fields=False)
    with pytest.raises(ValueError, match="no store"):
        sl.open_store(spark, str(tmp_path / "none"))


def test_writers_at_once(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    sl.create_store(spark, path)
    numbered = F.col("log_id") % 3 > 0
    some = records(rows).withColumns({"log_id": F.when(numbered, F.col("log_id")), "service": F.when(numbered, F.col("service")).otherwise(F.lit("new"))})
    parts = [some.where(F.crc32(F.coalesce("message", F.lit(""))) % 4 == i) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda p: sl.open_store(spark, path).append(p), parts))
    store = sl.open_store(spark, path)
    assert len(store.state.batches) == 4 and store.logs().count() == rows.count()
    new = store.logs().where("service = 'new'")  # numbered by the store
    assert new.select("log_id").distinct().count() == new.count() == rows.where("log_id % 3 = 0").count()


def test_a_deletion_that_meets_another_starts_again(spark, rows, tmp_path, monkeypatch):
    store = in_batches(spark, str(tmp_path / "s"), rows, 1)
    other, met = sl.open_store(spark, store.path), []
    plain = store_module.Store._write_all

    def slow(self, *args, **tables):
        if self is store and not met:
            met.append(other.delete(rows.where("log_id < 40").select("log_id")))
        plain(self, *args, **tables)

    monkeypatch.setattr(store_module.Store, "_write_all", slow)
    assert store.delete(rows.where("log_id < 50").select("log_id")) == rows.where("log_id >= 40 AND log_id < 50").count()
    assert met == [rows.where("log_id < 40").count()]
    same_as_records(store, rows.where("log_id >= 50"))


def test_csv_and_streams(spark, rows, tmp_path):
    path, source = str(tmp_path / "s"), tmp_path / "in"
    store = sl.create_store(spark, path)
    first = rows.where("log_id % 2 = 0")
    sl.write_csv(first.coalesce(1), str(tmp_path / "a"))
    counts = store.ingest_csv(str(tmp_path / "a"), call="a")
    assert store.ingest_csv(str(tmp_path / "a"), call="a") == counts and counts["accepted"] == first.count()
    source.mkdir()
    (source / "x.csv").write_text("".join(f"{i},2024-01-01 00:00:{i:02d},ERROR,API,streamed word{i}\n" for i in range(20)) + "x,bad\n")
    for checkpoint in ("c1", "c1", "c2"):  # the same checkpoint adds nothing, a new one reads all again
        parsed = streaming.stream_logs_csv(spark, str(source))
        store.start_ingest(parsed, str(tmp_path / checkpoint), availableNow=True).awaitTermination()
    store = sl.open_store(spark, path)
    assert store.search(keyword="streamed").count() == 40 and store.rejects().where("raw = 'x,bad'").count() == 2
    assert {r.token: r.df for r in store.dictionary().where("token LIKE 'word%'").collect()} == {f"word{i}": 2 for i in range(20)}
    assert len(store.state.streams) == 2


def test_a_repeated_micro_batch_adds_nothing(spark, rows, tmp_path):
    store = sl.create_store(spark, str(tmp_path / "s"))
    store._add(lambda: parsed(spark, rows), stream=("a", 0))
    store._add(lambda: parsed(spark, rows), stream=("a", 0))
    store._add(lambda: parsed(spark, rows), stream=("a", 1))
    assert store.state.streams == {"a": 1} and store.logs().count() == 2 * rows.count()


def parsed(spark, rows):
    return rows.withColumns({c: F.lit(None).cast("string") for c in ("file", "raw", "reason")})


def test_the_log_is_read_from_its_last_whole_entry(spark, tmp_path):
    path = str(tmp_path / "s")
    store = sl.create_store(spark, path)
    for i in range(2 * manifest.WHOLE_EVERY + 3):
        manifest.commit(spark, path, lambda s, i=i: {"kind": "batch", "attempt": str(i), "top": i, "counts": {"accepted": 1}, "call": f"c{i % 5}", "source": "s", "stream": ("x", i)})
    for old in sorted((tmp_path / "s" / "_log").glob("[0-9]*"))[: manifest.WHOLE_EVERY]:
        old.write_text("gone")
    state = store.refresh().state
    assert len(state.batches) == 2 * manifest.WHOLE_EVERY + 3 and state.streams == {"x": 2 * manifest.WHOLE_EVERY + 2} and len(state.calls) == 5


def test_marks_are_created_whole_and_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: write_mark(spark, str(tmp_path / "m"), "mark", f"text {i}"), range(8)))
    assert sum(won) == 1 and (tmp_path / "m" / "mark").read_text() == f"text {won.index(True)}"
