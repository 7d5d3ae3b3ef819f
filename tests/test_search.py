import re
from collections import Counter

import pytest
from conftest import BASE_MS, as_multiset, make_logs, matches_by_definition, plan_of
from pyspark.sql import functions as F

import sievelog as sl


@pytest.mark.parametrize(
    "word, n",
    [
        ("connection", 333),
        ("CONNECTION", 333),
        ("error", 333),
        ("server", 333),
        ("payment", 333),
        ("connect", 0),
        ("5432", 167),
        ("host_3", 100),
    ],
)
def test_exact(sample, word, n):
    assert sl.search_exact(sample, word).count() == n


@pytest.mark.parametrize(
    "prefix, n", [("conn", 333), ("pay", 333), ("SER", 333), ("t", 1000), ("hos", 1000), ("host_", 1000)]
)
def test_prefix(sample, prefix, n):
    assert sl.search_prefix(sample, prefix).count() == n


@pytest.mark.parametrize(
    "glob, n",
    [
        ("conn*", 333),
        ("*tion", 667),
        ("t*n", 334),
        ("p*t", 467),
        ("hos*", 1000),
        ("host_*", 1000),
        ("*", 1000),
        ("erxyz", 0),
    ],
)
def test_wildcard(sample, glob, n):
    assert sl.search_wildcard(sample, glob).count() == n


def test_substring(sample):
    assert sl.search_substring(sample, "Connect").count() == 333
    assert sl.search_substring(sample, "error").count() == 0


def test_empty_terms(sample):
    assert sl.search_exact(sample, "").count() == 0
    assert sl.search_prefix(sample, "").count() == 0
    assert sl.search_wildcard(sample, "").count() == 0
    assert sl.compound(sample, keyword="").count() == 1000


def test_compound(sample):
    assert sl.compound(sample, keyword="connection", level="warn").count() == 167
    assert sl.compound(sample, keyword="connection", level="warn", service="api").count() == 33
    rows = sl.compound(
        sample,
        keyword="connection",
        level="warn",
        service="api",
        start_ms=BASE_MS + 1000,
        end_ms=BASE_MS + 100_000,
    ).collect()
    assert [r.log_id for r in rows] == [100025, 100055, 100085]


def test_keyword_goes_before_prefix_and_wildcard(sample):
    assert sl.compound(sample, keyword="connection", prefix="zzz", wildcard="zzz*").count() == 333
    assert sl.compound(sample, prefix="conn", wildcard="zzz*").count() == 333


def test_one_time_bound_is_an_error(sample):
    with pytest.raises(ValueError):
        sl.compound(sample, start_ms=1)


def test_compound_text(sample):
    assert sl.compound_text(sample, " t*n ", "", "").count() == 334
    assert sl.compound_text(sample, "connection", "WARN", "api").count() == 33
    # One readable bound is no time filter; reversed bounds are swapped.
    assert sl.compound_text(sample, "", start="2024-01-01 00:00:10", end="?").count() == 1000
    swapped = sl.compound_text(sample, "", start="2024-01-01 00:01:40", end="2024-01-01 00:00:01")
    assert swapped.count() == 100


def test_time_range(sample):
    rows = sl.search_time_range(sample, BASE_MS + 101_000, BASE_MS + 200_000).collect()
    assert [r.log_id for r in rows] == list(range(100101, 100201))
    assert sl.search_time_range(sample, 5, 4).count() == 0
    assert sl.search_time_text(sample, "2024-01-01 00:16:31", "").count() == 10
    assert sl.search_time_text(sample, "", "").count() == 1000
    # A start after everything swaps with the default end, the last time there is.
    assert sl.search_time_text(sample, "2030-01-01 00:00:00", "").count() == 1


def test_exact_time_finds_all_duplicates(spark):
    logs = make_logs(spark, [(i, "2024-01-01 00:00:00", "INFO", "API", f"m{i}") for i in range(20)])
    assert sl.search_time_exact(logs, BASE_MS).count() == 20


TERMS = ["error", "Conn", "auth-service", "my svc", "x_1", "a", "b", "t", "e", "stra", "é", "50%", "svc", " ", "zz"]


@pytest.mark.parametrize("term", TERMS)
def test_predicates_equal_the_token_definition(messy, term):
    low = term.lower()
    assert as_multiset(sl.search_exact(messy, term)) == as_multiset(
        matches_by_definition(messy, lambda t: t == low)
    )
    assert as_multiset(sl.search_prefix(messy, term)) == as_multiset(
        matches_by_definition(messy, lambda t: F.startswith(t, F.lit(low)))
    )


@pytest.mark.parametrize(
    "glob",
    ["*", "**", "c*n", "*n", "*o*", "c*c*n", "e*o*", "*-*", "a*-s*e", "m* svc", "t*n", "t**n", "*_1", "*%", "_*", "x_*1", "*ss*", "conn"],
)
def test_globs_equal_the_token_definition(messy, glob):
    pattern = r"\A(?s:" + ".*".join(re.escape(p) for p in glob.split("*")) + r")\z"
    assert as_multiset(sl.search_wildcard(messy, glob)) == as_multiset(
        matches_by_definition(messy, lambda t: F.rlike(t, F.lit(pattern)))
    )


def test_one_row_per_id(messy):
    got = sl.search_prefix(messy, "e", unique_ids=False)
    best = {}
    key = lambda r: tuple((v is not None, v) for v in (r.epoch_ms, r.service, r.level, r.message))
    for row in sl.search_prefix(messy, "e").collect():
        if row.log_id not in best or key(row) < key(best[row.log_id]):
            best[row.log_id] = row
    assert {r.log_id: key(r) for r in got.collect()} == {i: key(r) for i, r in best.items()}


def test_one_per_id_is_chosen_before_other_filters(spark):
    logs = make_logs(
        spark,
        [(1, "2024-01-01 00:00:01", "INFO", "API", "conn"), (1, "2024-01-01 00:00:02", "ERROR", "API", "conn")],
    )
    assert sl.compound(logs, prefix="conn", level="ERROR").count() == 1
    assert sl.compound(logs, prefix="conn", level="ERROR", unique_ids=False).count() == 0
    assert sl.compound(logs, keyword="conn", level="ERROR", unique_ids=False).count() == 1


def test_level_and_service_all(messy):
    assert sl.filter_level(messy, "all").count() == sl.filter_service(messy, None).count() == messy.count()
    assert sl.filter_level(messy, "Error").count() == messy.where("upper(level) = 'ERROR'").count()


def test_shard_search_equals_whole_search(messy):
    whole = sl.compound(messy, wildcard="c*n")
    by_shard = sl.scatter_gather(messy, 4, wildcard="c*n")
    assert as_multiset(by_shard.drop("shard")) == as_multiset(whole)
    parts = [sl.scatter_gather(messy, 4, only=[n], wildcard="c*n").drop("shard") for n in range(4)]
    merged = sl.merge_by_time(*parts)
    assert as_multiset(merged) == as_multiset(whole)
    times = [(r.epoch_ms, r.log_id) for r in merged.collect()]
    assert times == sorted(times)


def test_preview_and_count(sample):
    hits = sl.matching(sample, keyword="error")
    assert sl.match_count(hits).first()["matches"] == 333
    assert [r.log_id for r in sl.preview(hits, 3).collect()] == [100002, 100005, 100008]


def test_plans(sample):
    found = plan_of(sl.compound(sample, keyword="error", start_ms=1, end_ms=9))
    assert "GreaterThanOrEqual(epoch_ms,1)" in found and "LessThanOrEqual(epoch_ms,9)" in found
    # The matches move once before the sort, so that its sampling does not scan again.
    assert found.count("Exchange RoundRobin") == found.count("Exchange rangepartitioning") == 1
    assert "Exchange" not in plan_of(sl.search_wildcard(sample, "t*n"))
    assert "TakeOrderedAndProject" in plan_of(sl.preview(sl.search_exact(sample, "error")))
    assert "RoundRobin" not in plan_of(sl.match_count(sl.matching(sample, keyword="error")))
    assert "Window" not in plan_of(sl.first_per_id(sample))


def test_copies_of_one_row_are_sorted_by_several_tasks(spark):
    row = make_logs(spark, [(1, "2024-01-01 00:00:00", "INFO", "API", "again")]).first()
    copies = spark.range(100_000, numPartitions=1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, sl.LOG_SCHEMA)]
    )
    # So few copies would rightly be gathered again by their size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = [r[0] for r in sl.in_time_order(copies).select(F.spark_partition_id()).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 100_000
    assert max(Counter(tasks).values()) < 50_000
