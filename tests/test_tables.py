import pytest
from conftest import BASE_MS, as_multiset, plan_of
from pyspark.sql import functions as F

import sievelog as sl
from sievelog.schema import QUERY_SCHEMA


@pytest.fixture(scope="module")
def clustered(spark, messy):
    path = sl.scratch_path(spark, "clustered")
    sl.write_clustered(messy, path)
    return sl.open_clustered(spark, path)


@pytest.fixture(scope="module", params=[True, False], ids=["fields", "words"])
def postings(request, spark, messy):
    path = sl.scratch_path(spark, "postings")
    sl.write_postings(sl.build_postings(messy, request.param), path)
    return sl.open_postings(spark, path), request.param


def test_postings_of_the_sample(sample):
    rows = sl.build_postings(sample)
    assert rows.count() == 6766
    words = sl.token_dictionary(rows)
    assert words.count() == 38
    assert words.where("token = 'connection'").first().df == 333


FILTERS = [
    {"keyword": "error"},
    {"keyword": "X_1", "level": "error"},
    {"keyword": "auth-service"},
    {"keyword": "zz"},
    {"prefix": "con"},
    {"prefix": "e", "service": "api", "start_ms": BASE_MS, "end_ms": BASE_MS + 100_000_000},
    {"wildcard": "c*n"},
    {"wildcard": "*n"},
    {"wildcard": "conn*"},
    {"wildcard": "*"},
    {"wildcard": "conn"},
    {"wildcard": "*o*", "level": "INFO"},
    {"keyword": "", "level": "ERROR", "start_ms": BASE_MS, "end_ms": BASE_MS + 86_400_000},
]


@pytest.mark.parametrize("filters", FILTERS, ids=str)
def test_indexed_search_equals_scan(messy, clustered, postings, filters):
    table, fields = postings
    for unique in (True, False):
        got = sl.search_indexed(clustered, table, index_fields=fields, unique_ids=unique, **filters)
        want = sl.matching(messy, unique_ids=unique, **filters)
        assert as_multiset(got.drop("log_date")) == as_multiset(want)


@pytest.mark.parametrize("filters", FILTERS[:-1], ids=str)
def test_posting_hits_name_the_rows(messy, filters):
    got = sl.posting_hits(sl.build_postings(messy), **filters).select("log_id", "row_key")
    want = sl.matching(messy, **filters).select("log_id", sl.row_key().alias("row_key")).distinct()
    assert as_multiset(got) == as_multiset(want)


def test_time_range_on_the_clustered_table(messy, clustered):
    lo, hi = BASE_MS + 40_000_000, BASE_MS + 100_000_000
    got = sl.search_time_range(clustered, lo, hi)
    assert as_multiset(got.drop("log_date")) == as_multiset(sl.search_time_range(messy, lo, hi))
    plan = plan_of(got)
    assert "log_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(epoch_ms" in plan
    far = sl.search_time_range(clustered, -(2**63), 2**63 - 1)
    assert far.count() == messy.count()


def test_token_filters_reach_the_reader(postings):
    table, _ = postings
    folders = lambda plan: plan.split("PartitionFilters: [")[1].split("]")[0]
    exact = plan_of(sl.posting_hits(table, keyword="Error"))
    assert "EqualTo(token,error)" in exact and "= er)" in folders(exact)
    prefix = plan_of(sl.posting_hits(table, prefix="con"))
    assert "StringStartsWith(token,con)" in prefix and "= co)" in folders(prefix)
    glob = plan_of(sl.posting_hits(table, wildcard="c*n"))
    assert "StringStartsWith(token,c)" in glob and "StartsWith(head" in folders(glob)


def test_no_python_in_any_plan(messy):
    for df in (
        sl.build_postings(messy),
        sl.template_counts(messy),
        sl.top_k_errors(messy),
        sl.compound(messy, wildcard="c*n"),
        sl.shard_load(messy),
        sl.error_baseline(messy),
    ):
        assert "Python" not in plan_of(df)


DAY = 86_400_000
QUERIES = [
    (1, "error", None, None, None, None, None, None),
    (2, "X_1", None, None, None, None, "error", "all"),
    (3, "", "con", "", None, None, None, None),
    (4, None, "e", None, BASE_MS, BASE_MS + DAY, "ALL", "Api"),
    (5, None, None, "c*n", None, None, None, None),
    (6, None, None, "*n", None, None, None, None),
    (7, None, None, "*o*", None, None, "INFO", None),
    (8, None, None, "**", None, None, None, None),
    (9, None, None, "conn", None, None, None, None),
    (10, None, None, "con**", None, None, None, None),
    (11, None, None, None, None, None, None, None),
    (12, None, None, None, BASE_MS + DAY, BASE_MS + 2 * DAY, None, None),
    (13, None, None, None, 0, 0, None, None),
    (14, None, None, None, 9, 5, None, None),
    (15, None, None, None, None, None, "Error", "auth"),
    (16, "nothing", "con", "c*", None, None, None, None),
    (17, None, None, "a*-s*e", None, None, None, None),
    (18, None, "my s", None, None, None, None, None),
    (19, None, None, "*%*", None, None, None, None),
    (20, None, None, "*_1", BASE_MS, BASE_MS + 2 * DAY, None, None),
    (21, None, None, "*s*r*c*", None, None, None, None),
    (22, None, "connectio", None, None, None, None, None),
    (23, None, None, "*", BASE_MS, BASE_MS + DAY, "INFO", None),
    (24, None, None, "*", None, None, "ERROR", "auth"),
    (25, None, None, "*", None, None, None, "API"),
    (26, None, None, None, None, None, "error", None),
]


def expected(logs, unique_ids, queries=QUERIES):
    out = None
    for qid, keyword, prefix, wildcard, lo, hi, level, service in queries:
        rows = sl.matching(
            logs, keyword, prefix, wildcard, lo, hi, level, service, unique_ids=unique_ids
        ).select(F.lit(qid).cast("bigint").alias("query_id"), "*")
        out = rows if out is None else out.unionByName(rows)
    return as_multiset(out)


@pytest.fixture(scope="module")
def deduplicated(spark, messy):
    path = sl.scratch_path(spark, "distinct")
    messy.distinct().write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("unique", [True, False], ids=["all", "first"])
@pytest.mark.parametrize("how", ["scan", "shuffle", "postings"])
def test_batch_search_equals_single_searches(spark, messy, how, unique):
    queries = spark.createDataFrame(QUERIES, QUERY_SCHEMA)
    options = {
        "scan": {},
        "shuffle": {"broadcast_rows": 0},
        "postings": {"postings": sl.build_postings(messy)},
    }[how]
    got = sl.batch_search(messy, queries, unique_ids=unique, **options)
    assert as_multiset(got) == expected(messy, unique)


def test_batch_search_within_times(spark, clustered, messy):
    some = [q for q in QUERIES if q[0] in (4, 12, 13, 14, 20)]
    some.append((30, None, None, None, BASE_MS + 1, BASE_MS + DAY // 2, "ERROR", None))
    some.append((31, "error", None, None, BASE_MS + DAY - 5, BASE_MS + DAY + 5, None, None))
    some.append((32, "error", None, None, BASE_MS + DAY, BASE_MS, None, None))
    queries = spark.createDataFrame(some, QUERY_SCHEMA)
    for postings in (None, sl.build_postings(messy)):
        got = sl.batch_search(clustered, queries, postings=postings).drop("log_date")
        assert as_multiset(got) == expected(messy, True, some)
    far = [(1, "error", None, None, -(2**62), 2**62, None, None)]
    got = sl.batch_search(messy, spark.createDataFrame(far, QUERY_SCHEMA))
    assert as_multiset(got) == expected(messy, True, far)
    assert "_day" in plan_of(sl.batch_search(messy, spark.createDataFrame(some[-2:], QUERY_SCHEMA)))


def test_batch_search_limits(spark, messy):
    empty = sl.batch_search(messy, spark.createDataFrame([], QUERY_SCHEMA))
    assert empty.count() == 0 and empty.columns == ["query_id", *messy.columns]
    half = spark.createDataFrame([(1, "a", None, None, 5, None, None, None)], QUERY_SCHEMA)
    with pytest.raises(ValueError):
        sl.batch_search(messy, half)


def test_batch_scan_does_not_shuffle_rows(spark, messy):
    some = [q for q in QUERIES if q[0] in (1, 2, 12)]
    got = sl.batch_search(messy, spark.createDataFrame(some, QUERY_SCHEMA))
    plan = plan_of(got)
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
