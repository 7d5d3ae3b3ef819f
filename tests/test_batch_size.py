"""Batch search makes its pairs of query and row last and moves none of them."""

import sys

import pytest
from conftest import as_multiset, plan_of
from pyspark.sql import functions as F

import sievelog as sl

QUERIES = "query_id BIGINT, keyword STRING, prefix STRING, wildcard STRING, start_ms BIGINT, end_ms BIGINT, level STRING, service STRING"
BASE = 1_704_067_200_000


def _asked(n):
    """The same glob, which rows meet by several tokens, and two more searches, ``n`` times."""
    some = []
    for i in range(n):
        some.append((3 * i, None, None, "*o*", None, None, None, None))
        some.append((3 * i + 1, "error", None, None, BASE, BASE + 3_600_000, None, None))
        some.append((3 * i + 2, None, "con", None, None, None, "error", None))
    return some


def _want(logs, n):
    found = [
        sl.matching(logs, wildcard="*o*"),
        sl.matching(logs, keyword="error", start_ms=BASE, end_ms=BASE + 3_600_000),
        sl.matching(logs, prefix="con", level="error"),
    ]
    rows = [as_multiset(f.selectExpr("0 AS query_id", "*")) for f in found]
    return {(3 * i + k, *row[1:]): count for i in range(n) for k in range(3) for row, count in rows[k].items()}


@pytest.mark.parametrize("deal", [2_000, 1], ids=["in-place", "dealt"])
def test_pairs_are_not_moved_or_grouped(spark, messy, monkeypatch, deal):
    monkeypatch.setattr(sys.modules[sl.batch_search.__module__], "_DEAL_KEYS", deal)
    got = sl.batch_search(messy, spark.createDataFrame(_asked(4), QUERIES))
    made = plan_of(got).split("BroadcastHashJoin")[0]
    assert "Exchange" not in made and "Aggregate" not in made
    # Queries with times are looked up by day though others have none.
    assert "_day" in plan_of(got)
    assert as_multiset(got) == _want(messy, 4)


def test_stored_hits_do_not_grow_with_the_queries(spark, messy, monkeypatch):
    plan, stored = sys.modules[sl.batch_search.__module__], []
    keep = plan.materialise

    def counted(df, name):
        table = keep(df, name)
        stored.append((name, table.count()))
        return table

    monkeypatch.setattr(plan, "materialise", counted)
    hits = []
    for n in (1, 20):
        for limit in (500_000, 0):
            queries = spark.createDataFrame(_asked(n), QUERIES)
            got = sl.batch_search(messy, queries, postings=sl.build_postings(messy), broadcast_rows=limit)
            assert as_multiset(got) == _want(messy, n)
            hits += [count for name, count in stored if name == "batch-hits"]
            stored.clear()
    assert len(hits) == 4 and len(set(hits)) == 1 and hits[0] > 0


def test_queries_that_ask_the_same_are_one_key(spark, messy, monkeypatch):
    plan, stored = sys.modules[sl.batch_search.__module__], []
    monkeypatch.setattr(plan, "_IDS", 20, raising=False)
    keep = plan.materialise
    monkeypatch.setattr(plan, "materialise", lambda df, name: stored.append(name) or keep(df, name))
    asked = spark.createDataFrame(_asked(100), QUERIES)
    named = asked.withColumn("query_id", F.concat(F.lit("q"), F.col("query_id").cast("string")))
    odd = spark.createDataFrame([(None, None, None, "*o*", None, None, None, None)] * 2, named.schema)
    for queries in (asked.union(asked), named.union(odd)):
        # 300 queries are 15 rows of ids; the words of the glob and the prefix count as well.
        got = sl.batch_search(messy, queries, broadcast_rows=250)
        assert "batch-postings" not in stored
        rows = as_multiset(got.withColumn("query_id", F.regexp_replace(F.col("query_id").cast("string"), "q", "").cast("bigint")))
        alone = {row: count for row, count in rows.items() if row[0] is None}
        assert {row: count for row, count in rows.items() if row not in alone} == _want(messy, 100)
        glob = as_multiset(sl.matching(messy, wildcard="*o*"))
        assert {row[1:]: count for row, count in alone.items()} == (glob if alone else {})
    assert alone


@pytest.mark.parametrize("many", [500_000, 0], ids=["few", "many"])
def test_stored_hits_are_rows(spark, messy, monkeypatch, many):
    plan, stored = sys.modules[sl.batch_search.__module__], []
    monkeypatch.setattr(plan, "_DEAL_HITS", many, raising=False)
    keep = plan.materialise
    monkeypatch.setattr(plan, "materialise", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    got = sl.batch_search(messy, spark.createDataFrame(_asked(3), QUERIES), postings=sl.build_postings(messy))
    assert as_multiset(got) == _want(messy, 3)
    (hits,) = stored
    of = ["log_id", "epoch_ms", "row_key"]
    assert hits.count() == hits.select(*of).distinct().count() > 0
    # Rows and hits that were dealt out alike are not moved again.
    assert ("Join [log_id" in plan_of(got).split("ShuffleQueryStage")[0]) == (not many)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_keys_do_not_grow_with_queries_that_ask_the_same(spark, messy, monkeypatch, limit):
    plan, keys = sys.modules[sl.batch_search.__module__], []
    meet = plan._meet
    monkeypatch.setattr(plan, "_meet", lambda found, asked, *how: keys.append(asked.count()) or meet(found, asked, *how))
    assert as_multiset(sl.batch_search(messy, spark.createDataFrame(_asked(20), QUERIES), broadcast_rows=limit)) == _want(messy, 20)
    # One list of ids for each of the three searches, on a day at most.
    assert keys == [3]
