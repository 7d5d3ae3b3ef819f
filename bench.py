"""Headline jobs over the events and documents logs; prints one JSON line.

Every job is run once to warm up and then three times; the median counts. Times include
planning and reading Parquet, nothing is cached. ``per_query_ms`` spreads the batch job
over its queries, which is what compares with one lookup in a warm in-memory index.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import sievelog as sl
from sievelog.sources.csv_logs import ingest_csv

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
BATCH = 1000
#: Queries of the batch that are also run one by one.
SEPARATE = 20


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    """Compute every row and column."""
    df.write.format("noop").mode("overwrite").save()


def batch_queries(logs, step):
    """Selective queries taken from every ``step``-th row: a word, a level, six hours."""
    i = F.col("log_id")
    picked = logs.where(i % step == 0)
    kind = F.floor(i / step) % 3
    return picked.select(
        i.alias("query_id"),
        F.when(kind == 0, F.regexp_extract("message", r"(\d+)\}", 1)).alias("keyword"),
        F.when(kind == 1, F.substring("message", 1, 5)).alias("prefix"),
        F.when(kind == 2, F.concat(F.lit("*_"), (F.floor(i / step) % 10).cast("string"))).alias("wildcard"),
        (F.col("epoch_ms") - 3 * 3_600_000).alias("start_ms"),
        (F.col("epoch_ms") + 3 * 3_600_000).alias("end_ms"),
        "level",
        F.lit("ALL").alias("service"),
    )


def files_read(df) -> dict:
    """Files and bytes that the scans of a query opened, after their partition filters."""
    df.collect()
    seen = {"files": 0, "bytes": 0}

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        if kind == "FileSourceScanExec":
            for name, metric in (("files", "numFiles"), ("bytes", "filesSize")):
                seen[name] += plan.metrics().apply(metric).value()
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return seen


def separate(spark, logs, asked) -> None:
    """The queries of the batch one by one, each a scan of its own."""
    for q in asked.orderBy("query_id").limit(SEPARATE).collect():
        filters = {k: q[k] for k in ("keyword", "prefix", "wildcard", "start_ms", "end_ms", "level", "service")}
        drain(sl.matching(logs, **filters))


def main() -> None:
    spark = session()
    with sl.scratch_scope(spark):
        run(spark)
    spark.stop()


def run(spark) -> None:
    path = lambda name: sl.scratch_path(spark, f"bench-{name}")

    def stored(name, rows):
        """As a log table of several files, as a cluster would hold it."""
        target = path(name)
        rows.repartition(int(CPUS)).write.parquet(target)
        return spark.read.schema(sl.LOG_SCHEMA).parquet(target)

    logs = stored("events", sl.logs_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet")))
    docs = stored("docs", sl.logs_from_documents(spark.read.parquet(f"{SF_DIR}/documents.parquet")))
    n_logs, n_docs = logs.count(), docs.count()
    csv = path("csv")
    sl.write_csv(logs, csv)
    asked = path("queries")
    batch_queries(logs, max(1, n_logs // BATCH)).write.parquet(asked)
    asked = spark.read.schema(sl.QUERY_SCHEMA).parquet(asked)
    n_batch = asked.count()

    def build_postings(source):
        target = path("postings")
        sl.write_postings(sl.build_postings(source), target)
        return target

    def build_clustered():
        target = path("clustered")
        sl.write_clustered(logs, target)
        return target

    clustered = sl.open_clustered(spark, build_clustered())
    postings = sl.open_postings(spark, build_postings(logs))
    extent = sl.time_extent(logs).first()
    middle = (extent.min_ms + extent.max_ms) // 2
    near = (middle - 1_800_000, middle + 1_800_000)

    jobs = {
        "csv_ingest": lambda: ingest_csv(spark, csv, path("ingest")),
        "build_postings": lambda: build_postings(logs),
        "build_postings_documents": lambda: build_postings(docs),
        "build_clustered": build_clustered,
        "keyword_scan": lambda: drain(sl.search_exact(logs, "error")),
        "keyword_scan_documents": lambda: drain(sl.search_exact(docs, "the")),
        "keyword_postings": lambda: drain(sl.posting_hits(postings, keyword="77")),
        "prefix_scan": lambda: drain(sl.search_prefix(logs, "purch")),
        "prefix_postings": lambda: drain(sl.posting_hits(postings, prefix="user_7")),
        "wildcard_scan": lambda: drain(sl.search_wildcard(logs, "s*p")),
        "wildcard_scan_documents": lambda: drain(sl.search_wildcard(docs, "t*n")),
        "wildcard_postings": lambda: drain(sl.posting_hits(postings, wildcard="s*p")),
        "substring_scan": lambda: drain(sl.search_substring(logs, "error user_7")),
        "time_range_scan": lambda: drain(sl.search_time_range(logs, *near)),
        "time_range_clustered": lambda: drain(sl.search_time_range(clustered, *near)),
        "time_exact_clustered": lambda: drain(sl.search_time_exact(clustered, extent.min_ms)),
        "compound": lambda: drain(
            sl.compound(clustered, keyword="error", service="Payment", start_ms=near[0], end_ms=near[1])
        ),
        "compound_whole_table": lambda: drain(sl.compound(logs, keyword="error", service="Payment")),
        "scatter_gather": lambda: drain(sl.scatter_gather(logs, 3, keyword="error")),
        "batch_1000": lambda: drain(sl.batch_search(clustered, asked)),
        "separate_20": lambda: separate(spark, clustered, asked),
        "keyword_indexed_search": lambda: drain(sl.search_indexed(clustered, postings, keyword="77", level="ERROR")),
        "top_k_errors": lambda: sl.top_k_errors(logs, 10).collect(),
        "anomalies": lambda: sl.detect_anomalies(logs)[0].collect(),
        "templates": lambda: sl.template_counts(logs).collect(),
        "templates_documents": lambda: sl.template_counts(docs).collect(),
        "shard_load": lambda: sl.shard_load(logs).collect(),
    }

    seconds = {}
    for name, job in jobs.items():
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            job()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 4)

    found = logs.where(F.col("epoch_ms") >= middle).orderBy("epoch_ms").first()
    word = found.message.split()[-1].rstrip("}")
    rare = sl.search_indexed(clustered, postings, keyword=word, start_ms=found.epoch_ms, end_ms=near[1])
    reads = {
        "time_range_scan": files_read(sl.search_time_range(logs, *near)),
        "time_range_clustered": files_read(sl.search_time_range(clustered, *near)),
        "keyword_scan": files_read(sl.search_exact(logs, "77")),
        "rare_keyword_indexed": files_read(rare),
    }

    row_jobs = {
        "csv_ingest": n_logs,
        "build_postings": n_logs,
        "build_postings_documents": n_docs,
        "build_clustered": n_logs,
        "keyword_scan": n_logs,
        "wildcard_scan": n_logs,
        "top_k_errors": n_logs,
        "anomalies": n_logs,
        "templates": n_logs,
    }
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": {"events": n_logs, "documents": n_docs},
                "rows_per_sec": {k: round(n / seconds[k]) for k, n in row_jobs.items()},
                "per_query_ms": {
                    "batch_1000": round(seconds["batch_1000"] * 1000 / n_batch, 3),
                    "separate": round(seconds["separate_20"] * 1000 / SEPARATE, 3),
                },
                "read": reads,
            }
        )
    )


if __name__ == "__main__":
    main()
