
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sievelog as sl
from sievelog import streaming
from sievelog.functions.keys import shard_id
from sievelog.functions.timestamps import format_epoch, parse_epoch
from sievelog.operators.lifecycle import with_defaults, with_ids
from sievelog.sources.csv_logs import ingest_csv

COLS = ["log_id", "epoch_ms", "level", "service", "message"]
WEEK = (1_704_672_000_000, 1_705_276_799_999)
BASE_MS = sl.sources.views.DOCUMENT_BASE_MS
WINDOW = 300_000
AVAILABLE = {"availableNow": True}


# ---- inputs ---------------------------------------------------------------------


def events(spark: SparkSession, sf: str) -> DataFrame:
    sl.use_utc(spark)
    return sl.logs_from_events(spark.read.parquet(f"{sf}/events.parquet"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    sl.use_utc(spark)
    return sl.logs_from_documents(spark.read.parquet(f"{sf}/documents.parquet"))


def shown(rows: DataFrame) -> DataFrame:
    return rows.select(*COLS)


def clustered(spark: SparkSession, logs: DataFrame) -> DataFrame:
    path = sl.scratch_path(spark, "clustered")
    sl.write_clustered(logs, path)
    return sl.open_clustered(spark, path)


def indexed(spark: SparkSession, logs: DataFrame, index_fields: bool = True) -> DataFrame:
    path = sl.scratch_path(spark, "postings")
    sl.write_postings(sl.build_postings(logs, index_fields), path)
    return sl.open_postings(spark, path)


# ---- jobs that need more than one call ------------------------------------------


def compound_query(spark, sf):
    return shown(
        sl.compound(
            events(spark, sf), keyword="error", service="Payment", start_ms=WEEK[0], end_ms=WEEK[1]
        )
    )


def compound_glob(spark, sf):
    return shown(
        sl.compound_text(
            events(spark, sf), "s*p", level="warn", start="2024-01-08 00:00:00", end="1705276799999"
        )
    )


def token_wildcard_indexed(spark, sf):
    logs = documents(spark, sf)
    return shown(sl.search_indexed(clustered(spark, logs), indexed(spark, logs), wildcard="t*n"))


def token_exact_indexed(spark, sf):
    logs = events(spark, sf)
    postings = indexed(spark, logs, index_fields=False)
    rows = sl.search_indexed(
        clustered(spark, logs), postings, index_fields=False, keyword="payment", level="error"
    )
    return shown(rows)


def posting_prefix(spark, sf):
    hits = sl.posting_hits(indexed(spark, documents(spark, sf)), prefix="th", level="ERROR")
    return hits.select("log_id", "epoch_ms", "level", "service")


def time_range_clustered(spark, sf):
    return shown(sl.search_time_range(clustered(spark, events(spark, sf)), *WEEK))


def time_exact(spark, sf):
    logs = events(spark, sf)
    return shown(sl.search_time_exact(logs, sl.time_extent(logs).first()["min_ms"]))


def dedupe_by_id(spark, sf):
    logs = events(spark, sf)
    return shown(sl.search_prefix(logs.unionByName(logs), "user_", unique_ids=False))


def merge_by_time(spark, sf):
    logs = sl.with_shard(events(spark, sf), 3)
    shards = [sl.matching(logs.where(F.col("shard") == n), keyword="click") for n in range(3)]
    return shown(sl.merge_by_time(*shards))


def scatter_gather(spark, sf):
    rows = sl.scatter_gather(events(spark, sf), keyword="error", service="Payment")
    return rows.select("shard", *COLS)


def sharded_table(spark, sf):
    path = sl.scratch_path(spark, "sharded")
    sl.write_sharded(events(spark, sf), path, 4)
    stored = spark.read.parquet(path).withColumn("shard", F.col("shard").cast("bigint"))
    rows = sl.scatter_gather(stored, 4, only=[1, 3], level="error")
    return rows.select("shard", *COLS)


def shard_ids(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    ids = orders.select("o_orderkey", (F.col("o_orderkey") * 10_000_000_019 - 5 * 10**13).alias("log_id"))
    return ids.select("o_orderkey", "log_id", shard_id(F.col("log_id"), 7).alias("shard"))


def zscore_baseline(spark, sf):
    _, baseline = sl.detect_anomalies(events(spark, sf))
    return baseline.select(
        "status", "num_windows", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev")
    )


def zscore_alerts(spark, sf):
    alerts, _ = sl.detect_anomalies(events(spark, sf))
    return alerts.select("bucket", "start_ms", "end_ms", "errors", F.round("z", 6).alias("z"))


def zscore_all_windows(spark, sf):
    alerts, _ = sl.detect_anomalies(events(spark, sf), z=-10.0, window_ms=3_600_000)
    return alerts.select("bucket", "start_ms", "end_ms", "errors", F.round("z", 6).alias("z"))


def parse_format_epoch(spark, sf):
    sl.use_utc(spark)
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    text = F.when(F.col("o_orderkey") % 5 == 0, day).otherwise(
        F.concat(F.lit("  "), day, F.lit(" 01:02:03 "))
    )
    epoch = parse_epoch(text)
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey",
        epoch.alias("epoch_ms"),
        format_epoch(epoch + 999).alias("formatted"),
    )


def sample_logs(spark, sf):
    sl.use_utc(spark)
    numbers = spark.read.parquet(f"{sf}/events.parquet").select((F.col("event_id") + 1).alias("i"))
    return sl.sample_rows(numbers, "i", BASE_MS).select("timestamp", *COLS)


def _blanked(logs: DataFrame) -> DataFrame:
    """Events as raw records with some fields left blank."""
    blank = lambda every, value: F.when(F.col("log_id") % every == 0, F.lit("  ")).otherwise(value)
    return logs.select(
        F.col("log_id").alias("event_id"),
        F.when(F.col("log_id") % 6 != 0, F.col("log_id")).alias("log_id"),
        blank(5, F.col("timestamp")).alias("timestamp"),
        blank(4, F.lower("level")).alias("level"),
        blank(3, F.col("service")).alias("service"),
        F.concat(F.lit(" "), F.col("log_id").cast("string"), F.lit(" "), "message").alias("message"),
    )


def ingest_defaults(spark, sf):
    now = F.timestamp_millis(F.lit(BASE_MS))
    return with_defaults(_blanked(events(spark, sf)), now).select("timestamp", *COLS)


def assigned_ids(spark, sf):
    logs = events(spark, sf)
    rows = with_ids(with_defaults(_blanked(logs)), logs)
    top = logs.agg(F.max("log_id")).scalar()
    return rows.agg(
        F.count("*").alias("records"),
        F.count_distinct("log_id").alias("ids"),
        F.count_if(F.col("log_id") > top).alias("new_ids"),
    )


def append_records(spark, sf):
    table = sl.scratch_path(spark, "append")
    logs = events(spark, sf)
    now = F.timestamp_millis(F.lit(BASE_MS))
    for batch in (0, 1):
        part = logs.where(F.col("log_id") % 2 == batch)
        sl.append_logs(spark, table, part, batch, now)
    stored = sl.open_logs(spark, table)
    return stored.select("batch_id", *COLS)


def _ids_to_delete(spark, sf):
    """Ids of customers, some of which are event ids and some not."""
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    return customer.select((F.col("c_custkey") * 9 - 100).alias("log_id"))


def delete_by_id(spark, sf):
    return shown(sl.delete_by_id(events(spark, sf), _ids_to_delete(spark, sf)))


def delete_found(spark, sf):
    return sl.found_ids(events(spark, sf), _ids_to_delete(spark, sf))


def delete_postings(spark, sf):
    postings = sl.build_postings(events(spark, sf))
    kept = sl.delete_by_id(postings, _ids_to_delete(spark, sf))
    return kept.select("token", "log_id", "epoch_ms", "level", "service")


def tombstones(spark, sf):
    """Two batches, a deletion between them, the same ids again, then compaction."""
    logs = events(spark, sf)
    table, stones = sl.scratch_path(spark, "live"), sl.scratch_path(spark, "stones")
    sl.append_logs(spark, table, logs, 0)
    sl.add_tombstones(_ids_to_delete(spark, sf), stones, 0)
    sl.append_logs(spark, table, logs.where("log_id % 2 = 0"), 1)
    target = sl.scratch_path(spark, "compacted")
    sl.compact(spark, table, sl.open_tombstones(spark, stones), target)
    return sl.open_logs(spark, target).select("batch_id", "log_id", "level", "service", "message")


def postings(spark, sf):
    rows = indexed(spark, documents(spark, sf))
    return rows.select("token", "log_id", "epoch_ms", "level", "service")


def token_dictionary(spark, sf):
    return sl.token_dictionary(sl.build_postings(documents(spark, sf)))


def _event_queries(spark, sf):
    """One query per customer, cycling through all kinds of text, time and field filters."""
    n = F.col("c_custkey")
    kind = n % 8
    text = lambda *pairs: F.coalesce(*[F.when(kind == k, v) for k, v in pairs])
    start = F.lit(BASE_MS) + (n % 29) * 86_400_000
    return spark.read.parquet(f"{sf}/customer.parquet").select(
        n.alias("query_id"),
        text((0, F.lit("Error")), (1, (n % 100).cast("string"))).alias("keyword"),
        text((2, F.concat(F.lit("user_"), (n % 10).cast("string"))), (0, F.lit("ignored"))).alias("prefix"),
        text(
            (3, F.lit("s*p")),
            (4, F.lit("*ase")),
            (5, F.lit("*ic*")),
            (6, F.lit("*")),
        ).alias("wildcard"),
        F.when(n % 3 != 0, start).alias("start_ms"),
        F.when(n % 3 != 0, start + 3_600_000 * (n % 50)).alias("end_ms"),
        F.when(n % 4 == 1, "all").when(n % 4 == 2, "error").alias("level"),
        F.when(n % 5 == 2, "Payment").when(n % 5 == 3, "auth").when(n % 5 == 4, "ALL").alias("service"),
    )


def batch_search(spark, sf):
    rows = sl.batch_search(events(spark, sf), _event_queries(spark, sf))
    return rows.select("query_id", "log_id", "epoch_ms")


def batch_search_indexed(spark, sf):
    logs = events(spark, sf)
    found = sl.batch_search(
        clustered(spark, logs), _event_queries(spark, sf), postings=indexed(spark, logs)
    )
    return found.select("query_id", "log_id", "epoch_ms")


def batch_search_documents(spark, sf):
    """Every benchmark item's first word as prefix, its last as keyword, over all documents."""
    words = F.filter(F.split(F.lower("text"), r"\W+"), lambda w: w != "")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").withColumn("w", words)
    none = F.lit(None)
    queries = items.select(
        F.col("item_id").alias("query_id"),
        F.when(F.col("item_id") % 2 == 0, F.element_at("w", -1)).alias("keyword"),
        F.get("w", F.lit(0)).alias("prefix"),
        none.cast("string").alias("wildcard"),
        none.cast("bigint").alias("start_ms"),
        none.cast("bigint").alias("end_ms"),
        F.when(F.col("item_id") % 3 == 0, "ERROR").alias("level"),
        F.lit("ALL").alias("service"),
    )
    return sl.batch_search(documents(spark, sf), queries).select("query_id", "log_id", "level")


def csv_roundtrip(spark, sf):
    path = sl.scratch_path(spark, "csv")
    sl.write_csv(events(spark, sf), path)
    logs, _ = sl.read_logs_csv(spark, path)
    return logs.select("timestamp", "ts_valid", *COLS)


def _messy_csv(spark, sf) -> str:
    """Events as text lines, some of them short, long, padded, quoted or without an id."""
    path = sl.scratch_path(spark, "messy")
    logs = events(spark, sf)
    n = F.col("log_id")
    comma = F.lit(",")
    quoted = F.concat(F.lit('"'), F.replace(F.col("message"), F.lit('"'), F.lit('""')), F.lit('"'))
    head = F.concat_ws(",", n.cast("string"), "timestamp", "level", "service")
    line = (
        F.when(n % 10 == 1, head)
        .when(n % 10 == 2, F.concat(F.lit("x"), head, comma, quoted))
        .when(n % 10 == 3, F.concat(head, comma, quoted, F.lit(",extra,cols")))
        .when(n % 10 == 4, F.concat_ws(",", n.cast("string"), F.lit("not-a-time"), "level", "service", quoted))
        .when(n % 10 == 5, F.concat_ws(" , ", n.cast("string"), "timestamp", "level", "service", quoted))
        .when(n % 10 == 6, F.concat(head, F.lit(',"a, b, ""c""",more')))
        .when(n % 10 == 7, F.concat(head, comma))
        .otherwise(F.concat(head, comma, quoted))
    )
    header = F.when(n == 0, F.array(F.lit("LogID,Timestamp,Level,Service,Message"), F.lit("  "), line))
    logs.select(F.explode(F.coalesce(header, F.array(line))).alias("value")).write.text(path)
    return path


def csv_messy(spark, sf):
    logs, _ = sl.read_logs_csv(spark, _messy_csv(spark, sf))
    return logs.select("timestamp", "ts_valid", *COLS)


def csv_rejects(spark, sf):
    _, rejects = sl.read_logs_csv(spark, _messy_csv(spark, sf), on_bad_ts="reject")
    return rejects.select(F.substring_index("raw", ",", 1).alias("id_text"), "reason")


def csv_ingest_counts(spark, sf):
    table = sl.scratch_path(spark, "ingest")
    seen = ingest_csv(spark, _messy_csv(spark, sf), table)
    stored = sl.open_logs(spark, table).agg(F.count("*").alias("stored"))
    counts = [F.lit(seen[c]).cast("bigint").alias(c) for c in ("accepted", "rejected", "bad_timestamps")]
    return stored.select("stored", *counts)


def stream_ingest(spark, sf):
    source, table = sl.scratch_path(spark, "arriving"), sl.scratch_path(spark, "ingested")
    sl.write_csv(events(spark, sf).repartition(4, "log_id"), source)
    parsed = streaming.stream_logs_csv(spark, source, max_files=2)
    streaming.start_ingest(
        parsed, table, sl.scratch_path(spark, "ingest-state"), **AVAILABLE
    ).awaitTermination()
    return shown(sl.open_logs(spark, table))


def _event_stream(spark, sf, part="true") -> DataFrame:
    """Events as a file stream, closed by one row far in the future."""
    source = sl.scratch_path(spark, "event-stream")
    logs = events(spark, sf).where(part)
    last = logs.orderBy(F.desc("epoch_ms")).limit(1)
    end = last.withColumn("epoch_ms", F.col("epoch_ms") + 10 * 86_400_000)
    end = end.withColumn("ts", F.timestamp_millis("epoch_ms"))
    logs.unionByName(end).write.parquet(source)
    return spark.readStream.schema(sl.LOG_SCHEMA).parquet(source)


def stream_error_counts(spark, sf):
    sink = sl.scratch_path(spark, "counts")
    counts = streaming.stream_error_counts(_event_stream(spark, sf))
    streaming.start_counts(
        counts, sink, sl.scratch_path(spark, "counts-state"), **AVAILABLE
    ).awaitTermination()
    return spark.read.schema("start_ms BIGINT, end_ms BIGINT, errors BIGINT").parquet(sink)


def stream_alerts(spark, sf):
    sink = sl.scratch_path(spark, "alerts")
    baseline = sl.materialise(sl.error_baseline(events(spark, sf)), "baseline")
    counts = streaming.stream_error_counts(_event_stream(spark, sf))
    streaming.start_alerts(
        counts, baseline, sink, sl.scratch_path(spark, "alerts-state"), **AVAILABLE
    ).awaitTermination()
    alerts = spark.read.schema("start_ms BIGINT, end_ms BIGINT, errors BIGINT, z DOUBLE").parquet(sink)
    return alerts.select("start_ms", "end_ms", "errors", F.round("z", 6).alias("z"))


# ---- tables that grow -----------------------------------------------------------


def csv_ingest_twice(spark, sf):
    """Two halves of the events, one call each, no batch named."""
    table = sl.scratch_path(spark, "twice")
    for half in (0, 1):
        path = sl.scratch_path(spark, "half")
        sl.write_csv(events(spark, sf).where(F.col("log_id") % 2 == half), path)
        ingest_csv(spark, path, table)
    return sl.open_logs(spark, table).select("batch_id", *COLS)


def stream_into_existing(spark, sf):
    """One half is there already, a stream brings the other, and a second stream the first again."""
    table = sl.scratch_path(spark, "joined")
    sl.append_logs(spark, table, events(spark, sf).where("log_id % 2 = 0"))
    for half in (1, 0):
        source = sl.scratch_path(spark, "arriving")
        sl.write_csv(events(spark, sf).where(F.col("log_id") % 2 == half), source)
        streaming.start_ingest(
            streaming.stream_logs_csv(spark, source), table, sl.scratch_path(spark, "state"), **AVAILABLE
        ).awaitTermination()
    return sl.open_logs(spark, table).select("log_id", "level", "service", "message")


def compact_keeps_rejects(spark, sf):
    table, target = sl.scratch_path(spark, "raw"), sl.scratch_path(spark, "compacted")
    ingest_csv(spark, _messy_csv(spark, sf), table)
    stones = sl.scratch_path(spark, "stones")
    sl.add_tombstones(_ids_to_delete(spark, sf), stones, 0)
    sl.compact(spark, table, sl.open_tombstones(spark, stones), target)
    rows = sl.open_logs(spark, target).select(F.lit("row").alias("kind"), F.col("log_id").cast("string").alias("id_text"))
    rejects = sl.open_rejects(spark, target)
    return rows.unionByName(rejects.select(F.lit("reject").alias("kind"), F.substring_index("raw", ",", 1).alias("id_text")))


def csv_long_lines(spark, sf):
    """Every event with commas, 50,000 in every twentieth, in quotes, in the message or after it."""
    path = sl.scratch_path(spark, "long")
    n = F.col("log_id")
    commas = F.repeat(F.lit(","), F.when(n % 20 == 0, 50_000).otherwise(50))
    head = F.concat_ws(",", n.cast("string"), "timestamp", "level", "service")
    line = (
        F.when(n % 3 == 0, F.concat(head, F.lit(',"a'), commas, F.lit('"')))
        .when(n % 3 == 1, F.concat(head, F.lit(",b"), commas))
        .otherwise(F.concat(head, F.lit(',"c ""q"""'), commas, F.lit('"x"')))
    )
    # Compressed files cannot be split, so no file holds more lines than a task should read.
    files = events(spark, sf).select(line.alias("value")).write.option("maxRecordsPerFile", 10_000)
    files.text(path, compression="gzip")
    logs, _ = sl.read_logs_csv(spark, path)
    return logs.select("log_id", F.length("message").alias("chars"), F.left("message", F.lit(5)).alias("begin"))


def _in_two_batches(spark, sf, index_fields=True):
    """A clustered table and its postings, the events of odd id appended, and stones for the first batch."""
    logs = events(spark, sf)
    raw, path, words = (sl.scratch_path(spark, n) for n in ("raw", "clustered", "postings"))
    for batch in (0, 1):
        stored = sl.append_logs(spark, raw, logs.where(F.col("log_id") % 2 == batch))
        sl.append_clustered(stored, path, batch)
        sl.append_postings(stored, words, batch, index_fields)
    stones = sl.scratch_path(spark, "stones")
    sl.add_tombstones(_ids_to_delete(spark, sf), stones, 0)
    return path, words, sl.open_tombstones(spark, stones)


def append_clustered(spark, sf):
    path, _, stones = _in_two_batches(spark, sf)
    target = sl.scratch_path(spark, "gathered")
    sl.compact_clustered(sl.open_clustered(spark, path, stones, with_batch=True), target)
    return sl.open_clustered(spark, target).select(F.col("log_date").cast("string").alias("day"), "log_id", "level", "service", "message")


def append_postings(spark, sf):
    _, words, stones = _in_two_batches(spark, sf)
    return sl.open_postings(spark, words, stones).select("token", "log_id", "level", "service")


def compact_postings(spark, sf):
    _, words, stones = _in_two_batches(spark, sf, index_fields=False)
    target = sl.scratch_path(spark, "postings")
    sl.compact_postings(spark, words, stones, target)
    return sl.open_postings(spark, target).select("token", "log_id", "level", "service")


def stored_dictionary(spark, sf):
    _, words, _ = _in_two_batches(spark, sf)
    table = sl.scratch_path(spark, "dictionary")
    for batch in (0, 1):
        rows = sl.open_posting_batches(spark, words).where(F.col("batch_id") == batch)
        sl.append_dictionary(rows, table, batch)
    return sl.open_dictionary(spark, table).select("token", "df")


def search_indexed_after_delete(spark, sf):
    """For postings with and without level and service."""
    found = []
    for fields in (True, False):
        path, words, stones = _in_two_batches(spark, sf, fields)
        rows = sl.search_indexed(
            sl.open_clustered(spark, path, stones), sl.open_postings(spark, words, stones), keyword="error", level="ERROR"
        )
        found.append(rows.select(F.lit(fields).alias("fields"), "log_id", "level", "service", "message"))
    return found[0].unionByName(found[1])


def batch_search_plans(spark, sf):
    """Null levels and services and repeated queries, on every plan."""
    logs = events(spark, sf)
    n = F.col("log_id")
    logs = sl.materialise(
        logs.withColumns({"level": F.when(n % 7 != 0, F.col("level")), "service": F.when(n % 11 != 0, F.col("service"))}), "nulls"
    )
    queries = _event_queries(spark, sf)
    queries = queries.unionByName(queries)
    plans = {
        "broadcast": {},
        "shuffle": {"broadcast_rows": 0},
        "postings": {"postings": indexed(spark, logs)},
        "words": {"postings": indexed(spark, logs, index_fields=False)},
    }
    found = [
        sl.batch_search(logs, queries, **how).select(F.lit(name).alias("plan"), "query_id", "log_id", "epoch_ms")
        for name, how in plans.items()
    ]
    return reduce(DataFrame.unionByName, found)


def zoned_times(spark, sf):
    """Wall clocks of New York read, filled in and searched, in a session of another zone."""
    zone, session = "America/New_York", spark.conf.get("spark.sql.session.timeZone")
    raw = events(spark, sf).select("log_id", "timestamp", "level", "service", "message")
    raw = raw.withColumn("timestamp", F.when(F.col("log_id") % 4 != 0, F.col("timestamp")))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        table = sl.scratch_path(spark, "zoned")
        stored = sl.append_logs(spark, table, raw, now=F.timestamp_millis(F.lit(BASE_MS)), zone=zone)
        return sl.materialise(
            sl.search_time_text(stored, "2024-01-01 00:00:00", "2024-01-20 12:00:00", zone=zone).unionByName(
                stored.where(F.col("epoch_ms") == BASE_MS)
            ).select("log_id", "timestamp", "epoch_ms"),
            "zoned",
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", session)


# ---- a store: one call for all tables ---------------------------------------------


def _raw_events(spark, sf) -> DataFrame:
    return events(spark, sf).select("log_id", "timestamp", "level", "service", "message")


def store_after_two_batches(spark, sf):
    """Even events by a call, a deletion, odd events by a stream; rows of every table."""
    store = sl.create_store(spark, sl.scratch_path(spark, "store"))
    store.append(_raw_events(spark, sf).where("log_id % 2 = 0"))
    store.delete(_ids_to_delete(spark, sf))
    source = sl.scratch_path(spark, "arriving")
    sl.write_csv(events(spark, sf).where("log_id % 2 = 1"), source)
    store.start_ingest(streaming.stream_logs_csv(spark, source), sl.scratch_path(spark, "store-state"), **AVAILABLE).awaitTermination()
    store = sl.open_store(spark, store.path)
    rows = [
        store.logs().groupBy(F.lit("logs").alias("kind"), F.concat_ws("/", "service", "level").alias("name")).agg(F.count("*").alias("n")),
        store.postings().groupBy(F.lit("postings").alias("kind"), F.col("token").alias("name")).agg(F.count("*").alias("n")),
        store.dictionary().select(F.lit("dictionary").alias("kind"), F.col("token").alias("name"), F.col("df").alias("n")),
        store.raw().agg(F.lit("raw").alias("kind"), F.lit("").alias("name"), F.count("*").alias("n")),
    ]
    return reduce(DataFrame.unionByName, rows)


def _store_with_deletions(spark, sf):
    store = sl.create_store(spark, sl.scratch_path(spark, "store"), index_fields=False)
    for batch in (0, 1):
        store.append(_raw_events(spark, sf).where(F.col("log_id") % 2 == batch))
    store.delete(_ids_to_delete(spark, sf))
    return store


def windows_after_delete(spark, sf):
    alerts, _ = _store_with_deletions(spark, sf).anomalies()
    return alerts.select("bucket", "start_ms", "end_ms", "errors", F.round("z", 6).alias("z"))


def dictionary_after_delete(spark, sf):
    days = _store_with_deletions(spark, sf).dictionary()
    return days.select("token", "df", *[F.col(c).cast("string").alias(c) for c in ("first_day", "last_day")])


def search_two_words(spark, sf):
    return shown(_store_with_deletions(spark, sf).search(words=["error", "click"], service="payment"))


def search_headless_globs(spark, sf):
    """Globs that begin with a star, resolved by reversed tokens and by grams, over a store."""
    store = _store_with_deletions(spark, sf)
    found = [store.search(wildcard=w, level="warn").select(F.lit(w).alias("pattern"), *COLS) for w in ("*ick", "*_1*", "*a*ch")]
    return reduce(DataFrame.unionByName, found)


def _refused(append) -> None:
    try:
        append()
    except ValueError:
        return
    raise AssertionError("a batch of another source was replaced")


def append_clustered_again(spark, sf):
    """Other rows under a number that is taken are refused; under the next one they are added."""
    logs, path = events(spark, sf), sl.scratch_path(spark, "clustered")
    sl.write_clustered(logs.where("log_id % 2 = 0"), path)
    odd = logs.where("log_id % 2 = 1")
    _refused(lambda: sl.append_clustered(odd, path, 0))
    sl.append_clustered(odd, path, 1)
    return shown(sl.open_clustered(spark, path))


def append_postings_again(spark, sf):
    logs, path = events(spark, sf), sl.scratch_path(spark, "postings")
    sl.write_postings(sl.build_postings(logs.where("log_id % 2 = 0")), path)
    odd = logs.where("log_id % 2 = 1")
    _refused(lambda: sl.append_postings(odd, path, 0))
    sl.append_postings(odd, path, 1)
    return sl.open_postings(spark, path).select("token", "log_id", "epoch_ms", "level", "service")


def alerts_of_two_streams(spark, sf):
    """Two streams, one for each half of the events, share a sink."""
    sink = sl.scratch_path(spark, "alerts")
    baseline = sl.materialise(sl.error_baseline(events(spark, sf)), "baseline")
    for half in (0, 1):
        counts = streaming.stream_error_counts(_event_stream(spark, sf, F.col("log_id") % 2 == half))
        streaming.start_alerts(counts, baseline, sink, sl.scratch_path(spark, "alerts-state"), 1.0, **AVAILABLE).awaitTermination()
    alerts = spark.read.schema("start_ms BIGINT, end_ms BIGINT, errors BIGINT, z DOUBLE").parquet(sink)
    return alerts.select("start_ms", "end_ms", "errors", F.round("z", 6).alias("z"))


def stream_alerts_moving(spark, sf):
    """Alerts of a baseline per service that follows the stream, kept in its state."""
    sink, kept = sl.scratch_path(spark, "moving"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(kept)
    streaming.use_rocksdb(spark)
    try:
        alerts = streaming.stream_moving_alerts(_event_stream(spark, sf), z=2.0, window_ms=3_600_000)
        streaming.start_moving_alerts(alerts, sink, sl.scratch_path(spark, "moving-state"), **AVAILABLE).awaitTermination()
    finally:
        spark.conf.set(kept, before)
    return _moving(spark.read.schema(streaming.MOVING_SCHEMA).parquet(sink))


def moving_alerts(spark, sf):
    return _moving(streaming.moving_alerts(events(spark, sf), z=2.0, window_ms=3_600_000))


def _moving(alerts):
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "stddev", "z")]
    return alerts.select("service", "start_ms", "end_ms", "errors", "windows", *rounded)


# ---- searches whose rows share ids and times ------------------------------------


def _twins(spark, sf) -> DataFrame:
    """Each event and, for every third, a twin of the same id: earlier, of the same time or later."""
    logs = events(spark, sf)
    moved = F.col("epoch_ms") + (F.col("log_id") % 9 / 3 - 1).cast("bigint") * 1000
    twins = logs.where("log_id % 3 = 0").withColumns({"epoch_ms": moved, "message": F.concat(F.lit("user_ twin "), "message")})
    return logs.unionByName(twins)


def dedupe_twins(spark, sf):
    return shown(sl.search_prefix(_twins(spark, sf), "user_", unique_ids=False))


def time_exact_ties(spark, sf):
    """The events of the second in which the first one falls, all moved to its millisecond."""
    logs = events(spark, sf).withColumn("epoch_ms", F.floor(F.col("epoch_ms") / 86_400_000) * 86_400_000)
    return shown(sl.search_time_exact(logs, sl.time_extent(logs).first()["min_ms"]))


def match_count_subset(spark, sf):
    return sl.match_count(sl.matching(events(spark, sf), prefix="user_3", level="error"))


# ---- SQL twins ------------------------------------------------------------------

LE = """le AS (
  SELECT event_id AS log_id, epoch_us(ts) // 1000 AS epoch_ms,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
         ['API', 'Database', 'Auth', 'Payment', 'Server'][(user_id % 5)::INT + 1] AS service,
         event_type || ' user_' || (user_id % 10)::VARCHAR || ' ' || props AS message,
         strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS stamp
  FROM events)"""
LD = f"""ld AS (
  SELECT doc_id AS log_id, {BASE_MS} + doc_id * 1000 AS epoch_ms,
         ['INFO', 'WARN', 'ERROR'][(doc_id % 3)::INT + 1] AS level,
         source AS service, text AS message
  FROM documents)"""
OUT = "log_id, epoch_ms, level, service, message"


def tokens(view: str) -> str:
    return f"""{view}_t AS (
  SELECT *, list_distinct(list_filter(list_concat([trim(lower(service)), trim(lower(level))],
              regexp_split_to_array(lower(message), '\\W+')), lambda t: t <> '')) AS tokens
  FROM {view})"""


def from_le(where: str, columns: str = OUT, with_tokens: bool = False) -> str:
    ctes, view = (f"{LE}, {tokens('le')}", "le_t") if with_tokens else (LE, "le")
    return f"WITH {ctes} SELECT {columns} FROM {view} WHERE {where}"


def from_ld(where: str, columns: str = OUT) -> str:
    return f"WITH {LD}, {tokens('ld')} SELECT {columns} FROM ld_t WHERE {where}"


ANY = "len(list_filter(tokens, lambda t: {})) > 0"
IN_WEEK = f"epoch_ms BETWEEN {WEEK[0]} AND {WEEK[1]}"
TEMPLATE = """trim(array_to_string(list_transform(
  list_transform(regexp_split_to_array(message, '\\s+'), lambda w: regexp_replace(w, '[^a-zA-Z0-9]', '', 'g')),
  lambda c: CASE WHEN regexp_matches(c, '[0-9]') THEN '<*>' ELSE c END), ' '))"""


def spikes(window: int, out: str) -> str:
    return f"""WITH {LE},
  x AS (SELECT min(epoch_ms) AS mn, max(epoch_ms) AS mx FROM le),
  spine AS (SELECT unnest(range(greatest(3, (mx - mn) // {window} + 1))) AS bucket FROM x),
  c AS (SELECT (epoch_ms - mn) // {window} AS bucket, count(*) AS errors
        FROM le, x WHERE level = 'ERROR' GROUP BY 1),
  w AS (SELECT spine.bucket, coalesce(c.errors, 0) AS errors FROM spine LEFT JOIN c USING (bucket)),
  b AS (SELECT count(*) AS n, avg(errors) AS mean, stddev_samp(errors) AS sd FROM w)
  {out}"""


def alert_sql(window: int, z: float) -> str:
    return spikes(
        window,
        f"""SELECT bucket, mn + bucket * {window} AS start_ms, mn + (bucket + 1) * {window} AS end_ms,
        errors, round((errors - mean) / sd, 6) AS z FROM w, b, x WHERE (errors - mean) / sd >= {z}""",
    )


TO_DELETE = "(SELECT c_custkey * 9 - 100 FROM customer)"

EVENT_QUERIES = f"""q AS (
  SELECT c_custkey AS query_id,
    CASE c_custkey % 8 WHEN 0 THEN 'error' WHEN 1 THEN (c_custkey % 100)::VARCHAR END AS keyword,
    CASE c_custkey % 8 WHEN 2 THEN 'user_' || (c_custkey % 10)::VARCHAR END AS prefix,
    CASE c_custkey % 8 WHEN 3 THEN 's%p' WHEN 4 THEN '%ase' WHEN 5 THEN '%ic%' WHEN 6 THEN '%' END AS wild,
    CASE WHEN c_custkey % 3 <> 0 THEN {BASE_MS} + (c_custkey % 29) * 86400000 END AS start_ms,
    CASE WHEN c_custkey % 3 <> 0
         THEN {BASE_MS} + (c_custkey % 29) * 86400000 + 3600000 * (c_custkey % 50) END AS end_ms,
    CASE c_custkey % 4 WHEN 2 THEN 'ERROR' END AS lvl,
    CASE c_custkey % 5 WHEN 2 THEN 'PAYMENT' WHEN 3 THEN 'AUTH' END AS svc
  FROM customer)"""
BATCH_SQL = f"""WITH {LE}, {tokens('le')}, {EVENT_QUERIES},
  tok AS (SELECT DISTINCT unnest(tokens) AS t FROM le_t),
  asked AS (SELECT q.*, t FROM q JOIN tok ON t = keyword OR starts_with(t, prefix) OR t LIKE wild),
  post AS (SELECT log_id, epoch_ms, level, service, unnest(tokens) AS t FROM le_t),
  hits AS (
    SELECT query_id, start_ms, end_ms, lvl, svc, log_id, epoch_ms, level, service FROM asked JOIN post USING (t)
    UNION ALL
    SELECT query_id, start_ms, end_ms, lvl, svc, log_id, epoch_ms, level, service FROM q JOIN le
      ON coalesce(keyword, prefix, wild) IS NULL)
  SELECT DISTINCT query_id, log_id, epoch_ms FROM hits
  WHERE (start_ms IS NULL OR epoch_ms BETWEEN start_ms AND end_ms)
    AND (lvl IS NULL OR upper(level) = lvl) AND (svc IS NULL OR upper(service) = svc)"""

NULLED = LE.replace("le AS (", "le0 AS (", 1) + """, le AS (
  SELECT log_id, epoch_ms, CASE WHEN log_id % 7 <> 0 THEN level END AS level,
         CASE WHEN log_id % 11 <> 0 THEN service END AS service, message, stamp FROM le0)"""
PLANS_SQL = f"""SELECT plan, query_id, log_id, epoch_ms FROM ({BATCH_SQL.replace(LE, NULLED)}),
  (SELECT unnest(['broadcast', 'shuffle', 'postings', 'words']) AS plan)"""
TWINS = """tw AS (
  SELECT log_id, epoch_ms, level, service, message FROM le UNION ALL
  SELECT log_id, epoch_ms + trunc(log_id % 9 / 3 - 1)::BIGINT * 1000, level, service, 'user_ twin ' || message FROM le WHERE log_id % 3 = 0)"""
LIVE = f"(log_id % 2 = 1 OR log_id NOT IN {TO_DELETE})"

#: Events as a store has them after the deletion: whole seconds, as their text says.
WHOLE_SECONDS = LE.replace("le AS (", "le0 AS (", 1) + f""", le AS (
  SELECT log_id, epoch_ms // 1000 * 1000 AS epoch_ms, level, service, message, stamp FROM le0 WHERE log_id NOT IN {TO_DELETE})"""

MOVING_SQL = f"""WITH {LE}, w AS (SELECT service, epoch_ms // 3600000 AS k, count(*) FILTER (level = 'ERROR') AS errors FROM le GROUP BY ALL),
  e AS (SELECT service, unnest(range(min(k), max(k) + 1)) AS k FROM w GROUP BY service),
  c AS (SELECT service, k, w.k IS NOT NULL AS met, coalesce(errors, 0) AS errors FROM e LEFT JOIN w USING (service, k)),
  s AS (SELECT *, count(*) OVER b AS windows, avg(errors) OVER b AS mean, stddev_samp(errors) OVER b AS sd FROM c
        WINDOW b AS (PARTITION BY service ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT service, k * 3600000 AS start_ms, (k + 1) * 3600000 AS end_ms, errors, windows, round(mean, 6) AS mean,
         round(sd, 6) AS stddev, round((errors - mean) / sd, 6) AS z
  FROM s WHERE met AND windows >= 3 AND sd >= 0.001 AND (errors - mean) / sd >= 2.0"""

CSV_OUT = "log_id, stamp AS timestamp, true AS ts_valid, (epoch_ms // 1000) * 1000 AS epoch_ms, level, service, message"
MESSY = f"""WITH {LE} SELECT log_id,
  CASE WHEN log_id % 10 = 4 THEN 'not-a-time' ELSE stamp END AS timestamp, log_id % 10 <> 4 AS ts_valid,
  CASE WHEN log_id % 10 = 4 THEN 0 ELSE (epoch_ms // 1000) * 1000 END AS epoch_ms, level, service,
  CASE log_id % 10 WHEN 6 THEN 'a, b, "c"' WHEN 7 THEN '' ELSE message END AS message
  FROM le WHERE log_id % 10 NOT IN (1, 2)"""

Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "token_exact": (
        lambda s, d: shown(sl.search_exact(events(s, d), "ERROR")),
        from_le("list_contains(tokens, 'error')", with_tokens=True),
    ),
    "token_prefix": (
        lambda s, d: shown(sl.search_prefix(documents(s, d), "Th")),
        from_ld(ANY.format("starts_with(t, 'th')")),
    ),
    "token_wildcard": (
        lambda s, d: shown(sl.search_wildcard(documents(s, d), "t*n")),
        from_ld(ANY.format("regexp_full_match(t, 't.*n')")),
    ),
    "token_wildcard_inner": (
        lambda s, d: shown(sl.search_wildcard(documents(s, d), "*q*r*t*")),
        from_ld(ANY.format("regexp_full_match(t, '.*q.*r.*t.*')")),
    ),
    "token_exact_indexed": (
        token_exact_indexed,
        from_le("list_contains(tokens, 'payment') AND level = 'ERROR'", with_tokens=True),
    ),
    "token_wildcard_indexed": (
        token_wildcard_indexed,
        from_ld(ANY.format("regexp_full_match(t, 't.*n')")),
    ),
    "posting_prefix": (
        posting_prefix,
        from_ld(ANY.format("starts_with(t, 'th')") + " AND level = 'ERROR'", "log_id, epoch_ms, level, service"),
    ),
    "time_range": (lambda s, d: shown(sl.search_time_range(events(s, d), *WEEK)), from_le(IN_WEEK)),
    "time_range_text": (
        lambda s, d: shown(sl.search_time_text(events(s, d), "2024-01-20 00:00:00", "")),
        from_le("epoch_ms >= 1705708800000"),
    ),
    "time_range_clustered": (time_range_clustered, from_le(IN_WEEK)),
    "time_exact": (time_exact, from_le("epoch_ms = (SELECT min(epoch_ms) FROM le)")),
    "level_filter": (lambda s, d: shown(sl.filter_level(events(s, d), "warn")), from_le("level = 'WARN'")),
    "service_filter": (
        lambda s, d: shown(sl.filter_service(events(s, d), "database")),
        from_le("service = 'Database'"),
    ),
    "compound_query": (
        compound_query,
        from_le(f"list_contains(tokens, 'error') AND service = 'Payment' AND {IN_WEEK}", with_tokens=True),
    ),
    "compound_glob": (
        compound_glob,
        from_le(ANY.format("regexp_full_match(t, 's.*p')") + f" AND level = 'WARN' AND {IN_WEEK}", with_tokens=True),
    ),
    "substring_scan": (
        lambda s, d: shown(sl.search_substring(documents(s, d), "TION th")),
        from_ld("contains(lower(message), 'tion th')"),
    ),
    "scatter_gather": (
        scatter_gather,
        from_le("list_contains(tokens, 'error') AND service = 'Payment'", f"log_id % 3 AS shard, {OUT}", True),
    ),
    "sharded_table": (
        sharded_table,
        from_le("log_id % 4 IN (1, 3) AND level = 'ERROR'", f"log_id % 4 AS shard, {OUT}"),
    ),
    "shard_ids": (
        shard_ids,
        """WITH i AS (SELECT o_orderkey, o_orderkey::BIGINT * 10000000019 - 50000000000000 AS log_id FROM orders),
        u AS (SELECT *, (xor(log_id, CASE WHEN log_id >= 0 THEN log_id >> 32
                ELSE ((log_id::HUGEINT + 18446744073709551616) // 4294967296)::BIGINT END)) & 4294967295 AS f FROM i),
        h AS (SELECT *, CASE WHEN f >= 2147483648 THEN f - 4294967296 ELSE f END AS h FROM u)
        SELECT o_orderkey, log_id, ((h % 7) + 7) % 7 AS shard FROM h""",
    ),
    "merge_by_time": (merge_by_time, from_le("list_contains(tokens, 'click')", with_tokens=True)),
    "match_count": (
        lambda s, d: sl.match_count(sl.matching(events(s, d), prefix="user_", level="error")),
        from_le("level = 'ERROR'", "count(*) AS matches"),
    ),
    "match_preview": (
        lambda s, d: shown(sl.preview(sl.matching(events(s, d), keyword="error"), 5)),
        from_le("list_contains(tokens, 'error') ORDER BY epoch_ms, log_id LIMIT 5", with_tokens=True),
    ),
    "dedupe_by_id": (dedupe_by_id, from_le("true")),
    "row_count": (
        lambda s, d: sl.row_count(events(s, d)),
        "SELECT count(*) AS records FROM events",
    ),
    "top_k_errors": (
        lambda s, d: sl.top_k_errors(events(s, d), 10),
        f"""WITH {LE} SELECT service || ': ' || message AS signature, count(*) AS count FROM le
        WHERE level IN ('ERROR', 'WARN') GROUP BY 1 ORDER BY count DESC, signature LIMIT 10""",
    ),
    "time_extent": (
        lambda s, d: sl.time_extent(events(s, d)),
        from_le("true", "min(epoch_ms) AS min_ms, max(epoch_ms) AS max_ms"),
    ),
    "error_windows": (
        lambda s, d: sl.error_windows(events(s, d)),
        spikes(
            WINDOW,
            f"""SELECT bucket, mn + bucket * {WINDOW} AS start_ms, mn + (bucket + 1) * {WINDOW} AS end_ms,
            errors FROM c, x""",
        ),
    ),
    "zscore_baseline": (
        zscore_baseline,
        spikes(
            WINDOW,
            "SELECT 'ok' AS status, n AS num_windows, round(mean, 6) AS mean, round(sd, 6) AS stddev FROM b",
        ),
    ),
    "zscore_alerts": (zscore_alerts, alert_sql(WINDOW, 2.0)),
    "zscore_all_windows": (zscore_all_windows, alert_sql(3_600_000, -10.0)),
    "templates": (
        lambda s, d: sl.template_counts(events(s, d)),
        f"""WITH {LE} SELECT {TEMPLATE} AS template, count(*) AS count FROM le
        GROUP BY 1 ORDER BY count DESC, template LIMIT 5""",
    ),
    "templates_documents": (
        lambda s, d: sl.template_counts(documents(s, d), limit=None),
        f"WITH {LD} SELECT {TEMPLATE} AS template, count(*) AS count FROM ld GROUP BY 1",
    ),
    "shard_load": (
        lambda s, d: sl.shard_load(events(s, d), 3),
        from_le(
            "true GROUP BY 1",
            "log_id % 3 AS shard, count(*) AS records, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM le) AS pct",
        ),
    ),
    "parse_format_epoch": (
        parse_format_epoch,
        """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0
             ELSE epoch_us(o_orderdate::DATE + INTERVAL 3723 SECOND) // 1000 END AS epoch_ms FROM orders)
        SELECT o_orderkey, epoch_ms, strftime(make_timestamp(epoch_ms * 1000), '%Y-%m-%d %H:%M:%S') AS formatted
        FROM o""",
    ),
    "sample_logs": (
        sample_logs,
        f"""WITH n AS (SELECT event_id + 1 AS i, {BASE_MS} + (event_id + 1) * 1000 AS epoch_ms FROM events)
        SELECT 100000 + i AS log_id, epoch_ms,
          strftime(make_timestamp(epoch_ms * 1000), '%Y-%m-%d %H:%M:%S') AS timestamp,
          ['INFO', 'WARN', 'ERROR'][(i % 3)::INT + 1] AS level,
          ['API', 'Database', 'Auth', 'Payment', 'Server'][(i % 5)::INT + 1] AS service,
          ['Connection failed to replica', 'Connection timeout on port 5432', 'Authentication token expired',
           'Payment transaction completed', 'High memory threshold exceeded',
           'Server worker thread started'][(i % 6)::INT + 1] || ' host_' || (i % 10)::VARCHAR AS message
        FROM n""",
    ),
    "ingest_defaults": (
        ingest_defaults,
        from_le(
            "true",
            f"""CASE WHEN log_id % 6 <> 0 THEN log_id END AS log_id,
            CASE WHEN log_id % 5 = 0 THEN '2024-01-01 00:00:00' ELSE stamp END AS timestamp,
            CASE WHEN log_id % 5 = 0 THEN {BASE_MS} ELSE (epoch_ms // 1000) * 1000 END AS epoch_ms,
            CASE WHEN log_id % 4 = 0 THEN 'INFO' ELSE level END AS level,
            CASE WHEN log_id % 3 = 0 THEN 'API' ELSE service END AS service,
            log_id::VARCHAR || ' ' || message AS message""",
        ),
    ),
    "assigned_ids": (
        assigned_ids,
        from_le("true", "count(*) AS records, count(*) AS ids, count(*) FILTER (log_id % 6 = 0) AS new_ids"),
    ),
    "append_records": (
        append_records,
        from_le(
            "true",
            "log_id % 2 AS batch_id, log_id, (epoch_ms // 1000) * 1000 AS epoch_ms, level, service, message",
        ),
    ),
    "delete_by_id": (delete_by_id, from_le(f"log_id NOT IN {TO_DELETE}")),
    "delete_found": (
        delete_found,
        "SELECT i.log_id, e.event_id IS NOT NULL AS found FROM (SELECT c_custkey * 9 - 100 AS log_id FROM customer) i "
        "LEFT JOIN events e ON e.event_id = i.log_id",
    ),
    "delete_postings": (
        delete_postings,
        from_le(
            f"log_id NOT IN {TO_DELETE}", "unnest(tokens) AS token, log_id, epoch_ms, level, service", True
        ),
    ),
    "tombstones": (
        tombstones,
        f"""WITH {LE} SELECT 0::BIGINT AS batch_id, log_id, level, service, message FROM le WHERE log_id NOT IN {TO_DELETE}
        UNION ALL SELECT 1, log_id, level, service, message FROM le WHERE log_id % 2 = 0""",
    ),
    "postings": (postings, from_ld("true", "unnest(tokens) AS token, log_id, epoch_ms, level, service")),
    "token_dictionary": (
        token_dictionary,
        f"""WITH {LD}, {tokens('ld')}, p AS (SELECT unnest(tokens) AS token, epoch_ms FROM ld_t)
        SELECT token, count(*) AS df, min(epoch_ms) AS min_epoch_ms, max(epoch_ms) AS max_epoch_ms
        FROM p GROUP BY token""",
    ),
    "batch_search": (batch_search, BATCH_SQL),
    "batch_search_indexed": (batch_search_indexed, BATCH_SQL),
    "batch_search_documents": (
        batch_search_documents,
        f"""WITH {LD}, {tokens('ld')},
        w AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda t: t <> '') AS w FROM benchmark),
        p AS (SELECT log_id, level, unnest(tokens) AS t FROM ld_t)
        SELECT DISTINCT item_id AS query_id, log_id, level FROM w JOIN p
          ON CASE WHEN item_id % 2 = 0 THEN t = w[-1] ELSE starts_with(t, w[1]) END
        WHERE item_id % 3 <> 0 OR level = 'ERROR'""",
    ),
    "batch_search_plans": (batch_search_plans, PLANS_SQL),
    "csv_ingest_twice": (
        csv_ingest_twice,
        from_le("true", "log_id % 2 AS batch_id, log_id, (epoch_ms // 1000) * 1000 AS epoch_ms, level, service, message"),
    ),
    "stream_into_existing": (
        stream_into_existing,
        f"WITH {LE}, n AS (SELECT unnest([0, 1, 0]) AS half) "
        "SELECT log_id, level, service, message FROM le JOIN n ON log_id % 2 = half",
    ),
    "compact_keeps_rejects": (
        compact_keeps_rejects,
        f"""WITH {LE} SELECT 'row' AS kind, log_id::VARCHAR AS id_text FROM le
        WHERE log_id % 10 NOT IN (1, 2) AND log_id NOT IN {TO_DELETE}
        UNION ALL SELECT 'reject', CASE log_id % 10 WHEN 2 THEN 'x' ELSE '' END || log_id::VARCHAR FROM le WHERE log_id % 10 IN (1, 2)""",
    ),
    "csv_long_lines": (
        csv_long_lines,
        from_le(
            "true",
            """log_id, CASE log_id % 3 WHEN 0 THEN CASE log_id % 20 WHEN 0 THEN 50001 ELSE 51 END WHEN 1 THEN 1 ELSE 5 END::INT AS chars,
            CASE log_id % 3 WHEN 0 THEN 'a,,,,' WHEN 1 THEN 'b' ELSE 'c "q"' END AS begin""",
        ),
    ),
    "append_clustered": (
        append_clustered,
        from_le(LIVE, "make_date((epoch_ms // 86400000)::INT)::VARCHAR AS day, log_id, level, service, message"),
    ),
    "append_postings": (
        append_postings,
        from_le(LIVE, "unnest(tokens) AS token, log_id, level, service", with_tokens=True),
    ),
    "compact_postings": (
        compact_postings,
        from_le(
            LIVE,
            "unnest(list_distinct(list_filter(regexp_split_to_array(lower(message), '\\W+'), lambda t: t <> ''))) AS token, log_id, level, service",
        ),
    ),
    "stored_dictionary": (
        stored_dictionary,
        f"WITH {LE}, {tokens('le')}, p AS (SELECT unnest(tokens) AS token FROM le_t) SELECT token, count(*) AS df FROM p GROUP BY token",
    ),
    "search_indexed_after_delete": (
        search_indexed_after_delete,
        f"WITH {LE} SELECT fields, log_id, level, service, message FROM le, (SELECT unnest([true, false]) AS fields) "
        f"WHERE level = 'ERROR' AND {LIVE}",
    ),
    "zoned_times": (
        zoned_times,
        f"""WITH {LE}, z AS (SELECT log_id, CASE WHEN log_id % 4 <> 0 THEN stamp ELSE '2023-12-31 19:00:00' END AS timestamp,
          CASE WHEN log_id % 4 <> 0 THEN (epoch_ms // 1000) * 1000 + 18000000 ELSE {BASE_MS} END AS epoch_ms FROM le)
        SELECT * FROM z WHERE epoch_ms BETWEEN 1704085200000 AND 1705770000000 UNION ALL SELECT * FROM z WHERE epoch_ms = {BASE_MS}""",
    ),
    "store_after_two_batches": (
        store_after_two_batches,
        f"""WITH {LE}, {tokens('le')}, live AS (SELECT * FROM le_t WHERE {LIVE}), p AS (SELECT unnest(tokens) AS name FROM live)
        SELECT 'logs' AS kind, service || '/' || level AS name, count(*) AS n FROM live GROUP BY ALL
        UNION ALL SELECT kind, name, count(*) FROM p, (SELECT unnest(['postings', 'dictionary']) AS kind) GROUP BY ALL
        UNION ALL SELECT 'raw', '', count(*) FROM le""",
    ),
    "windows_after_delete": (windows_after_delete, alert_sql(WINDOW, 2.0).replace(LE, WHOLE_SECONDS)),
    "dictionary_after_delete": (
        dictionary_after_delete,
        f"""WITH {WHOLE_SECONDS}, {tokens('le')}, p AS (SELECT unnest(tokens) AS token, make_date((epoch_ms // 86400000)::INT) AS day FROM le_t)
        SELECT token, count(*) AS df, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day FROM p GROUP BY token""",
    ),
    "search_two_words": (
        search_two_words,
        f"""WITH {WHOLE_SECONDS}, {tokens('le')} SELECT {OUT} FROM le_t
        WHERE list_contains(tokens, 'error') AND list_contains(tokens, 'click') AND upper(service) = 'PAYMENT'""",
    ),
    "search_headless_globs": (
        search_headless_globs,
        f"""WITH {WHOLE_SECONDS}, {tokens('le')}, g AS (SELECT unnest(['*ick', '*_1*', '*a*ch']) AS pattern)
        SELECT pattern, {OUT} FROM le_t, g WHERE level = 'WARN'
          AND len(list_filter(tokens, lambda t: regexp_full_match(t, replace(pattern, '*', '.*')))) > 0""",
    ),
    "append_clustered_again": (append_clustered_again, from_le("true")),
    "append_postings_again": (
        append_postings_again,
        from_le("true", "unnest(tokens) AS token, log_id, epoch_ms, level, service", with_tokens=True),
    ),
    "moving_alerts": (moving_alerts, MOVING_SQL),
    "stream_alerts_moving": (stream_alerts_moving, MOVING_SQL),
    "alerts_of_two_streams": (
        alerts_of_two_streams,
        spikes(
            WINDOW,
            """, s AS (SELECT log_id % 2 AS half, epoch_ms // 300000 AS k, count(*) FILTER (level = 'ERROR') AS errors FROM le GROUP BY ALL)
            SELECT k * 300000 AS start_ms, (k + 1) * 300000 AS end_ms, errors, round((errors - mean) / sd, 6) AS z
            FROM s, b WHERE (errors - mean) / sd >= 1.0""",
        ),
    ),
    "dedupe_twins": (
        dedupe_twins,
        f"""WITH {LE}, {TWINS}, r AS (SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY epoch_ms, service, level, message) AS n FROM tw)
        SELECT {OUT} FROM r WHERE n = 1""",
    ),
    "time_exact_ties": (
        time_exact_ties,
        f"""WITH {LE}, t AS (SELECT log_id, epoch_ms // 86400000 * 86400000 AS epoch_ms, level, service, message FROM le)
        SELECT {OUT} FROM t WHERE epoch_ms = (SELECT min(epoch_ms) FROM t)""",
    ),
    "match_count_subset": (
        match_count_subset,
        from_le("level = 'ERROR' AND regexp_matches(message, '\\buser_3')", "count(*) AS matches"),
    ),
    "csv_roundtrip": (csv_roundtrip, from_le("true", CSV_OUT)),
    "csv_messy": (csv_messy, MESSY),
    "csv_rejects": (
        csv_rejects,
        from_le(
            "log_id % 10 IN (1, 2, 4)",
            """CASE WHEN log_id % 10 = 2 THEN 'x' || log_id::VARCHAR ELSE log_id::VARCHAR END AS id_text,
            CASE log_id % 10 WHEN 1 THEN 'too_few_columns' WHEN 2 THEN 'bad_id' ELSE 'bad_timestamp' END AS reason""",
        ),
    ),
    "csv_ingest_counts": (
        csv_ingest_counts,
        from_le(
            "true",
            """count(*) FILTER (log_id % 10 NOT IN (1, 2)) AS stored, count(*) FILTER (log_id % 10 NOT IN (1, 2)) AS accepted,
            count(*) FILTER (log_id % 10 IN (1, 2)) AS rejected, count(*) FILTER (log_id % 10 = 4) AS bad_timestamps""",
        ),
    ),
    "stream_ingest": (
        stream_ingest,
        from_le("true", "log_id, (epoch_ms // 1000) * 1000 AS epoch_ms, level, service, message"),
    ),
    "stream_error_counts": (
        stream_error_counts,
        from_le(
            "true GROUP BY epoch_ms // 300000",
            """(epoch_ms // 300000) * 300000 AS start_ms, (epoch_ms // 300000 + 1) * 300000 AS end_ms,
            count(*) FILTER (level = 'ERROR') AS errors""",
        ),
    ),
    "stream_alerts": (
        stream_alerts,
        spikes(
            WINDOW,
            """, s AS (SELECT epoch_ms // 300000 AS k, count(*) FILTER (level = 'ERROR') AS errors FROM le GROUP BY 1)
            SELECT k * 300000 AS start_ms, (k + 1) * 300000 AS end_ms, errors, round((errors - mean) / sd, 6) AS z
            FROM s, b WHERE (errors - mean) / sd >= 2.0""",
        ),
    ),
}


def _training_text_queries():
    """Queries of the optional subpackage and its pipeline, if the folders are there."""
    try:
        import corpus_pipeline
        from sievelog.llm.queries import QUERIES
    except ModuleNotFoundError as missing:
        if not (missing.name or "").startswith(("sievelog.llm", "corpus_pipeline")):
            raise
        return {}
    return QUERIES | {"pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}


Q |= _training_text_queries()


def entry(spark: SparkSession) -> DataFrame:
    """Compound search: keyword, service and one week, ascending in time."""
    return compound_query(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in Q.items() if sql}
