"""Log tables on Parquet: batches as written by ingest, and the time-clustered table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievelog.functions.keys import stretch
from sievelog.functions.timestamps import log_date
from sievelog.schema import LOG_COLUMNS, LOG_SCHEMA
from sievelog.sources.batches import claim, digest_of
from sievelog.sources.csv_logs import REJECT_COLUMNS

RAW_SCHEMA = T.StructType(
    [
        *LOG_SCHEMA.fields,
        *[T.StructField(c, T.StringType()) for c in REJECT_COLUMNS],
        T.StructField("rejected", T.BooleanType()),
    ]
)
_BATCH_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("batch_id", T.LongType())])


def open_batches(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(_BATCH_SCHEMA).parquet(table)


def open_logs(spark: SparkSession, table: str) -> DataFrame:
    """Accepted rows of a batch table, with the batch they came in."""
    return open_batches(spark, table).where("NOT rejected").select(*LOG_COLUMNS, "batch_id")


def open_rejects(spark: SparkSession, table: str) -> DataFrame:
    return open_batches(spark, table).where("rejected").select(*REJECT_COLUMNS, "batch_id")


def with_log_date(logs: DataFrame) -> DataFrame:
    return logs.withColumn("log_date", log_date(F.col("epoch_ms")))


def write_clustered(
    logs: DataFrame, path: str, slot_ms: int = 3_600_000, stretch_rows: int = 1 << 20
) -> None:
    """Write a new log table in folders of batch and day, sorted by time inside each file.

    Rows keep their ``batch_id``, or are batch 0 if they have none.

    Rows are gathered by day and time slot, so a file covers few slots and the reader
    can skip by its statistics. Rebalancing needs no sampling pass over the logs and
    splits a crowded slot into files of the advisory size; ``stretch_rows`` takes apart
    rows that one task alone would add to a slot. ``logs`` must be a stored table.
    """
    if "batch_id" not in logs.columns:
        logs = logs.withColumn("batch_id", F.lit(0).cast("bigint"))
    rows = _gathered(_slots(logs, slot_ms, stretch_rows), ["batch_id"])
    rows.write.mode("errorifexists").partitionBy("batch_id", "log_date").parquet(path)


def append_clustered(
    logs: DataFrame,
    path: str,
    batch_id: int,
    slot_ms: int = 3_600_000,
    stretch_rows: int = 1 << 20,
    source: str | None = None,
) -> None:
    """Add one batch of stored logs to a clustered table; nothing that is there is read.

    A repeat by the same ``source`` overwrites the batch's folder; a batch of another source,
    or one that was there before, raises. Without a name the rows themselves are the source,
    which costs a pass over them.
    """
    claim(logs.sparkSession, path, source or digest_of(logs.drop("batch_id", "log_date")), batch_id)
    rows = _gathered(_slots(logs.drop("batch_id"), slot_ms, stretch_rows), [])
    rows.write.mode("overwrite").partitionBy("log_date").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def compact_clustered(
    live: DataFrame, target: str, slot_ms: int = 3_600_000, stretch_rows: int = 1 << 20
) -> None:
    """Live rows of a clustered table as a new table with one folder per day.

    Take them from ``open_clustered(..., tombstones, with_batch=True)``. They all become
    one batch, the highest of them, so deletions noted before are to be applied in ``live``.
    """
    last = live.agg(F.max("batch_id")).first()[0]
    # Rebalancing alone splits a crowded slot here: after a join rows have no fixed order.
    rows = _gathered(_slots(live.drop("batch_id"), slot_ms, None), [])
    rows.write.mode("errorifexists").partitionBy("log_date").parquet(f"{target.rstrip('/')}/batch_id={last or 0}")


def _slots(logs: DataFrame, slot_ms: int, stretch_rows: int | None) -> DataFrame:
    rows = with_log_date(logs.drop("log_date"))
    rows = rows.withColumn("_slot", F.floor(F.col("epoch_ms") / F.lit(slot_ms)))
    return rows.withColumn("_stretch", stretch(stretch_rows) if stretch_rows else F.lit(0))


def gathered_logs(logs: DataFrame, slot_ms: int = 3_600_000, stretch_rows: int | None = 1 << 20) -> DataFrame:
    """Rows by day and time slot, sorted by time within, with their ``log_date``; to be written by day.

    ``stretch_rows`` asks for stored ``logs``; give None after a join.
    """
    return _gathered(_slots(logs, slot_ms, stretch_rows), [])


def _gathered(rows: DataFrame, first: list[str]) -> DataFrame:
    gathered = rows.hint("rebalance", *first, "log_date", "_slot", "_stretch")
    return gathered.sortWithinPartitions(*first, "log_date", "epoch_ms", "log_id").drop("_slot", "_stretch")


def open_clustered(
    spark: SparkSession, path: str, tombstones: DataFrame | None = None, with_batch: bool = False
) -> DataFrame:
    """Rows that ``tombstones`` leave, and the day that prunes folders."""
    more = [T.StructField("batch_id", T.LongType()), T.StructField("log_date", T.DateType())]
    rows = spark.read.schema(T.StructType([*LOG_SCHEMA.fields, *more])).parquet(path)
    rows = rows if tombstones is None else live_rows(rows, tombstones)
    return rows if with_batch else rows.drop("batch_id")


def live_rows(rows: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Rows with a ``batch_id`` that no tombstone covers; later batches may reuse an id."""
    gone = tombstones.groupBy("log_id").agg(F.max("upto_batch").alias("upto_batch"))
    covered = (rows["log_id"] == gone["log_id"]) & (rows["batch_id"] <= gone["upto_batch"])
    return rows.join(gone, covered, "left_anti")


def write_csv(logs: DataFrame, path: str) -> None:
    """Log rows as CSV in the layout :func:`read_logs_csv` takes."""
    (
        logs.select(
            F.col("log_id").alias("LogID"),
            F.col("timestamp").alias("Timestamp"),
            F.col("level").alias("Level"),
            F.col("service").alias("Service"),
            F.col("message").alias("Message"),
        )
        .write.option("header", "true")
        .option("escape", '"')
        .csv(path)
    )
