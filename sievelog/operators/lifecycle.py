"""Adding single records with defaults, and deleting rows by id."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievelog.functions.text import strip_blank
from sievelog.schema import LOG_COLUMNS
from sievelog.sources.batches import claim, digest_of, highest_id, names, record_top
from sievelog.sources.csv_logs import REJECT_COLUMNS, fill_defaults, with_times, write_batch
from sievelog.sources.tables import live_rows, open_batches, open_logs

TOMBSTONE_SCHEMA = T.StructType(
    [T.StructField("log_id", T.LongType()), T.StructField("upto_batch", T.LongType())]
)


def with_defaults(records: DataFrame, now: Column | None = None, zone: str = "UTC") -> DataFrame:
    """Raw records trimmed, blank level, service and timestamp filled in, level upper case."""
    text = {
        c: strip_blank(F.coalesce(F.col(c).cast("string"), F.lit("")))
        for c in ("level", "service", "message", "timestamp")
    }
    level, service, stamp = fill_defaults(text["level"], text["service"], text["timestamp"], now, zone)
    filled = records.select(
        F.col("log_id").cast("bigint").alias("log_id"),
        stamp.alias("timestamp"),
        level.alias("level"),
        service.alias("service"),
        text["message"].alias("message"),
    )
    return with_times(filled, zone).select(*LOG_COLUMNS)


def with_ids(records: DataFrame, existing: DataFrame | int | None = None) -> DataFrame:
    """Rows without an id get one above every id in ``records`` and ``existing``.

    ``existing`` is a table or its highest id. A table is read only if an id is missing.
    Ids rise within an input partition and differ between partitions; no row has to
    move for it.
    """
    if records.where(F.col("log_id").isNull()).isEmpty():
        return records
    top = F.coalesce(records.agg(F.max("log_id")).scalar(), F.lit(0))
    if isinstance(existing, int):
        top = F.greatest(top, F.lit(existing))
    elif existing is not None:
        top = F.greatest(top, F.coalesce(existing.agg(F.max("log_id")).scalar(), F.lit(0)))
    fresh = top + F.lit(1) + F.monotonically_increasing_id()
    return records.withColumn("log_id", F.coalesce("log_id", fresh))


def with_free_ids(spark: SparkSession, records: DataFrame, table: str, batch_id: int) -> DataFrame:
    """:func:`with_ids` above the ids of a table, from the notes its batches left.

    Only batches without a note, written by an earlier version, are read.
    """
    top, unknown = highest_id(spark, table, skip=batch_id)
    if unknown:
        rest = open_logs(spark, table).where(F.col("batch_id").isin(unknown)).agg(F.max("log_id")).first()[0]
        top = max((t for t in (top, rest) if t is not None), default=None)
    return with_ids(records, top)


def append_logs(
    spark: SparkSession,
    table: str,
    records: DataFrame,
    batch_id: int | None = None,
    now: Column | None = None,
    zone: str = "UTC",
    source: str | None = None,
) -> DataFrame:
    """Add records as the next free batch and return them as stored.

    ``batch_id`` names a batch of the same ``source`` to run again; without a name the
    records themselves are the source, so other records under that number raise. What is
    stored is the one version of the new ids: build postings from it, not from ``records``.
    """
    if source is None:
        source = "records" if batch_id is None else f"records, {digest_of(records)}"
    batch_id = claim(spark, table, source, batch_id)
    rows = with_free_ids(spark, with_defaults(records, now, zone), table, batch_id)
    none = F.lit(None).cast("string")
    rows = rows.select(*LOG_COLUMNS, *[none.alias(c) for c in REJECT_COLUMNS])
    write_batch(rows, table, batch_id)
    return open_logs(spark, table).where(F.col("batch_id") == batch_id)


def delete_by_id(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` (logs or postings) without those whose id is in ``ids``.

    No broadcast hint: the planner broadcasts a short list by its size and shuffles a
    long one, splitting a hot id's rows if it must.
    """
    kept = rows.join(ids.select("log_id").distinct(), "log_id", "left_anti")
    return kept.select(*rows.columns)


def found_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """For every id asked for, whether a row has it."""
    wanted = ids.select("log_id").distinct()
    present = rows.select("log_id").join(wanted, "log_id", "left_semi").distinct()
    return wanted.join(present.withColumn("found", F.lit(True)), "log_id", "left").select(
        "log_id", F.coalesce("found", F.lit(False)).alias("found")
    )


def add_tombstones(ids: DataFrame, path: str, upto_batch: int) -> None:
    """Record a deletion of everything with these ids up to and including a batch."""
    ids.select("log_id", F.lit(upto_batch).cast("bigint").alias("upto_batch")).write.mode(
        "append"
    ).parquet(path)


def open_tombstones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOMBSTONE_SCHEMA).parquet(path)


def compact(spark: SparkSession, table: str, tombstones: DataFrame, target: str) -> None:
    """The live rows and the rejects of a batch table as a new table; ``table`` stays as it is.

    Rebalancing gathers the small files of a batch and splits a large one.
    """
    rows = open_batches(spark, table)
    live = live_rows(rows.where("NOT rejected"), tombstones).unionByName(rows.where("rejected"))
    live.hint("rebalance", "batch_id").write.partitionBy("batch_id").parquet(target)
    top, unknown = highest_id(spark, table)
    if not unknown:  # ids of rows deleted since are not given again
        for n, name in enumerate(sorted(x for x in names(spark, target) if x.startswith("batch_id="))):
            record_top(spark, target, int(name.partition("=")[2]), None if n else top)
