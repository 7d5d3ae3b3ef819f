"""CSV files arriving in a folder, cleaned and stored batch by batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sievelog.operators.lifecycle import with_free_ids
from sievelog.sources.batches import stream_batch, stream_id
from sievelog.sources.csv_logs import parse_csv, stream_csv_raw, write_batch


def stream_logs_csv(
    spark: SparkSession,
    source: str,
    zone: str = "UTC",
    on_bad_ts: str = "keep",
    defaults: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Parsed rows of a growing folder; ``reason`` is set on rows to reject."""
    return parse_csv(stream_csv_raw(spark, source, max_files), zone, on_bad_ts, defaults)


def start_ingest(
    parsed: DataFrame, table: str, checkpoint: str, assign_ids: bool = False, **trigger
) -> StreamingQuery:
    """Store each micro-batch in a folder of its own, rows and rejects in one write.

    The folder's number combines the stream, known by the id in its checkpoint, and the
    micro-batch: a repeat overwrites its own folder, and neither another stream nor a
    new checkpoint nor a single ingest can meet it. ``assign_ids`` numbers accepted rows
    that came without an id.
    """
    spark, known = parsed.sparkSession, []

    def store(batch: DataFrame, micro_batch: int) -> None:
        if not known:
            known.append(stream_batch(spark, table, stream_id(spark, checkpoint), 0))
        batch_id = known[0] + micro_batch
        if assign_ids:
            accepted, rejected = batch.where("reason IS NULL"), batch.where("reason IS NOT NULL")
            batch = with_free_ids(spark, accepted, table, batch_id).unionByName(rejected)
        write_batch(batch, table, batch_id)

    writer = parsed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
