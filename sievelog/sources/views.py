"""Log rows derived from the events and documents tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelog.functions.timestamps import format_epoch
from sievelog.schema import LOG_COLUMNS
from sievelog.sources.sample import LEVELS, SERVICES, cycle

DOCUMENT_BASE_MS = 1_704_067_200_000


def _complete(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("timestamp", format_epoch(F.col("epoch_ms")))
        .withColumn("ts", F.timestamp_millis("epoch_ms"))
        .withColumn("ts_valid", F.lit(True))
        .select(*LOG_COLUMNS)
    )


def logs_from_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return _complete(
        events.select(
            F.col("event_id").alias("log_id"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("epoch_ms"),
            F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").otherwise("INFO").alias("level"),
            cycle(SERVICES, F.col("user_id")).alias("service"),
            F.concat(
                kind, F.lit(" user_"), F.pmod("user_id", F.lit(10)).cast("string"), F.lit(" "), "props"
            ).alias("message"),
        )
    )


def logs_from_documents(documents: DataFrame) -> DataFrame:
    return _complete(
        documents.select(
            F.col("doc_id").alias("log_id"),
            (F.lit(DOCUMENT_BASE_MS) + F.col("doc_id") * 1000).alias("epoch_ms"),
            cycle(LEVELS, F.col("doc_id")).alias("level"),
            F.col("source").alias("service"),
            F.col("text").alias("message"),
        )
    )
