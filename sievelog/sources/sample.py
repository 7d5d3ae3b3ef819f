"""Sample log rows: a fixed cycle of services, levels and messages over a row number."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelog.functions.timestamps import format_epoch
from sievelog.schema import LOG_COLUMNS
from sievelog.sources.csv_logs import with_times

# The cycles of the sample source.
SERVICES = ["API", "Database", "Auth", "Payment", "Server"]
LEVELS = ["INFO", "WARN", "ERROR"]
MESSAGES = [
    "Connection failed to replica",
    "Connection timeout on port 5432",
    "Authentication token expired",
    "Payment transaction completed",
    "High memory threshold exceeded",
    "Server worker thread started",
]
ID_BASE = 100_000


def cycle(values: list[str], number: Column) -> Column:
    """The value at ``number`` modulo the length of the list."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(number, F.lit(len(values))).cast("int"))


def sample_rows(numbers: DataFrame, number: str, base_ms: int) -> DataFrame:
    """One sample log per row of ``numbers``, one second apart, starting after ``base_ms``."""
    i = F.col(number)
    df = numbers.select(
        (F.lit(ID_BASE) + i).cast("bigint").alias("log_id"),
        format_epoch(F.lit(base_ms) + i * 1000).alias("timestamp"),
        cycle(LEVELS, i).alias("level"),
        cycle(SERVICES, i).alias("service"),
        F.concat(cycle(MESSAGES, i), F.lit(" host_"), F.pmod(i, F.lit(10)).cast("string")).alias("message"),
    )
    return with_times(df).select(*LOG_COLUMNS)


def sample_logs(spark: SparkSession, n: int, base_ms: int) -> DataFrame:
    return sample_rows(spark.range(1, n + 1), "id", base_ms)
