"""Column layout of the log tables and the fixed defaults for missing fields."""

from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("epoch_ms", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("ts_valid", T.BooleanType()),
        T.StructField("level", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
LOG_COLUMNS = LOG_SCHEMA.names

QUERY_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("prefix", T.StringType()),
        T.StructField("wildcard", T.StringType()),
        T.StructField("start_ms", T.LongType()),
        T.StructField("end_ms", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("service", T.StringType()),
    ]
)

# Format and defaults that results depend on.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
DEFAULT_LEVEL = "INFO"
DEFAULT_SERVICE = "API"
DEFAULT_SHARDS = 3
DEFAULT_TOP_K = 3
DEFAULT_TEMPLATES = 5
DEFAULT_Z = 2.0
DEFAULT_WINDOW_MS = 300_000
DAY_MS = 86_400_000
