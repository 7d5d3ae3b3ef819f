"""CSV log files: one parse, accepted rows and rejects told apart by a reason.

Lines are read as text, so a line may have any length and any number of commas. A line
without quotes is split at its commas; one with quotes is matched field by field, from the
left, commas inside quotes being text. What stands after the fifth field is left out.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievelog.functions.text import strip_blank
from sievelog.functions.timestamps import format_epoch, parse_epoch_or_null
from sievelog.schema import DEFAULT_LEVEL, DEFAULT_SERVICE, LOG_COLUMNS
from sievelog.sources.batches import claim, digest_of, record_top

CSV_FIELDS = ["LogID", "Timestamp", "Level", "Service", "Message"]
REJECT_COLUMNS = ["file", "raw", "reason"]

# Text up to a comma outside quotes; an unclosed quote runs to the end of the line.
# Possessive throughout: each character is looked at once, without recursion.
_FIELD = r'([^",]*+(?:"[^"]*+"[^",]*+)*+(?:"[^"]*+\z)?+)'
_LINE = r"(?s)\A" + ",".join([_FIELD] * 5) + r"(?:,.*+)?+\z"


def _unquote(text: Column) -> Column:
    inner = F.regexp_replace(strip_blank(text), '^"|"$', "")
    return F.replace(inner, F.lit('""'), F.lit('"'))


def parse_csv(raw: DataFrame, zone: str = "UTC", on_bad_ts: str = "keep", defaults: bool = False):
    """Log columns plus ``file``, ``raw``, ``reason`` for lines of text, batch or stream.

    ``reason`` is NULL for accepted rows. With ``defaults`` a blank id is accepted as
    NULL and blank level, service and timestamp are filled in, as for single records.
    """
    if on_bad_ts not in ("keep", "reject"):
        raise ValueError("on_bad_ts must be 'keep' or 'reject'")
    line = F.regexp_replace("value", "\\A\ufeff", "")
    quoted = F.contains(line, F.lit('"'))
    # A quoted line is matched once and its fields are set apart by a character that it lacks.
    apart = F.split(F.regexp_replace(line, _LINE, "\0".join(f"${i + 1}" for i in range(len(CSV_FIELDS)))), "\0", -1)
    fields = F.array(*[F.regexp_extract(line, _LINE, i + 1) for i in range(len(CSV_FIELDS))])
    clash = F.contains(line, F.lit("\0"))
    # Six pieces at most: the sixth only says that there is more.
    parts = (
        F.when(~quoted, F.split(line, ",", 6))
        .when(~clash, apart)
        .when(line.rlike(_LINE), fields)
    )
    cut = raw.where(strip_blank(F.col("value")) != "").select(
        F.col("_metadata.file_path").alias("file"), line.alias("_raw"), F.coalesce(parts, F.array(line)).alias("_parts")
    )
    first = _unquote(F.get("_parts", F.lit(0)))
    text = F.lower("_raw")
    is_header = first.try_cast("bigint").isNull() & (
        F.contains(text, F.lit("logid")) | F.contains(text, F.lit("timestamp"))
    )
    if defaults:
        is_header = is_header & (strip_blank(first) != "")
    named = [F.coalesce(_unquote(F.get("_parts", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(CSV_FIELDS)]
    df = cut.where(~is_header).select("file", "_raw", F.size("_parts").alias("_width"), *named)

    log_id = strip_blank(F.col("LogID")).try_cast("bigint")
    bad_id = log_id.isNull()
    level, service, stamp = (strip_blank(F.col(c)) for c in ("Level", "Service", "Timestamp"))
    if defaults:
        bad_id = bad_id & (strip_blank(F.col("LogID")) != "")
        level, service, stamp = fill_defaults(level, service, stamp, zone=zone)
    df = df.select(
        log_id.alias("log_id"),
        stamp.alias("timestamp"),
        level.alias("level"),
        service.alias("service"),
        F.col("Message").alias("message"),
        "file",
        F.col("_raw").alias("raw"),
        F.when((F.col("_width") < 5), "too_few_columns").when(bad_id, "bad_id").alias("reason"),
    )
    df = with_times(df, zone)
    if on_bad_ts == "reject":
        bad_ts = F.col("reason").isNull() & ~F.col("ts_valid")
        df = df.withColumn("reason", F.when(bad_ts, "bad_timestamp").otherwise(F.col("reason")))
    ok = F.col("reason").isNull()
    return df.select(
        *LOG_COLUMNS,
        *[F.when(~ok, F.col(c)).alias(c) for c in ("file", "raw")],
        "reason",
    )


def fill_defaults(
    level: Column, service: Column, timestamp: Column, now: Column | None = None, zone: str = "UTC"
):
    """Blank level, service and timestamp replaced by what a new record gets; "now" is told in ``zone``."""
    now = F.current_timestamp() if now is None else now
    return (
        F.upper(F.coalesce(F.nullif(level, F.lit("")), F.lit(DEFAULT_LEVEL))),
        F.coalesce(F.nullif(service, F.lit("")), F.lit(DEFAULT_SERVICE)),
        F.coalesce(F.nullif(timestamp, F.lit("")), format_epoch(F.unix_millis(now), zone)),
    )


def with_times(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Add ``epoch_ms``, ``ts`` and ``ts_valid`` derived from ``timestamp``."""
    return (
        df.withColumn("_ms", parse_epoch_or_null(F.col("timestamp"), zone))
        .withColumn("ts_valid", F.col("_ms").isNotNull())
        .withColumn("epoch_ms", F.coalesce("_ms", F.lit(0).cast("bigint")))
        .withColumn("ts", F.timestamp_millis("epoch_ms"))
        .drop("_ms")
    )


def read_csv_raw(spark: SparkSession, paths) -> DataFrame:
    return spark.read.text(paths)


def stream_csv_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def read_logs_csv(spark: SparkSession, paths, zone: str = "UTC", on_bad_ts: str = "keep"):
    """``(logs, rejects)`` of CSV files. A missing path raises.

    Each of the two scans the files when used; :func:`ingest_csv` reads them once.
    """
    parsed = parse_csv(read_csv_raw(spark, paths), zone, on_bad_ts)
    return (
        parsed.where("reason IS NULL").select(*LOG_COLUMNS),
        parsed.where("reason IS NOT NULL").select(*REJECT_COLUMNS),
    )


def ingest_csv(
    spark: SparkSession,
    paths,
    table: str,
    batch_id: int | None = None,
    zone: str = "UTC",
    on_bad_ts: str = "keep",
) -> dict:
    """Read the files once into ``table`` and return the row counts of that pass.

    Accepted rows and rejects go into one write, as the next free batch. ``batch_id``
    names a batch to run again: it is replaced if it came from the same paths and these
    still hold the same files, told by name, size and time; anything else raises.
    """
    source = "csv " + (paths if isinstance(paths, str) else " ".join(paths))
    if batch_id is not None:
        source += ", " + files_digest(spark, paths)
    parsed = parse_csv(read_csv_raw(spark, paths), zone, on_bad_ts)
    return write_batch(parsed, table, claim(spark, table, source, batch_id))


def files_digest(spark: SparkSession, paths) -> str:
    """Which files there are, by name, size and time; their content is not read."""
    return digest_of(spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime"))


def write_batch(parsed: DataFrame, table: str, batch_id: int) -> dict:
    """One claimed batch as a folder of its own, overwritten if the batch is run again.

    Rejects are told apart by a column, not a folder, which would sort every row. Returns
    the counts of the pass and notes the highest id.
    """
    counts = write_observed(parsed, f"{table.rstrip('/')}/batch_id={batch_id}")
    record_top(parsed.sparkSession, table, batch_id, counts.pop("top"))
    return counts


def write_observed(parsed: DataFrame, path: str) -> dict:
    """Rows and rejects in one write that replaces ``path``; its counts and ``top``, the highest id."""
    seen, ok = Observation(), F.col("reason").isNull()
    rows = parsed.observe(
        seen,
        F.count_if(ok).alias("accepted"),
        F.count_if(~ok).alias("rejected"),
        F.count_if(ok & ~F.col("ts_valid")).alias("bad_timestamps"),
        F.max(F.when(ok, F.col("log_id"))).alias("top"),
    ).withColumn("rejected", F.col("reason").isNotNull())
    rows.write.mode("overwrite").parquet(path)
    return dict(seen.get)
