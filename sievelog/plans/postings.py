"""Precomputed text tables: postings (token -> rows) and the token dictionary."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievelog.functions.keys import row_key, stretch
from sievelog.functions.text import field_token, log_tokens, message_words, same_text, token_matches
from sievelog.functions.timestamps import day_literal, day_of, log_date
from sievelog.operators.search import matching
from sievelog.sources.batches import claim, digest_of, names, write_mark
from sievelog.sources.tables import live_rows

HOUR_MS = 3_600_000
#: Hours that a search names one by one; hits in more hours are found by day.
HOURS = 100
#: Days that a search names one by one, eleven years; hits on more days, as of junk times, are found by the row predicate.
DAYS = 4_000

POSTINGS_SCHEMA = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("log_id", T.LongType()),
        T.StructField("row_key", T.LongType()),
        T.StructField("epoch_ms", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("service", T.StringType()),
    ]
)


def build_postings(logs: DataFrame, index_fields: bool = True) -> DataFrame:
    """One row per token of each log row.

    ``index_fields=False`` leaves out level and service, whose few values would each be
    the token of a large share of all rows; searches then look at those columns.
    """
    if index_fields:
        # Level and service make a few tokens of many rows: fine for small tables.
        tokens = log_tokens(F.col("service"), F.col("level"), F.col("message"))
    else:
        tokens = F.array_remove(F.array_distinct(message_words(F.col("message"))), "")
    # The hash comes before the explode, which would repeat it per token. The tokens stay
    # inside the explode: over a plain column Spark adds a filter on its size, and that
    # would split every message a second time.
    rows = logs.withColumn("row_key", row_key())
    found = rows.select(
        F.explode(tokens).alias("token"), "log_id", "row_key", "epoch_ms", "level", "service"
    )
    return tagged(found, index_fields)


def field_postings(logs: DataFrame) -> DataFrame:
    """The postings of level and service alone, which ``index_fields=False`` leaves out."""
    fields = F.array_remove(F.array_distinct(F.array(*[field_token(F.col(c)) for c in ("level", "service")])), "")
    rows = logs.withColumn("row_key", row_key())
    return rows.select(F.explode(fields).alias("token"), "log_id", "row_key", "epoch_ms", "level", "service")


def tagged(postings: DataFrame, index_fields: bool) -> DataFrame:
    """Note in the schema whether level and service are among the tokens."""
    return postings.withMetadata("token", {_TAG: index_fields})


def has_fields(postings: DataFrame, expected: bool | None = None) -> bool:
    """Whether level and service are among the tokens; a wrong ``expected`` raises."""
    known = postings.schema["token"].metadata.get(_TAG)
    if known is None:
        return True if expected is None else expected
    if expected is not None and known != expected:
        raise ValueError(f"the postings were built with index_fields={known}")
    return known


_TAG = "index_fields"


def token_head(token: Column) -> Column:
    """Folder of a token: its first two characters, or ``~`` if it starts unlike a word."""
    return F.when(token.rlike("^[a-z0-9_]"), F.left(token, F.lit(2))).otherwise(F.lit("~"))


def write_postings(postings: DataFrame, path: str, stretch_rows: int = 1 << 24) -> None:
    """Write by folders of token heads, inside each file sorted by token and time.

    A term reads the folders it can be in and skips by file statistics there. The rows
    move once and are not sampled first, which would split every message twice;
    rebalancing splits the folder of a token that a third of all rows have, and
    ``stretch_rows`` takes apart what one task alone adds to it. ``postings`` must be
    built from a stored table.
    """
    _write(_in_folders(postings, stretch_rows), postings, path, 0, "errorifexists")


def append_postings(
    batch: DataFrame,
    table: str,
    batch_id: int,
    index_fields: bool = True,
    stretch_rows: int = 1 << 24,
    source: str | None = None,
) -> None:
    """Postings of one batch of stored logs, in folders of their own.

    A repeat by the same ``source`` overwrites them; a batch of another source, or one that
    was there before, raises. Without a name the rows themselves are the source.
    """
    rows = build_postings(batch, index_fields)
    _mark_kind(rows, table)
    claim(batch.sparkSession, table, source or digest_of(batch.drop("batch_id", "log_date")), batch_id)
    _write(_in_folders(rows, stretch_rows), rows, table, batch_id, "overwrite")


def _in_folders(postings: DataFrame, stretch_rows: int) -> DataFrame:
    return postings.withColumns({"head": token_head(F.col("token")), "_stretch": stretch(stretch_rows)})


def gathered_postings(postings: DataFrame, stretch_rows: int | None = 1 << 24) -> DataFrame:
    """Postings by head, sorted by token and time within; to be written by head.

    Without ``stretch_rows`` the rows bring their ``_stretch`` along.
    """
    if stretch_rows is not None:
        return _sorted(_in_folders(postings, stretch_rows))
    return _sorted(postings.withColumn("head", token_head(F.col("token"))))


def _sorted(keyed: DataFrame) -> DataFrame:
    rows = keyed.hint("rebalance", "head", "_stretch").sortWithinPartitions("head", "token", "epoch_ms")
    return rows.select(*POSTINGS_SCHEMA.names, "head")


def _mark_kind(postings: DataFrame, path: str) -> None:
    """Note at a new table whether level and service are among the tokens; a table of the other kind raises.

    The note comes before the rows, so a call that breaks off leaves a table that can grow.
    """
    spark, fields = postings.sparkSession, has_fields(postings)
    found = names(spark, path)
    noted = f"_{_TAG}-{fields}"
    if noted not in found:
        if f"_{_TAG}-{not fields}" in found or any(n.startswith("batch_id=") for n in found):
            raise ValueError(f"{path} was not built with index_fields={fields}")
        write_mark(spark, path, noted)


def _write(keyed: DataFrame, postings: DataFrame, path: str, batch_id: int, mode: str) -> None:
    _mark_kind(postings, path)
    rows = _sorted(keyed)
    rows.write.mode(mode).partitionBy("head").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def open_postings(
    spark: SparkSession, path: str, tombstones: DataFrame | None = None, with_batch: bool = False
) -> DataFrame:
    """Postings of all batches that ``tombstones`` leave, and ``head``, which prunes folders."""
    more = [T.StructField("batch_id", T.LongType()), T.StructField("head", T.StringType())]
    rows = spark.read.schema(T.StructType([*POSTINGS_SCHEMA.fields, *more])).parquet(path)
    known = names(spark, path)
    built = [f for f in (True, False) if f"_{_TAG}-{f}" in known]
    rows = tagged(rows, built[0]) if built else rows
    rows = rows if tombstones is None else live_rows(rows, tombstones)
    return rows if with_batch else rows.drop("batch_id")


def open_posting_batches(spark: SparkSession, table: str) -> DataFrame:
    return open_postings(spark, table, with_batch=True)


def compact_postings(
    spark: SparkSession, table: str, tombstones: DataFrame, target: str, stretch_rows: int = 1 << 24
) -> None:
    """Postings of all batches without the deleted rows, as one table in folders.

    Stretches are numbered on the stored rows, before the join with the deletions, so the
    rows move once and are written once. All become one batch, the highest.
    """
    rows = open_posting_batches(spark, table)
    last = max((int(n.partition("=")[2]) for n in names(spark, table) if n.startswith("batch_id=")), default=0)
    live = live_rows(_in_folders(rows, stretch_rows), tombstones)
    _write(live, rows, target, last, "errorifexists")


def token_dictionary(postings: DataFrame) -> DataFrame:
    """Distinct tokens with their row count and time span."""
    return postings.groupBy("token").agg(
        F.count("*").alias("df"),
        F.min("epoch_ms").alias("min_epoch_ms"),
        F.max("epoch_ms").alias("max_epoch_ms"),
    )


def append_dictionary(postings: DataFrame, table: str, batch_id: int, source: str | None = None) -> None:
    """The dictionary of one batch of postings, as a folder of its own.

    A repeat by the same ``source`` overwrites it; a batch of another source, or one that was
    there before, raises. Without a name the postings themselves are the source.
    """
    claim(postings.sparkSession, table, source or digest_of(postings), batch_id)
    rows = token_dictionary(postings).sortWithinPartitions("token")
    rows.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch_id={batch_id}")


def open_dictionary(spark: SparkSession, table: str) -> DataFrame:
    """The dictionaries of all batches as one: counts add up, spans widen.

    Rows deleted since are still counted; a token without rows costs a lookup, no answer.
    """
    fields = "token STRING, df BIGINT, min_epoch_ms BIGINT, max_epoch_ms BIGINT, batch_id BIGINT"
    return spark.read.schema(fields).parquet(table).groupBy("token").agg(
        F.sum("df").alias("df"), F.min("min_epoch_ms").alias("min_epoch_ms"), F.max("max_epoch_ms").alias("max_epoch_ms")
    )


def posting_hits(
    postings: DataFrame,
    keyword: str | None = None,
    prefix: str | None = None,
    wildcard: str | None = None,
    **filters,
) -> DataFrame:
    """Which rows match, from postings alone: id, key, time, level, service.

    Exact copies of a row count once. On a written table the term's first characters
    select folders; equality and literal heads also reach the Parquet reader as token
    filters. Postings built with ``index_fields=False`` answer for message words only.
    ``filters`` are the time bounds, level and service of :func:`matching`.
    """
    hits = _postings_of(postings, keyword, prefix, wildcard, **filters)
    return hits.select("log_id", "row_key", "epoch_ms", "level", "service").distinct()


def _postings_of(
    postings, keyword=None, prefix=None, wildcard=None, start_ms=None, end_ms=None, level=None, service=None
) -> DataFrame:
    if not (keyword or prefix or wildcard):
        raise ValueError("give a keyword, prefix or wildcard")
    if (start_ms is None) != (end_ms is None):
        raise ValueError("give both time bounds or none")
    hits = postings.where(token_matches(F.col("token"), keyword, prefix, wildcard))
    if "head" in postings.columns:
        start = (keyword or prefix or wildcard.partition("*")[0]).lower()
        hits = hits.where(head_can_hold(start))
    if start_ms is not None:
        hits = hits.where(F.col("epoch_ms").between(start_ms, end_ms))
    for name, wanted in (("level", level), ("service", service)):
        cond = same_text(F.col(name), wanted)
        hits = hits if cond is None else hits.where(cond)
    return hits


def head_can_hold(start: str) -> Column:
    """Partition filter: the folders with tokens that begin with ``start``."""
    if not start:
        return F.lit(True)
    if not re.match("[a-z0-9_]", start):
        return F.col("head") == "~"
    if len(start) == 1:
        return F.startswith(F.col("head"), F.lit(start))
    return F.col("head") == start[:2]


def search_indexed(
    logs: DataFrame, postings: DataFrame, index_fields: bool | None = None, unique_ids: bool = True, **filters
) -> DataFrame:
    """Same rows as :func:`matching`, reading only the hours that hold a hit.

    ``logs`` is the table partitioned by ``log_date``. The postings name the days (a
    list no longer than the calendar the table covers) and, where hits are rare, the
    hours. Both filters are static: days select folders, hours row groups by their
    statistics, and the row predicate decides on what is left: no join, no shuffle of
    rows. Postings know whether level and service are in them; if not, those two columns
    are scanned. A wrong ``index_fields`` raises.
    """
    index_fields = has_fields(postings, index_fields)
    if "log_date" not in logs.columns:
        raise ValueError("logs must be the time-clustered table")
    text = {k: v for k, v in filters.items() if k in ("keyword", "prefix", "wildcard")}
    if any(text.values()):
        # One row per id is chosen before the other filters, so they must not narrow it.
        hits = _postings_of(postings, **(filters if unique_ids else text))
        if not index_fields:
            fields = matching(logs, **{k: v for k, v in filters.items() if k not in text}) if unique_ids else logs
            hits = hits.select("epoch_ms").unionByName(fields.where(_field_matches(**text)).select("epoch_ms"))
        logs = logs.where(near_hits(hits))
    return matching(logs, unique_ids=unique_ids, **filters)


def hit_days(hits: DataFrame) -> list[str] | None:
    """The distinct days of some rows; None if they are more than a search names one by one."""
    day = log_date(F.col("epoch_ms")).cast("string")
    days = [r[0] for r in hits.select(day.alias("d")).distinct().limit(DAYS + 1).collect()]
    return None if len(days) > DAYS else days


def near_hits(hits: DataFrame) -> Column:
    """Static filter on the days of some rows and, if these are few, on their hours."""
    hour = F.floor(F.col("epoch_ms") / F.lit(HOUR_MS))
    hours = [r[0] for r in hits.select(hour.alias("h")).distinct().limit(HOURS + 1).collect()]
    if len(hours) > HOURS:
        return on_days(hit_days(hits))
    spans = [F.col("epoch_ms").between(int(h) * HOUR_MS, int(h) * HOUR_MS + HOUR_MS - 1) for h in sorted(hours)]
    days = {int(h) // 24: day_of(int(h) * HOUR_MS) for h in hours}
    on_day = F.col("log_date").isin(list(days.values())) if days else F.lit(False)
    return on_day & reduce(lambda a, b: a | b, spans, F.lit(False))


def on_days(days: list[str] | None) -> Column:
    """Static partition filter for a list of days; none at all without a list."""
    if days is None:
        return F.lit(True)
    return F.col("log_date").isin([day_literal(d) for d in sorted(days)]) if days else F.lit(False)


def _field_matches(**text) -> Column:
    """Level or service as a token, for postings built without them."""
    level, service = (token_matches(field_token(F.col(c)), **text) for c in ("level", "service"))
    return level | service
