"""A log store: raw rows, clustered table, postings, token days and time counts as one thing.

One call adds a batch to all of them, deletes ids from all of them, or gathers all of them.
The folders of a call have a name of their own (``attempt=<name>``) and count from the moment
its manifest entry is there (see :mod:`sievelog.sources.manifest`); a call that breaks off
before leaves folders that nobody reads, and is simply made again. A reader works on the
state it opened: later batches, deletions and gatherings do not change what it sees.

Token days are the dictionary: a row per token, day and batch with 24 signed counts, one per
hour. Deletions add negative counts, so sums over all rows give the live number of rows of a
token and, hour by hour, where it still occurs. A search adds them up to bit masks of hours,
combines the masks of all its conditions day by day, and only then looks at log rows.

A glob that does not begin with a letter is first resolved to tokens: by the reversed tokens
if it ends in a literal, else by the trigrams of its longest pieces. Both tables hold a row
per distinct token of a batch and are sorted, so that the reader skips to the term.
"""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sievelog.functions.keys import stretch
from sievelog.functions.text import field_token, has_token, log_tokens, strip_blank, token_matches
from sievelog.functions.timestamps import day_literal, day_of, log_date
from sievelog.operators.analytics import anomalies_from_counts, check_window
from sievelog.operators.lifecycle import TOMBSTONE_SCHEMA, with_defaults, with_ids
from sievelog.operators.search import first_per_id, in_time_order, matching
from sievelog.plans.postings import (
    HOUR_MS,
    HOURS,
    POSTINGS_SCHEMA,
    build_postings,
    gathered_postings,
    tagged,
    token_head,
)
from sievelog.schema import DAY_MS, DEFAULT_WINDOW_MS, DEFAULT_Z, LOG_COLUMNS, LOG_SCHEMA
from sievelog.session import materialise
from sievelog.sources import manifest
from sievelog.sources.batches import digest_of, names, stream_id
from sievelog.sources.csv_logs import REJECT_COLUMNS, files_digest, parse_csv, read_csv_raw, write_observed
from sievelog.sources.tables import RAW_SCHEMA, gathered_logs, live_rows

#: Days a search names one by one; hits on more days are found by a join with their list.
DAYS = 400
#: Tokens a glob may be resolved to; one that more tokens match reads the token days.
TOKENS = 1_000
#: Characters of a gram.
GRAM = 3
_EPOCH_DAY = dt.date(1970, 1, 1).toordinal()
_FIRST, _LAST = dt.date.min.toordinal() - _EPOCH_DAY, dt.date.max.toordinal() - _EPOCH_DAY
_HOURS = [f"h{i:02d}" for i in range(24)]
_DATE = T.StructField("log_date", T.DateType())
_SCHEMAS = {
    "raw": RAW_SCHEMA,
    "logs": T.StructType([*LOG_SCHEMA.fields, _DATE]),
    "postings": T.StructType([*POSTINGS_SCHEMA.fields, T.StructField("head", T.StringType())]),
    "token_days": T.StructType(
        [T.StructField("token", T.StringType()), _DATE, *[T.StructField(h, T.LongType()) for h in _HOURS]]
    ),
    "error_times": T.StructType([T.StructField("epoch_ms", T.LongType()), T.StructField("ts_valid", T.BooleanType()), T.StructField("errors", T.LongType())]),
    "row_hours": T.StructType([T.StructField("hour", T.LongType()), T.StructField("ts_valid", T.BooleanType()), T.StructField("rows", T.LongType())]),
    "tails": T.StructType([T.StructField("reversed", T.StringType()), T.StructField("token", T.StringType())]),
    "grams": T.StructType([T.StructField("gram", T.StringType()), T.StructField("token", T.StringType())]),
    "stones": TOMBSTONE_SCHEMA,
}
_FOLDERS = {"logs": ["log_date"], "postings": ["head"]}


class Conflict(Exception):
    """Another call changed what this one was built on; it is made again."""


def create_store(spark: SparkSession, path: str, index_fields: bool = True, zone: str = "UTC") -> "Store":
    """A new store, or the one that is there if it has the same settings; others raise."""
    settings = {"index_fields": index_fields, "zone": zone}

    def decide(state):
        if state.version < 0:
            return {"kind": "create", "settings": settings}
        if state.settings != settings:
            raise ValueError(f"{path} has the settings {state.settings}")
        return None

    return Store(spark, path.rstrip("/"), manifest.commit(spark, path, decide)[0])


def open_store(spark: SparkSession, path: str) -> "Store":
    """The store as its newest entry has it."""
    state = manifest.load(spark, path)
    if state.version < 0:
        raise ValueError(f"{path} is no store")
    return Store(spark, path.rstrip("/"), state)


class Store:
    """A store in one state. Calls that change it move this object to the new state."""

    def __init__(self, spark: SparkSession, path: str, state: manifest.State):
        self.spark, self.path, self.state = spark, path, state

    def refresh(self) -> "Store":
        self.state = manifest.load(self.spark, self.path)
        return self

    # ---- adding -------------------------------------------------------------------

    def ingest_csv(self, paths, call: str | None = None, on_bad_ts: str = "keep") -> dict:
        """Add CSV files as one batch; the counts of the pass.

        ``call`` names this call: made again with the same files (by name, size and time) it
        adds nothing and gives the same counts; with others it raises.
        """
        source = f"csv {files_digest(self.spark, paths)}" if call else None
        if counts := self._made(call, source):
            return counts
        parsed = parse_csv(read_csv_raw(self.spark, paths), self.state.settings["zone"], on_bad_ts)
        return self._add(lambda: parsed, call=call, source=source)

    def append(self, records: DataFrame, now: Column | None = None, call: str | None = None) -> dict:
        """Add raw records, with defaults filled in and ids for those without, as one batch."""
        source = f"records {digest_of(records)}" if call else None
        if counts := self._made(call, source):
            return counts
        rows = with_defaults(records, now, self.state.settings["zone"])
        rows = rows.select(*LOG_COLUMNS, *[F.lit(None).cast("string").alias(c) for c in REJECT_COLUMNS])
        return self._add(lambda: self._numbered(rows), call=call, source=source, numbered=True)

    def start_ingest(self, parsed: DataFrame, checkpoint: str, assign_ids: bool = False, **trigger) -> StreamingQuery:
        """Add each micro-batch of parsed rows to all tables, once.

        The manifest notes the last micro-batch of a stream, known by the id in its
        checkpoint: one that Spark repeats is already there and adds nothing.
        """

        def store(batch: DataFrame, micro_batch: int) -> None:
            stream = stream_id(self.spark, checkpoint)
            if self.refresh().state.streams.get(stream, -1) >= micro_batch:
                return

            def rows():
                if not assign_ids:
                    return batch
                return self._numbered(batch.where("reason IS NULL")).unionByName(batch.where("reason IS NOT NULL"))

            self._add(rows, stream=(stream, micro_batch), numbered=assign_ids)

        writer = parsed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()

    def _made(self, call: str | None, source: str | None) -> dict | None:
        known = self.refresh().state.calls.get(call) if call else None
        if known and known["source"] != source:
            raise ValueError(f"{call!r} was made with other rows")
        return known and known["counts"]

    def _numbered(self, rows: DataFrame) -> DataFrame:
        return with_ids(rows, -1 if self.state.top is None else self.state.top)

    def _add(self, rows, call=None, source=None, stream=None, numbered=False) -> dict:
        """Write the tables of one batch and make them visible by one entry."""
        while True:
            self.refresh()
            attempt, top_before = uuid.uuid4().hex, self.state.top
            counts = write_observed(rows(), self._at("raw", attempt))
            top = counts.pop("top")
            self._derive(attempt)

            def decide(state):
                if call in state.calls or (stream and state.streams.get(stream[0], -1) >= stream[1]):
                    return None  # another driver made the same call
                if numbered and state.top != top_before:
                    raise Conflict  # its new ids may be ours
                return {
                    "kind": "batch", "attempt": attempt, "top": top, "counts": counts,
                    "call": call, "source": source, "stream": stream,
                }

            try:
                self.state, entry = manifest.commit(self.spark, self.path, decide)
            except Conflict:
                continue
            return counts if entry or not call else self.state.calls[call]["counts"]

    def _derive(self, attempt: str) -> None:
        """Everything that follows from the raw rows of an attempt."""
        stored = self._read("raw", [attempt]).where("NOT rejected").select(*LOG_COLUMNS)
        postings = build_postings(stored, self.state.settings["index_fields"])
        self._write_all(
            attempt, logs=gathered_logs(stored), postings=gathered_postings(postings), **_counts(stored)
        )
        self._write_all(attempt, **_parts_of_tokens(self._read("token_days", [attempt])))

    def _write_all(self, attempt: str, **tables: DataFrame) -> None:
        """Tables that do not wait for one another; a failed one stops the call."""
        with ThreadPoolExecutor(len(tables)) as pool:
            for done in [pool.submit(self._write, name, attempt, rows) for name, rows in tables.items()]:
                done.result()

    # ---- deleting and gathering ---------------------------------------------------

    def delete(self, ids: DataFrame) -> int:
        """Delete all rows with these ids from all tables; the number of rows that went.

        The rows are looked up by id in two columns first; whole rows are read on their days
        only. A deletion reaches the batches of the state it was worked out on.
        """
        while True:
            self.refresh()
            attempt, seen = uuid.uuid4().hex, self.state
            wanted = materialise(ids.select(F.col("log_id").cast("bigint")).where("log_id IS NOT NULL").distinct(), "ids")
            met = self._live("logs").join(wanted, "log_id", "left_semi").select("log_date").distinct().limit(DAYS + 1)
            days = [r[0].isoformat() for r in met.select(F.col("log_date")).collect()]
            rows = self._live("logs")
            rows = rows if len(days) > DAYS else rows.where(F.col("log_date").isin([day_literal(d) for d in days]) if days else F.lit(False))
            gone = materialise(rows.join(wanted, "log_id", "left_semi").select(*_SCHEMAS["logs"].names), "deleted")
            stones = wanted.select("log_id", F.lit(seen.version).cast("bigint").alias("upto_batch"))
            less = {n: t.withColumns({c: -F.col(c) for c in (*_HOURS, "errors", "rows") if c in t.columns}) for n, t in _counts(gone).items()}
            self._write_all(attempt, stones=stones, **less)
            try:
                self.state, _ = manifest.commit(
                    self.spark, self.path,
                    self._unless_deleted(seen, lambda state: {"kind": "delete", "attempt": attempt, "upto": seen.version}),
                )
            except Conflict:
                continue
            return gone.count()

    def compact(self) -> None:
        """Gather all batches and deletions of now into one batch; what is read does not change."""
        while True:
            seen, attempt = self.refresh().state, uuid.uuid4().hex
            if not seen.batches:
                return
            rejects = self._read("raw", self._batches()).where("rejected").drop("attempt")
            raw = self._live("raw", "NOT rejected").unionByName(rejects)
            raw.select(*RAW_SCHEMA.names).hint("rebalance").write.parquet(self._at("raw", attempt))
            live = self._live("postings", keyed=lambda p: p.withColumn("_stretch", stretch(1 << 24)))
            days = self.token_days().where(reduce(lambda a, b: a | b, [F.col(h) != 0 for h in _HOURS]))
            self._write_all(
                attempt,
                logs=gathered_logs(self._live("logs").drop("log_date"), stretch_rows=None),
                postings=gathered_postings(live.drop("head"), None),
                token_days=_by_token(days),
                error_times=self._error_times(),
                row_hours=self._row_hours(),
            )
            self._write_all(attempt, **_parts_of_tokens(self._read("token_days", [attempt])))
            entry = {
                "kind": "compact", "attempt": attempt, "upto": seen.version, "top": seen.top,
                "replaces": [b["number"] for b in seen.batches],
                "counts": {k: sum(b["counts"][k] for b in seen.batches) for k in seen.batches[0]["counts"]},
            }
            try:
                self.state, _ = manifest.commit(self.spark, self.path, self._unless_deleted(seen, lambda state: entry))
                return
            except Conflict:
                continue

    @staticmethod
    def _unless_deleted(seen: manifest.State, make):
        """Deletions and gatherings follow one another: one that met another starts again."""

        def decide(state):
            kept = {b["attempt"] for b in seen.batches} <= {b["attempt"] for b in state.batches}
            if state.deletions != seen.deletions or not kept:
                raise Conflict
            return make(state)

        return decide

    def sweep(self, older_than_ms: int = DAY_MS) -> list[str]:
        """Remove folders that no entry names and that are older than any call may take.

        They are of calls that broke off, or of batches that were gathered.
        """
        used, removed = self.refresh().state.attempts(), []
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        now = jvm.java.lang.System.currentTimeMillis()
        for table in _SCHEMAS:
            for name in names(self.spark, f"{self.path}/{table}"):
                at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}/{name}")
                fs = at.getFileSystem(conf)
                if name.startswith("attempt=") and name[8:] not in used and fs.getFileStatus(at).getModificationTime() <= now - older_than_ms:
                    fs.delete(at, True)
                    removed.append(f"{table}/{name}")
        return removed

    # ---- reading ------------------------------------------------------------------

    def _at(self, table: str, attempt: str) -> str:
        return f"{self.path}/{table}/attempt={attempt}"

    def _write(self, table: str, attempt: str, rows: DataFrame) -> None:
        writer = rows.select(*_SCHEMAS[table].names).write
        writer = writer.partitionBy(*_FOLDERS[table]) if table in _FOLDERS else writer
        writer.parquet(self._at(table, attempt))

    def _batches(self) -> list[str]:
        return [b["attempt"] for b in self.state.batches]

    def _read(self, table: str, attempts: list[str]) -> DataFrame:
        """Rows of a table from the folders of some attempts, which are listed and no others."""
        schema = T.StructType([*_SCHEMAS[table].fields, T.StructField("attempt", T.StringType())])
        if not attempts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}")
        return reader.parquet(*[self._at(table, a) for a in attempts])

    def _live(self, table: str, cond: str = "true", keyed=lambda rows: rows, with_batch: bool = False) -> DataFrame:
        """Rows of all batches that no deletion reaches."""
        rows = keyed(self._read(table, self._batches()).where(cond))
        if not self.state.deletions and not with_batch:
            return rows.drop("attempt")
        numbers = [(b["attempt"], b["number"]) for b in self.state.batches]
        numbers = self.spark.createDataFrame(numbers, "attempt STRING, batch_id BIGINT")  # a row per batch
        rows = rows.join(F.broadcast(numbers), "attempt").drop("attempt")
        if self.state.deletions:
            rows = live_rows(rows, self._read("stones", [d["attempt"] for d in self.state.deletions]))
        return rows if with_batch else rows.drop("batch_id")

    def logs(self, with_batch: bool = False) -> DataFrame:
        """Live rows with the day that prunes folders."""
        return self._live("logs", with_batch=with_batch)

    def raw(self) -> DataFrame:
        """Accepted rows as ingested, deleted ones included until the store is gathered."""
        return self._read("raw", self._batches()).where("NOT rejected").select(*LOG_COLUMNS)

    def rejects(self) -> DataFrame:
        return self._read("raw", self._batches()).where("rejected").select(*REJECT_COLUMNS)

    def postings(self) -> DataFrame:
        """Live postings with the head that prunes folders."""
        return tagged(self._live("postings"), self.state.settings["index_fields"])

    def _all(self, table: str) -> DataFrame:
        """Signed counts of batches and deletions."""
        return self._read(table, [*self._batches(), *[d["attempt"] for d in self.state.deletions]])

    def token_days(self, cond: Column | None = None) -> DataFrame:
        """Live rows per token, day and hour (h00 to h23)."""
        rows = self._all("token_days")
        rows = rows if cond is None else rows.where(cond)
        return rows.groupBy("token", "log_date").agg(*[F.sum(h).alias(h) for h in _HOURS])

    def dictionary(self) -> DataFrame:
        """Tokens of live rows with their number of rows, first and last day."""
        rows = reduce(lambda a, b: a + b, [F.col(h) for h in _HOURS])
        days = self._all("token_days").groupBy("token", "log_date").agg(F.sum(rows).alias("n")).where("n > 0")
        return days.groupBy("token").agg(
            F.sum("n").alias("df"), F.min("log_date").alias("first_day"), F.max("log_date").alias("last_day")
        )

    def _error_times(self) -> DataFrame:
        return self._all("error_times").groupBy("epoch_ms", "ts_valid").agg(F.sum("errors").alias("errors")).where("errors != 0")

    def _row_hours(self) -> DataFrame:
        return self._all("row_hours").groupBy("hour", "ts_valid").agg(F.sum("rows").alias("rows")).where("rows != 0")

    # ---- searching ----------------------------------------------------------------

    def search(self, words=(), unique_ids: bool = True, **filters) -> DataFrame:
        """Rows that hold all ``words`` and pass the filters of :func:`matching`, in no order.

        Token days name the hours in which every condition on text, level and service has
        a row; only those days, and if they are few only those hours, are scanned.
        """
        logs = self.logs()
        text = {k: v for k, v in filters.items() if k in ("keyword", "prefix", "wildcard")}
        asked = [self._asks(keyword=w) for w in words]
        if any(text.values()):
            asked.append(self._asks(**text))
        if unique_ids or not asked:  # one row per id is chosen before the other filters
            asked += [_is_field(v) for k in ("level", "service") if (v := filters.get(k)) is not None and v.upper() != "ALL"]
        if any(a is None for a in asked):
            return logs.where("false")
        if asked:
            logs = self._near(logs, self._masks(asked))
        hits = logs.where(reduce(lambda a, b: a & b, [has_token(w) for w in words], F.lit(True)))
        if words and not unique_ids:
            hits = first_per_id(materialise(hits, "hits"))
        return matching(hits, unique_ids=unique_ids, **filters)

    def compound(self, **filters) -> DataFrame:
        """:meth:`search`, ascending in time."""
        return in_time_order(self.search(**filters))

    def _asks(self, keyword=None, prefix=None, wildcard=None) -> Column | None:
        """Which rows of the token days can hold the text."""
        term = keyword or prefix or wildcard
        if not term:
            return None
        if not keyword and not prefix and wildcard.startswith("*") and wildcard.strip("*"):
            tokens = self._resolved(wildcard.lower())
            if tokens is not None:
                return F.col("token").isin(tokens) if tokens else F.lit(False)
        return token_matches(F.col("token"), keyword, prefix, wildcard)

    def _resolved(self, glob: str) -> list[str] | None:
        """The tokens that match a glob; None if they are too many or the glob gives nothing to look up."""
        pieces = [p for p in glob.split("*") if p]
        grams = {p[i : i + GRAM] for p in pieces for i in range(len(p) - GRAM + 1)}
        if not glob.endswith("*"):
            rows = self._read("tails", self._batches()).where(F.startswith("reversed", F.lit(pieces[-1][::-1])))
        elif grams:
            rows = self._read("grams", self._batches()).where(F.col("gram").isin(sorted(grams)))
            held = F.count_distinct("gram") == len(grams)
            rows = rows.groupBy("token").agg(held.alias("all")).where("all")
        else:
            return None
        found = rows.where(token_matches(F.col("token"), wildcard=glob)).select("token").distinct().limit(TOKENS + 1).collect()
        return None if len(found) > TOKENS else sorted(r[0] for r in found)

    def _masks(self, asked: list[Column]) -> DataFrame:
        """log_date and the hours, as bits, in which each of the conditions has a live row."""
        flags = {f"_a{i}": F.coalesce(a, F.lit(False)) for i, a in enumerate(asked)}
        counted = self.token_days(reduce(lambda a, b: a | b, asked))
        bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(h) > 0, 1 << i).otherwise(0) for i, h in enumerate(_HOURS)])
        rows = counted.select("log_date", bits.alias("_bits"), *[f.alias(n) for n, f in flags.items()])
        days = rows.groupBy("log_date").agg(*[F.bit_or(F.when(F.col(n), F.col("_bits")).otherwise(0)).alias(n) for n in flags])
        mask = reduce(lambda a, b: a.bitwiseAND(b), [F.col(n) for n in flags])
        return days.select("log_date", mask.alias("hours")).where("hours != 0")

    def _near(self, logs: DataFrame, masks: DataFrame) -> DataFrame:
        """Rows of the hours that the masks name: as static filters while these are few, else by a join of days."""
        masks = materialise(masks, "hours")
        found = [(r["log_date"].toordinal() - _EPOCH_DAY, r["hours"]) for r in masks.limit(DAYS + 1).collect()]
        if len(found) > DAYS:
            days = masks.withColumnsRenamed({"log_date": "_day", "hours": "_hours"})
            in_hour = F.expr(f"shiftright(_hours, cast(floor(pmod(epoch_ms, {DAY_MS}L) / {HOUR_MS}) as int)) & 1 = 1")
            return logs.join(days, (F.col("log_date") == F.col("_day")) & in_hour, "left_semi")
        if not found:
            return logs.where("false")
        on_days = F.col("log_date").isin([day_of(d * DAY_MS) for d, _ in found])
        hours = [24 * d + i for d, mask in found for i in range(24) if mask >> i & 1]
        inside = all(_FIRST < d < _LAST for d, _ in found)  # edge days also hold what lies beyond the calendar
        if len(hours) > HOURS or not inside:
            return logs.where(on_days)
        spans = [F.col("epoch_ms").between(h * HOUR_MS, (h + 1) * HOUR_MS - 1) for h in sorted(hours)]
        return logs.where(on_days & reduce(lambda a, b: a | b, spans))

    # ---- error windows ------------------------------------------------------------

    def anomalies(self, z: float = DEFAULT_Z, window_ms: int = DEFAULT_WINDOW_MS, valid_only: bool = False) -> tuple[DataFrame, DataFrame]:
        """``(alerts, baseline)`` as :func:`detect_anomalies` finds them, from the counts alone.

        Of the log rows only those of the first and the last hour are read, two columns wide,
        for the exact ends of the table.
        """
        check_window(window_ms)
        valid = F.col("ts_valid") if valid_only else F.lit(True)
        hours = self._row_hours().where(valid).groupBy("hour").agg(F.sum("rows").alias("rows")).where("rows > 0")
        first, last, rows = hours.agg(F.min("hour"), F.max("hour"), F.sum("rows")).first()
        lo = hi = None
        if rows:
            day = lambda h: day_of(h * HOUR_MS)
            ends = [(F.col("log_date") == day(h)) & F.col("epoch_ms").between(h * HOUR_MS, (h + 1) * HOUR_MS - 1) for h in (first, last)]
            lo, hi = self.logs().where(valid & (ends[0] | ends[1])).agg(F.min("epoch_ms"), F.max("epoch_ms")).first()
        return anomalies_from_counts(self._error_times().where(valid), lo, hi, rows or 0, z, window_ms)


def folded(field: Column) -> Column:
    """Level or service as equality ignoring case sees it, as a token."""
    return strip_blank(F.lower(F.upper(field)))


def _is_field(wanted: str) -> Column:
    return F.col("token") == folded(F.lit(wanted))


def token_days(logs: DataFrame) -> DataFrame:
    """Rows per token, day and hour of the day, level and service among the tokens.

    A token that all rows have makes one row a day. Levels and services also count under
    the form in which they are compared ignoring case, so that a filter finds their hours.
    """
    fields = F.array(*[F.coalesce(folded(F.col(c)), F.lit("")) for c in ("service", "level")])
    tokens = F.array_remove(F.array_distinct(F.concat(log_tokens(F.col("service"), F.col("level"), F.col("message")), fields)), "")
    hour = F.floor(F.pmod("epoch_ms", F.lit(DAY_MS)) / F.lit(HOUR_MS))
    rows = logs.select(log_date(F.col("epoch_ms")).alias("log_date"), hour.alias("_hour"), F.explode(tokens).alias("token"))
    return rows.groupBy("token", "log_date").agg(*[F.count_if(F.col("_hour") == i).alias(h) for i, h in enumerate(_HOURS)])


def _by_token(days: DataFrame) -> DataFrame:
    """Token days in order, so that a term reads the row groups it can be in."""
    return days.withColumn("_head", token_head(F.col("token"))).hint("rebalance", "_head").sortWithinPartitions("token", "log_date")


def _counts(logs: DataFrame) -> dict[str, DataFrame]:
    return {"token_days": _by_token(token_days(logs)), "error_times": error_times(logs), "row_hours": row_hours(logs)}


def _parts_of_tokens(days: DataFrame) -> dict[str, DataFrame]:
    """Each token reversed, and its grams; in order, by a hash of the first characters."""
    tokens = days.select("token").distinct()
    tails = tokens.select(F.reverse("token").alias("reversed"), "token")
    last = F.length("token") - (GRAM - 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substr(F.col("token"), i, F.lit(GRAM))))
    grams = tokens.select(F.explode(grams).alias("gram"), "token")

    def sorted_(df, key):
        return df.withColumn("_head", F.left(key, F.lit(2))).hint("rebalance", "_head").sortWithinPartitions(key, "token").drop("_head")

    return {"tails": sorted_(tails, "reversed"), "grams": sorted_(grams, "gram")}


def error_times(logs: DataFrame) -> DataFrame:
    """ERROR rows per millisecond: the windows of spike detection may begin at any."""
    return logs.where(F.upper("level") == "ERROR").groupBy("epoch_ms", "ts_valid").agg(F.count("*").alias("errors"))


def row_hours(logs: DataFrame) -> DataFrame:
    """Rows per hour."""
    hour = F.floor(F.col("epoch_ms") / F.lit(HOUR_MS)).alias("hour")
    return logs.groupBy(hour, "ts_valid").agg(F.count("*").alias("rows"))
