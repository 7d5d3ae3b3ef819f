"""Many queries against many logs in one job.

Every query becomes a set of keys, every log row carries its keys, and one equi-join
brings them together. Keys are tokens for queries with text, UTC days for queries with
times only, else service or level. Prefixes and globs become tokens first, by an
equi-join of a short literal piece of the pattern with the same pieces of the distinct
tokens, so no query is tried against every token. A row that meets a pattern by several
tokens is reduced to one before it meets the queries that ask for the pattern. Queries that
ask the same are one row with a list of their ids, which is taken apart at the very end.

While the keys of the queries stay under a checked size they are broadcast and the logs
are read once; a batch of few queries without patterns leaves the rows where they are,
others deal out the rows that some query asks for, so that few input splits do not make
few tasks. Beyond that size, or when postings are given, the postings are joined instead,
and only the matching rows of the days with hits are fetched. What is found is made last
and goes through no shuffle, for queries times rows may be far more than either.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievelog.functions.keys import row_key
from sievelog.functions.text import has_any_token, log_tokens
from sievelog.functions.timestamps import log_date
from sievelog.operators.analytics import time_extent
from sievelog.operators.search import time_between
from sievelog.plans.postings import (
    HOUR_MS,
    build_postings,
    field_postings,
    has_fields,
    hit_days,
    on_days,
    token_dictionary,
    token_head,
)
from sievelog.schema import DAY_MS
from sievelog.session import materialise, measured

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Lengths of the literal pieces that stand for a pattern in the dictionary join: heads,
# tails, and pieces from inside.
_EDGE = 8
_GRAM = 3
_PIECES = [f"{kind}{n}" for kind, most in (("h", _EDGE), ("t", _EDGE), ("g", _GRAM)) for n in range(1, most + 1)]
# What keys other than tokens start with. Tokens are stripped of this character, so the
# kinds never meet.
_DAY, _HOUR, _SERVICE, _LEVEL, _ALWAYS = "\0d", "\0h", "\0s", "\0l", "\0"
_PREFIX, _GLOB = "\0p", "\0g"
_SHORT_MS = 2 * DAY_MS
# Queries with text and a span of times up to this one are looked up by day; for all others
# there is a day of its own.
_SPLIT_MS = 31 * DAY_MS
_NO_DAY = -(2**63)
# From so many keys on, rows are dealt out before they meet the queries.
_DEAL_KEYS = 2_000
# From so many hits on, rows and hits are dealt out alike before they meet.
_DEAL_HITS = 500_000
# So many ids of queries that ask the same lie in one list.
_IDS = 1_000
# Over the broadcast limit, the rows of one key are spread over so many tasks.
_SALTS = 16
# The kinds of key that stand for a slot of time and what else is asked of a row.
_SLOTS = [(slot, field) for slot in (_DAY, _HOUR) for field in (_SERVICE, _LEVEL, _ALWAYS)]

# Queries without a text filter, or with one that any token satisfies.
_PLAIN = "kind IN ('none', 'any')"
_TEXT = f"NOT {_PLAIN}"


def batch_search(
    logs: DataFrame,
    queries: DataFrame,
    postings: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    unique_ids: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``query_id`` plus the log columns, one row per query and matching log row.

    Each query means the same as one call of ``matching``; query rows that repeat each
    other count once. ``logs`` must be a table read from files, whose rows can be numbered
    the same way on a retry. ``postings`` and ``dictionary`` are used if given; where they
    leave out level and service, these are taken from the logs. ``broadcast_rows`` bounds
    the number of all query keys that are broadcast, one for queries that ask the same, and
    decides on the plan alone.
    """
    # One row per id is chosen before the other filters, so they must not choose the keys.
    narrow = "true" if unique_ids else "NOT one_per_id"
    dated = f"start_ms IS NOT NULL AND {narrow}"
    ids = F.col("_queries").cast("array<string>")
    text_bytes = _text_bytes("term", "q_level", "q_service", ids)
    plan, use = measured(
        _together(_normalise(queries)),
        "batch-queries",
        asked_rows=_count(_TEXT),
        asked_bytes=F.sum(F.when(F.expr(_TEXT), text_bytes)),
        split_rows=F.sum(F.when(F.expr(_TEXT), F.size(_days_asked()))),
        split_bytes=F.sum(F.when(F.expr(_TEXT), F.size(_days_asked()) * text_bytes)),
        keywords=_count("kind = 'keyword'"),
        **{p: _count(f"piece LIKE '{p[0]}%' AND char_length(piece) = {int(p[1:]) + 1}") for p in _PIECES},
        dated=_count(f"{_PLAIN} AND {dated}"),
        undated=_count(f"{_PLAIN} AND NOT ({dated})"),
        field_bytes=F.sum(_text_bytes("q_level", "q_service", ids)),
        queries=F.sum(F.size("_queries")),
        half=_count("(start_ms IS NULL) <> (end_ms IS NULL)"),
        open=_count("start_ms IS NULL"),
        lo=F.min("start_ms"),
        hi=F.max("end_ms"),
    )
    if use["half"]:
        raise ValueError("give both time bounds or none")
    pieces = [p for p in _PIECES if use[p]]

    if unique_ids and use["open"] == 0 and use["lo"] is not None:
        logs = logs.where(time_between(logs, use["lo"], use["hi"]))
        if postings is not None:
            postings = postings.where(F.col("epoch_ms").between(use["lo"], use["hi"]))
        if dictionary is not None and "max_epoch_ms" in dictionary.columns:
            dictionary = dictionary.where((F.col("max_epoch_ms") >= use["lo"]) & (F.col("min_epoch_ms") <= use["hi"]))
    if postings is not None and not has_fields(postings):
        fields = field_postings(logs)
        if dictionary is not None:
            dictionary = dictionary.select("token").unionByName(fields.select("token")).distinct()
        if "head" in postings.columns:
            fields = fields.withColumn("head", token_head(F.col("token")))
        postings = postings.unionByName(fields, allowMissingColumns=True)

    results, slots, words = [], [], None
    keyed, n_keys = {}, 0
    split = unique_ids
    room = _Room(broadcast_rows, BROADCAST_BYTES)
    if use["keywords"] or pieces:
        resolved = _resolve(plan, pieces, logs, postings, dictionary)
        words, size = measured(resolved, "batch-words", rows=F.count(F.lit(1)), bytes=F.sum(_text_bytes("key", "ask")))
        asked, by_day = ({k: use[f"{kind}_{k}"] or 0 for k in size} for kind in ("asked", "split"))
        if postings is None:
            asked, by_day = ({k: v + (size[k] or 0) for k, v in kind.items()} for kind in (asked, by_day))
        split = unique_ids and (room.fits(by_day) or not room.fits(asked))
        asks = _asks(plan, split)
        fits = room.take(by_day if split else asked)
        if postings is None and fits:
            keyed["tokens"], n_keys = asks, use["split_rows"]
        else:
            if postings is None:
                postings = materialise(build_postings(logs), "batch-postings")
            if _Room(broadcast_rows, BROADCAST_BYTES).fits(size):
                words = F.broadcast(words)
            results.append(_by_postings(logs, postings, words, asks, unique_ids, fits))
    plain = plan.where(_PLAIN)
    asked = {"rows": use["undated"], "bytes": use["field_bytes"]}
    if use["undated"] and room.take(asked):
        keyed["fields"] = _field_keys(plain.where(f"NOT ({dated})"), narrow)
        n_keys += asked["rows"]
        plain = plain.where(dated)
        use["undated"] = 0
    if use["dated"] or use["undated"]:
        asked = {str(n): _count(_is_slot(kind)) for n, kind in enumerate(_SLOTS)}
        days, size = measured(_day_keys(plain, logs, dated), "batch-days", **_size(), **asked)
        # A row carries keys of the kinds that some query asks for, and no other.
        slots = [kind for n, kind in enumerate(_SLOTS) if size.pop(str(n))]
        if room.take(size):
            keyed["days"] = days
            n_keys += size["rows"]
        elif slots:
            results.append(_by_scan(logs, days, unique_ids, {"days"}, slots, broadcast=False))
    if keyed:
        if "tokens" in keyed and split:
            keyed = {k: v if k == "tokens" else v.withColumn("_day", F.lit(_NO_DAY)) for k, v in keyed.items()}
        keys = reduce(DataFrame.unionByName, keyed.values())
        words = words if "tokens" in keyed and pieces else None
        deal = max(n_keys, use["queries"]) >= _DEAL_KEYS
        results.append(_by_scan(logs, keys, unique_ids, set(keyed), slots, words, deal))
    if not results:
        return logs.limit(0).select(F.lit(0).cast("bigint").alias("query_id"), *logs.columns)
    return reduce(DataFrame.unionByName, results)


def _count(condition: str) -> Column:
    return F.count_if(F.expr(condition))


def _normalise(queries: DataFrame) -> DataFrame:
    """One kind and one lower-case term per query; blank and ``ALL`` become NULL."""
    given = {c: F.nullif(F.lower(F.col(c)), F.lit("")) for c in ("keyword", "prefix", "wildcard")}
    keyword, prefix, wildcard = (F.col(f"_{c}") for c in given)
    stars = F.regexp_replace(wildcard, r"\*+$", "")
    kind = (
        F.when(keyword.isNotNull(), "keyword")
        .when(prefix.isNotNull(), "prefix")
        .when(wildcard.isNull(), "none")
        .when(stars == "", "any")
        .when(~F.contains(wildcard, F.lit("*")), "keyword")
        .when(~F.contains(stars, F.lit("*")), "prefix")
        .otherwise("glob")
    )
    # Only a term with nothing but trailing stars may lose them.
    bare = F.when(F.contains(stars, F.lit("*")), wildcard).otherwise(stars)
    fields = [
        F.when(F.upper(c) != "ALL", F.upper(c)).alias(f"q_{c}") for c in ("level", "service")
    ]
    return (
        queries.select(
            "query_id", "start_ms", "end_ms", *fields, *[v.alias(f"_{c}") for c, v in given.items()]
        )
        .withColumn("kind", kind)
        .withColumn("term", F.coalesce(keyword, prefix, bare))
        .withColumn("one_per_id", keyword.isNull() & F.coalesce(prefix, wildcard).isNotNull())
        .drop("_keyword", "_prefix", "_wildcard")
        .withColumn("piece", _piece())
    )


def _together(queries: DataFrame) -> DataFrame:
    """Queries that ask the same as one row, their ids as lists of at most :data:`_IDS`."""
    same = [c for c in queries.columns if c != "query_id"]
    place = F.dense_rank().over(Window.partitionBy(*same).orderBy("query_id")) - 1
    # Lists leave out nulls, so the null id has a list of its own.
    part = F.when(F.isnotnull("query_id"), F.floor(place / F.lit(_IDS)))
    none = F.array(F.lit(None).cast(queries.schema["query_id"].dataType))
    ids = F.when(F.isnull("_part"), none).otherwise(F.sort_array(F.collect_set("query_id")))
    return queries.withColumn("_part", part).groupBy(*same, "_part").agg(ids.alias("_queries")).drop("_part")


def _piece() -> Column:
    """The literal piece of a prefix or glob by which the dictionary join finds it."""
    parts = F.split("term", r"\*+")
    head, tail = F.get(parts, F.lit(0)), F.element_at(parts, -1)
    inner = F.get(F.array_remove(parts, ""), F.lit(0))
    glob = (
        F.when(head != "", F.concat(F.lit("h"), F.left(head, F.lit(_EDGE))))
        .when(tail != "", F.concat(F.lit("t"), F.right(tail, F.lit(_EDGE))))
        .otherwise(F.concat(F.lit("g"), F.left(inner, F.lit(_GRAM))))
    )
    prefix = F.concat(F.lit("h"), F.left("term", F.lit(_EDGE)))
    return F.when(F.col("kind") == "prefix", prefix).when(F.col("kind") == "glob", glob)


_RESIDUAL = ["start_ms", "end_ms", "q_level", "q_service"]
_QUERY = ["_queries", "kind", *_RESIDUAL, "one_per_id"]


def _ask() -> Column:
    """What a query with text asks of a row: a token, or the pattern, marked as such."""
    return F.when(F.col("kind") == "keyword", F.col("term")).otherwise(
        F.concat(F.when(F.col("kind") == "prefix", F.lit(_PREFIX)).otherwise(F.lit(_GLOB)), "term")
    )


def _asks(plan: DataFrame, split: bool) -> DataFrame:
    """Queries with text by what they ask; with ``split`` one row per day of a span that is not long."""
    asks = plan.where(_TEXT).select(*_QUERY, _ask().alias("key"))
    return asks.withColumn("_day", F.explode(_days_asked())) if split else asks


def _days_asked() -> Column:
    """The days on which a query finds rows; :data:`_NO_DAY` alone where they are not listed."""
    span = F.col("end_ms").cast("double") - F.col("start_ms")
    days = F.sequence(_day_number("start_ms"), _day_number("end_ms"))
    return (
        F.when(F.col("start_ms") > F.col("end_ms"), F.array().cast("array<bigint>"))
        .when(span <= _SPLIT_MS, days)
        .otherwise(F.array(F.lit(_NO_DAY)))
    )


def _day_number(ms: str) -> Column:
    return F.floor(F.col(ms) / F.lit(DAY_MS)).cast("bigint")


def _resolve(plan, pieces, logs, postings, dictionary) -> DataFrame:
    """The tokens that a row may have for what is asked, one row per token and ``ask``."""
    exact = plan.where("kind = 'keyword'").select(F.col("term").alias("key"), _ask().alias("ask")).distinct()
    if not pieces:
        return exact
    if dictionary is None:
        dictionary = token_dictionary(build_postings(logs) if postings is None else postings)

    like = F.replace(F.regexp_replace("term", r"([\\%_])", r"\\$1"), F.lit("*"), F.lit("%"))
    wanted = plan.where("kind IN ('prefix', 'glob')").select(
        _ask().alias("ask"), "term", "piece", F.when(F.col("kind") == "glob", like).alias("like")
    )
    tokens = dictionary.select("token", F.explode(_pieces(F.col("token"), pieces)).alias("piece"))
    fits = F.when(F.col("like").isNull(), F.startswith("token", "term")).otherwise(
        F.like(F.col("token"), F.col("like"), F.lit("\\"))
    )
    found = tokens.join(wanted.distinct(), "piece").where(fits)
    return exact.unionByName(found.select(F.col("token").alias("key"), "ask"))


def _pieces(token: Column, used: list[str]) -> Column:
    """The heads, tails and inner pieces of a token, of the lengths that patterns ask for."""
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    found = []
    for kind, size in ((p[0], int(p[1:])) for p in used):
        if kind == "g":
            found.append(_grams(chars, size))
            continue
        edge = F.left(token, F.lit(size)) if kind == "h" else F.right(token, F.lit(size))
        long = F.char_length(token) >= size
        found.append(F.when(long, F.array(F.concat(F.lit(kind), edge))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.concat(*found))


def _grams(chars: Column, size: int) -> Column:
    def gram(_, i):
        return F.concat(F.lit("g"), F.array_join(F.slice(chars, i + 1, F.lit(size)), ""))

    return F.transform(chars, gram)


def _field_keys(plan: DataFrame, narrow: str) -> DataFrame:
    """Queries without text and times, by service, else by level, else as always asked."""
    key = (
        F.when(~F.expr(narrow), _ALWAYS)
        .when(F.col("q_service").isNotNull(), F.concat(F.lit(_SERVICE), "q_service"))
        .when(F.col("q_level").isNotNull(), F.concat(F.lit(_LEVEL), "q_level"))
        .otherwise(_ALWAYS)
    )
    return plan.select(*_QUERY, key.alias("key"))


def _day_keys(plan: DataFrame, logs: DataFrame, dated: str) -> DataFrame:
    """Queries without text, one row per slot of time they cover within the table's extent.

    A short span is covered by hours, a longer one by days. The key also holds the
    service or else the level that is asked for, so a row meets few of its day's queries.
    """
    extent = time_extent(logs).first()
    lo, hi = extent["min_ms"] or 0, extent["max_ms"] or 0
    start, end = (F.when(F.expr(dated), F.col(c)) for c in ("start_ms", "end_ms"))
    start = F.greatest(F.coalesce(start, F.lit(lo)), F.lit(lo))
    end = F.least(F.coalesce(end, F.lit(hi)), F.lit(hi))
    spans = plan.withColumns({"_lo": start, "_hi": end}).where("_lo <= _hi")
    short = F.col("_hi") - F.col("_lo") <= _SHORT_MS
    first, last = (F.floor(F.col(c) / F.lit(HOUR_MS)).cast("bigint") for c in ("_lo", "_hi"))
    hours = spans.where(short).select(*_QUERY, F.explode(F.sequence(first, last)).alias("_hour"))
    hours = hours.select(*_QUERY, "_hour", log_date(F.col("_hour") * F.lit(HOUR_MS)).alias("_day"))
    days = F.explode(F.sequence(log_date(F.col("_lo")), log_date(F.col("_hi"))))
    covered = spans.where(~short).select(*_QUERY, F.lit(None).cast("bigint").alias("_hour"), days.alias("_day"))
    covered = covered.unionByName(hours)
    if (hi - lo) // DAY_MS > 3660:
        # A few stray times stretch the extent; keep only days that hold rows.
        covered = covered.join(
            logs.select(log_date(F.col("epoch_ms")).alias("_day")).distinct(), "_day", "left_semi"
        )
    narrow = F.expr("NOT one_per_id") if dated.endswith("NOT one_per_id") else F.lit(True)
    field = F.when(narrow & F.col("q_service").isNotNull(), F.concat(F.lit(_SERVICE), "q_service")).when(
        narrow & F.col("q_level").isNotNull(), F.concat(F.lit(_LEVEL), "q_level")
    )
    slot = F.coalesce(_hour_key(F.col("_hour")), _day_key(F.col("_day")))
    return covered.select(*_QUERY, F.concat(slot, F.coalesce(field, F.lit(_ALWAYS))).alias("key"))


def _day_key(day: Column) -> Column:
    return F.concat(F.lit(_DAY), day.cast("string"))


def _hour_key(hour: Column) -> Column:
    return F.concat(F.lit(_HOUR), hour.cast("string"))


def _is_slot(kind: tuple[str, str]) -> str:
    """SQL that is true for keys of one kind of :data:`_SLOTS`; the field begins at the second null character."""
    slot, field = kind
    rest = "substring(key, locate(char(0), key, 2))"
    tail = f"{rest} = char(0)" if field == _ALWAYS else f"startswith({rest}, concat(char(0), '{field[1]}'))"
    return f"startswith(key, concat(char(0), '{slot[1]}')) AND {tail}"


def _slot_keys(slots: list[tuple[str, str]]) -> list[Column]:
    """The keys of a row, of the kinds given."""
    at = {
        _DAY: _day_key(log_date(F.col("epoch_ms"))),
        _HOUR: _hour_key(F.floor(F.col("epoch_ms") / F.lit(HOUR_MS)).cast("bigint")),
    }
    says = dict(zip((_SERVICE, _LEVEL, _ALWAYS), _field_names(), strict=True))
    return [F.concat(at[slot], says[field]) for slot, field in slots]


def _field_names() -> list[Column]:
    """What the key of a query without text can say of a row's fields."""
    service, level = F.concat(F.lit(_SERVICE), F.upper("service")), F.concat(F.lit(_LEVEL), F.upper("level"))
    return [service, level, F.lit(_ALWAYS)]


def _size() -> dict[str, Column]:
    ids = F.col("_queries").cast("array<string>")
    return {"rows": F.count(F.lit(1)), "bytes": F.sum(_text_bytes("key", "q_level", "q_service", ids))}


def _text_bytes(*columns: str | Column) -> Column:
    return F.octet_length(F.concat_ws("", *columns))


class _Room:
    """What may still be broadcast, in rows and in bytes, of all key tables together."""

    def __init__(self, rows: int, size: int):
        self.left = {"rows": rows, "bytes": size}

    def fits(self, size: dict) -> bool:
        return all((size[k] or 0) <= self.left[k] for k in self.left)

    def take(self, size: dict) -> bool:
        """Take the room of a counted table if there is enough."""
        if not self.fits(size):
            return False
        self.left = {k: v - (size[k] or 0) for k, v in self.left.items()}
        return True


def _residual(level: Column | None = None, service: Column | None = None) -> Column:
    """Time, level and service of the query, on a row joined with it."""
    return (F.col("start_ms").isNull() | F.col("epoch_ms").between(F.col("start_ms"), F.col("end_ms"))) & _same_fields(
        F.upper("level") if level is None else level, F.upper("service") if service is None else service
    )


def _same_fields(level: Column, service: Column) -> Column:
    return (F.col("q_level").isNull() | (level == F.col("q_level"))) & (
        F.col("q_service").isNull() | (service == F.col("q_service"))
    )


def _by_scan(
    logs: DataFrame,
    keys: DataFrame,
    unique_ids: bool,
    kinds: set[str],
    slots: list[tuple[str, str]],
    words: DataFrame | None = None,
    deal: bool = False,
    broadcast: bool = True,
) -> DataFrame:
    """Explode each row's keys and look them up; only matches are kept.

    With ``words`` the tokens become what is asked, each once per row.
    """
    columns = logs.columns
    own = []
    if "days" in kinds:
        own += _slot_keys(slots)
    if "fields" in kinds:
        own += _field_names()
    every = F.array(*own).cast("array<string>")
    if "tokens" in kinds:
        tokens = log_tokens(F.col("service"), F.col("level"), F.col("message"))
        # Even with nothing to add this keeps an expression: over a plain column Spark
        # adds a filter on its size, and that would split every message a second time.
        every = F.concat(tokens, every)
    # What the queries are compared with is worked out once a row, below the explode.
    row = {"_level": F.upper("level"), "_service": F.upper("service")}
    if kinds != {"tokens"}:
        row["_worded"] = has_any_token()
    rows = logs.withColumns(row | {"_row": F.monotonically_increasing_id()})
    found = rows.select(*columns, *row, "_row", F.explode(every).alias("key"))
    if words is not None or deal:
        asked = keys.select("key", F.col("key").alias("ask")).distinct()
        if words is not None:
            asked = asked.unionByName(words.where("key <> ask"))
        found = found.join(F.broadcast(asked) if broadcast else asked, "key").drop("key").withColumnRenamed("ask", "key")
    if deal:
        # Side by side, the copies of a row take hardly more room than one.
        found = found.repartition(_tasks(logs), "_row")
    if words is not None:
        kept = [F.any_value(c).alias(c) for c in (*columns, *row)]
        found = found.groupBy("_row", "key").agg(*kept)
    return _finish(_meet(found, keys, unique_ids, broadcast), columns, unique_ids)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _meet(found: DataFrame, keys: DataFrame, unique_ids: bool, broadcast: bool) -> DataFrame:
    """Rows with a key, by the queries of that key. The last join: nothing that it makes is moved."""
    on = ["key"]
    if "_day" in keys.columns:
        on.append("_day")
        found = found.withColumn("_day", F.explode(F.array(F.lit(_NO_DAY), _day_number("epoch_ms"))))
    if broadcast:
        keys = F.broadcast(keys)
    else:
        # The rows of one key, with all its queries, are spread over tasks.
        on.append("_salt")
        found = found.withColumn("_salt", F.pmod(F.xxhash64("log_id", "epoch_ms"), F.lit(_SALTS)))
        keys = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))))
        found, keys = (side.repartition(_tasks(side), *on) for side in (found, keys))
    met = found.join(keys, on)
    if "_worded" in found.columns:
        met = met.where(F.col("_worded") | (F.col("kind") != "any"))
    if unique_ids:
        met = met.where(_residual(F.col("_level"), F.col("_service")))
    return met


def _by_postings(logs, postings, words, asks, unique_ids, broadcast) -> DataFrame:
    """Join the postings with what is asked, then fetch the rows found from the days that hold them."""
    columns = logs.columns
    if "head" in postings.columns:
        # One value per folder at most; the folders that hold no wanted token are not read.
        heads = [r[0] for r in words.select(token_head(F.col("key"))).distinct().collect()]
        postings = postings.where(F.col("head").isin(heads)).drop("head")
    found = postings.withColumnRenamed("token", "key").join(words, "key")
    if unique_ids:
        # A hit must be of a day, a level and a service that some query wants.
        found = found.drop("key").withColumnRenamed("ask", "key")
        on, fields = ["key"], ["q_level", "q_service"]
        if "_day" in asks.columns:
            on.append("_day")
            found = found.withColumn("_day", F.explode(F.array(F.lit(_NO_DAY), _day_number("epoch_ms"))))
        wanted = asks.select(*on, *fields).distinct()
        if broadcast:
            wanted = F.broadcast(wanted)
        met = found.join(wanted, on).where(_same_fields(F.upper("level"), F.upper("service")))
        found = met.withColumnRenamed("key", "ask")
    # One hit a row, with all that it has of what is asked.
    of = ["log_id", "epoch_ms", "row_key"]
    hits = materialise(found.groupBy(*of).agg(F.collect_set("ask").alias("_keys")), "batch-hits")
    if "log_date" in columns:
        logs = logs.where(on_days(hit_days(hits)))
    rows = logs.withColumns({"row_key": row_key(), "_level": F.upper("level"), "_service": F.upper("service")})
    # Size decides: a small written table of hits is broadcast, a large one shuffled.
    many = broadcast and hits.count() >= _DEAL_HITS
    if many:
        rows, hits = (side.repartition(_tasks(logs), *of) for side in (rows, hits))
    picked = rows.join(hits, of)
    if broadcast and not many:
        picked = picked.repartition(_tasks(logs), "log_id", "row_key")
    picked = picked.withColumn("key", F.explode("_keys")).drop("_keys")
    return _finish(_meet(picked, asks, unique_ids, broadcast), columns, unique_ids)


def _finish(picked: DataFrame, columns: list[str], unique_ids: bool) -> DataFrame:
    query = F.explode("_queries").alias("query_id")
    if unique_ids:
        return picked.select(query, *columns)
    picked = picked.select(query, *columns, *_RESIDUAL, "one_per_id")
    plain = picked.where("NOT one_per_id").select("query_id", *columns, *_RESIDUAL)
    order = ["epoch_ms", "service", "level", "message"]
    rest = [c for c in columns if c not in (*order, "log_id")]
    first = (
        picked.where("one_per_id")
        .groupBy("query_id", *_RESIDUAL, "log_id")
        .agg(F.min(F.struct(*order, *rest)).alias("_first"))
        .select("query_id", *_RESIDUAL, "log_id", "_first.*")
    )
    return plain.unionByName(first).where(_residual()).select("query_id", *columns)
