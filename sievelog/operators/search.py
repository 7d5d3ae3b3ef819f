"""Search over a table of log rows.

Every search is a conjunction of row predicates on one table, so Catalyst combines
them and hands the time bounds to the scan. Only the order the user sees needs a
shuffle: to count, preview or store matches, take them from :func:`matching`.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelog.functions.text import contains_text, has_glob, has_prefix, has_token, same_text
from sievelog.functions.timestamps import bound_ms, day_of, resolve_bounds
from sievelog.operators.analytics import time_extent
from sievelog.session import materialise


def in_time_order(logs: DataFrame, deal: bool = True) -> DataFrame:
    """Ascending time, ties by id.

    A global sort first samples its input, which would run a search over the whole
    table twice. So the matches are dealt out evenly once, and the sort samples and
    reads those. Its ranges also run over the partition a row was dealt to, so that
    many rows with one time and one id do not all end up in one task. Where the rows are
    most of what was scanned, as for a broad range of a clustered table, reading twice is
    cheaper than dealing: then give ``deal=False``.
    """
    if not deal:
        return logs.orderBy("epoch_ms", "log_id")
    dealt = logs.hint("rebalance").withColumn("_dealt", F.spark_partition_id())
    return dealt.orderBy("epoch_ms", "log_id", "_dealt").drop("_dealt")


def time_between(logs: DataFrame, start_ms: int, end_ms: int) -> Column:
    """Inclusive time bounds; on a day-partitioned table also the days they touch."""
    cond = F.col("epoch_ms").between(start_ms, end_ms)
    if "log_date" in logs.columns:
        cond = cond & F.col("log_date").between(day_of(start_ms), day_of(end_ms))
    return cond


def text_condition(keyword=None, prefix=None, wildcard=None) -> Column | None:
    """The one text filter in force: keyword before prefix before wildcard."""
    if keyword:
        return has_token(keyword)
    if prefix:
        return has_prefix(prefix)
    if wildcard:
        return has_glob(wildcard)
    return None


def first_per_id(logs: DataFrame) -> DataFrame:
    """One row per id: the smallest by time, service, level, message.

    Ids are counted alone first, without a row's text. Only rows of ids met more than
    once are compared, by a minimum over a struct: copies of one id collapse before the
    shuffle, where a ranking window would bring all of them into one task. ``logs`` is read
    several times, so searches store their hits first.
    """
    order = ["epoch_ms", "service", "level", "message"]
    rest = [c for c in logs.columns if c not in order and c != "log_id"]
    again = logs.groupBy("log_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("log_id").alias("_again"))
    met = logs.join(again, F.col("log_id").eqNullSafe(F.col("_again")), "left_semi")
    first = met.groupBy("log_id").agg(F.min(F.struct(*order, *rest)).alias("_row"))
    alone = logs.join(again, F.col("log_id").eqNullSafe(F.col("_again")), "left_anti")
    return alone.unionByName(first.select("log_id", "_row.*").select(*logs.columns))


def search_exact(logs: DataFrame, word: str) -> DataFrame:
    """Rows with ``word`` among their tokens, ignoring case."""
    return logs.where(has_token(word))


def search_prefix(logs: DataFrame, prefix: str, unique_ids: bool = True) -> DataFrame:
    """Rows with a token starting with ``prefix``; ``unique_ids=False`` keeps one per id."""
    hits = logs.where(has_prefix(prefix))
    return hits if unique_ids else first_per_id(materialise(hits, "hits"))


def search_wildcard(logs: DataFrame, pattern: str, unique_ids: bool = True) -> DataFrame:
    """Rows with a whole token matching ``pattern``; ``unique_ids=False`` keeps one per id."""
    hits = logs.where(has_glob(pattern))
    return hits if unique_ids else first_per_id(materialise(hits, "hits"))


def search_time_range(logs: DataFrame, start_ms: int, end_ms: int, deal: bool = True) -> DataFrame:
    """Rows between both times inclusive, ascending; nothing if start is after end."""
    return in_time_order(logs.where(time_between(logs, start_ms, end_ms)), deal)


def search_time_text(logs: DataFrame, start="", end="", zone: str = "UTC") -> DataFrame:
    """Time range from user text in ``zone``: blank or unreadable bounds mean the table's own extent."""
    lo, hi = bound_ms(start, zone), bound_ms(end, zone)
    if lo is None or hi is None:
        extent = time_extent(logs).first()
        lo, hi = resolve_bounds(lo, hi, extent["min_ms"] or 0, extent["max_ms"] or 0)
    return search_time_range(logs, min(lo, hi), max(lo, hi))


def search_time_exact(logs: DataFrame, epoch_ms: int) -> DataFrame:
    """All rows of one millisecond."""
    rows = logs.where(F.col("epoch_ms") == epoch_ms)
    return rows.where(F.col("log_date") == day_of(epoch_ms)) if "log_date" in logs.columns else rows


def search_substring(logs: DataFrame, text: str) -> DataFrame:
    """Rows whose message contains ``text``, ignoring case."""
    return logs.where(contains_text(text))


def filter_level(logs: DataFrame, level: str | None) -> DataFrame:
    cond = same_text(F.col("level"), level)
    return logs if cond is None else logs.where(cond)


def filter_service(logs: DataFrame, service: str | None) -> DataFrame:
    cond = same_text(F.col("service"), service)
    return logs if cond is None else logs.where(cond)


def matching(
    logs: DataFrame,
    keyword: str | None = None,
    prefix: str | None = None,
    wildcard: str | None = None,
    start_ms: int | None = None,
    end_ms: int | None = None,
    level: str | None = None,
    service: str | None = None,
    unique_ids: bool = True,
) -> DataFrame:
    """Rows that pass all given filters, in no order."""
    if (start_ms is None) != (end_ms is None):
        raise ValueError("give both time bounds or none")
    text = text_condition(keyword, prefix, wildcard)
    rows = logs if text is None else logs.where(text)
    if text is not None and not keyword and not unique_ids:
        rows = first_per_id(materialise(rows, "hits"))
    if start_ms is not None:
        rows = rows.where(time_between(rows, start_ms, end_ms))
    return filter_service(filter_level(rows, level), service)


def compound(logs: DataFrame, **filters) -> DataFrame:
    """Rows that pass all given filters (see :func:`matching`), ascending in time."""
    return in_time_order(matching(logs, **filters))


def compound_text(
    logs: DataFrame, text: str = "", level: str = "", service: str = "", start="", end="", zone: str = "UTC", **options
) -> DataFrame:
    """Compound search from user text.

    Text holding ``*`` is a wildcard, else a keyword; blank level or service mean
    ``ALL``; a blank or unreadable time bound drops the time filter. Times are in ``zone``.
    """
    text = text.strip()
    start_ms, end_ms = resolve_bounds(start, end, zone=zone)
    if start_ms is None or end_ms is None:
        start_ms = end_ms = None
    return compound(
        logs,
        keyword=None if "*" in text else text,
        wildcard=text if "*" in text else None,
        start_ms=start_ms,
        end_ms=end_ms,
        level=level.strip() or "ALL",
        service=service.strip() or "ALL",
        **options,
    )


def merge_by_time(*results: DataFrame) -> DataFrame:
    """Several results as one, ascending in time."""
    return in_time_order(reduce(DataFrame.unionByName, results))


def match_count(matches: DataFrame) -> DataFrame:
    """Number of matches as one row."""
    return matches.agg(F.count("*").alias("matches"))


def preview(matches: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` matches in time; each task keeps only ``n`` rows."""
    return matches.orderBy("epoch_ms", "log_id", "service", "level", "message").limit(n)
