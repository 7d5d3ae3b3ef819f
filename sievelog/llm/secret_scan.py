"""Secret scans through a trigram inverted index, in DataFrame operations only.

For each rule a Boolean query over trigrams is derived from its regular expression: a
match must hold all trigrams of one of its alternatives. Postings (trigram, document) are
kept for the trigrams that some rule asks for, intersected per alternative, and the texts
of the candidates are searched with the expression itself. A rule with an alternative
without trigrams searches every text.
"""

import re
from dataclasses import dataclass
from re import _constants as tokens
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelog.llm.common import materialise, whole


@dataclass(frozen=True)
class Rule:
    """``kind``, a Java and Python pattern, and the fewest characters its ``group`` may have."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


#: The first three are the base kinds, in the order in which equal starts are listed.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]+", 15),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 60),
)
BASE = ("assign", "access", "hex")
#: A class of more characters than this ends a literal, as an optional class does.
_FEW = 4


def _literals(ast) -> list[tuple[str, ...]]:
    """Alternatives of an expression; each is its literal runs, in order, parted by ''."""
    found: list[tuple[str, ...]] = [("",)]

    def then(more: list[tuple[str, ...]]) -> None:
        found[:] = list(dict.fromkeys(a[:-1] + (a[-1] + b[0],) + b[1:] for a in found for b in more))

    for op, arg in ast:
        if op is tokens.LITERAL:
            then([(chr(arg).lower(),)])
        elif op is tokens.IN and 0 < len(arg) <= _FEW and all(o is tokens.LITERAL for o, _ in arg):
            then([(chr(c).lower(),) for _, c in arg])
        elif op is tokens.SUBPATTERN:
            then(_literals(arg[-1]))
        elif op is tokens.BRANCH:
            then([x for branch in arg[1] for x in _literals(branch)])
        elif op is tokens.MAX_REPEAT and arg[:2] == (0, 1) and arg[2][0][0] is tokens.LITERAL:
            then([("",), *_literals(arg[2])])
        elif op is tokens.MAX_REPEAT and arg[0] >= 1:
            then([x + ("",) for x in _literals(arg[2])])
        elif op is not tokens.AT:
            then([("", "")])
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives as sets of trigrams a match holds all of, lower case; None if one has none."""
    sets = [frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)) for runs in _literals(parser.parse(pattern))]
    if not all(sets):
        return None
    return [s for s in dict.fromkeys(sets) if not any(o < s for o in sets)]


def _queries(rules) -> tuple[list[str], list[tuple[int, int, str, int]]]:
    """The trigrams asked for, and rows (rule, alternative, trigram, trigrams of the alternative)."""
    rows = [
        (r, a, t, len(alternative))
        for r, rule in enumerate(rules)
        for a, alternative in enumerate(trigram_query(rule.pattern) or [])
        for t in sorted(alternative)
    ]
    return sorted({t for _, _, t, _ in rows}), rows


def trigram_postings(docs: DataFrame, id_col="doc_id", text_col="text", rules=RULES) -> DataFrame:
    """Postings on shared files: trigram, doc_id, text_hash; only trigrams of the rules."""
    wanted, _ = _queries(rules)
    low = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.lower(whole(text_col)).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in wanted]))
    postings = low.select("doc_id", "text_hash", F.explode(held).alias("trigram"))
    return materialise(postings, "trigram-postings")


def candidates(spark: SparkSession, postings: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, text_hash and the rules (bits) of which some alternative has all its trigrams."""
    _, rows = _queries(rules)
    names = ("rule", "alternative", "trigram", "need", "bit")
    cells = [F.struct(*[F.lit(v).alias(k) for k, v in zip(names, (*row, 1 << row[0]), strict=True)]) for row in rows]
    asked = spark.range(1).select(F.inline(F.array(*cells)))
    met = (
        postings.join(F.broadcast(asked), "trigram")  # one row per trigram of each rule
        .groupBy("doc_id", "text_hash", "bit", "alternative", "need")
        .agg(F.count_distinct("trigram").alias("held"))
        .where("held = need")
    )
    return met.groupBy("doc_id", "text_hash").agg(F.bit_or("bit").alias("rules"))


def _spans(text: str, rule: Rule, n: int) -> Column:
    """The kept matches of one rule: structs of start, rule number and end, in code points."""
    all_, part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(between.alias("gap"), all_.alias("match"), part.alias("part"))
    kind = "array<struct<start:int,rule:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(s, x):
        begin = s["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(n).alias("rule"), end.alias("end"))
        keep = F.coalesce(F.length(x["part"]) >= rule.least, F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.array_append(s["out"], span)).otherwise(s["out"]).alias("out"))

    return F.aggregate(steps, start, step, lambda s: s["out"])


def _quick(rule: Rule) -> str:
    """Holds wherever the rule can match and its whole match is long enough."""
    tail = re.fullmatch(r"(\[[^]]+\])\+", rule.pattern)
    return f"{tail[1]}{{{rule.least}}}" if tail else rule.pattern


def secret_spans(docs: DataFrame, id_col="doc_id", text_col="text", rules=RULES) -> DataFrame:
    """A row per row of ``docs``: doc_id, spans (start, rule, end; by start, then rule).

    Matches are leftmost and do not overlap within a kind; those whose group is too short
    are dropped after matching. Null and empty texts have no spans; rows that repeat id
    and text are each reported. Empty in, empty out.
    """
    # Stored, so that the planner knows their size: while they are few they go to the texts, and no text moves.
    found = materialise(candidates(docs.sparkSession, trigram_postings(docs, id_col, text_col, rules), rules), "candidates")
    found = found.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "rules")
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    rows = rows.join(found, (F.col("text_hash") == F.col("c_hash")) & F.col("doc_id").eqNullSafe(F.col("c_id")), "left")
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    per_rule = []
    for n, rule in enumerate(rules):
        ask = F.col("text").rlike(_quick(rule))
        if trigram_query(rule.pattern):
            ask = (F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(1 << n) != 0) & ask
        per_rule.append(F.when(ask, _spans("text", rule, n)).otherwise(none))
    return rows.select("doc_id", F.sort_array(F.concat(*per_rule)).alias("spans"))


def spans_text(spans: Column, rules=RULES) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])), ",")
