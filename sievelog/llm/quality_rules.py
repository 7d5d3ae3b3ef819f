"""Quality rules with a verdict per host, in DataFrame operations only.

Each text is measured once, in its row. Rule failures are counted per host, a host's rate
is shrunk towards the mean by a beta prior fitted to all hosts by moments, so that a host
with few documents is not judged by them alone, and the verdict is joined to its documents.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import SPACES, WORD, materialise, whole

SYMBOLS = "#*$%&|<>"
#: The rules a host is judged by: name and condition on the measures of a document.
RULES = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > word_chars",
    "lines": "2 * n_dup_lines > n_lines",
}
BASE = ("short", "repeated")
#: A host goes when the shrunk rate of one rule is above this.
HOST_LIMIT = 0.5
#: Documents the prior may weigh, at least and at most.
PRIOR = (1.0, 1_000.0)


def domain_of(url: Column, labels: int = 2) -> Column:
    """The last ``labels`` names of a URL's host, lower case; null for null, empty where there is no host."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.substring_index(host, ".", -labels)


def text_measures(docs: DataFrame, text: Column) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Steps are columns of their own where a later one reads them more than once.
    """
    d = docs.withColumn("_t", text).withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD))
    three = F.transform(
        F.slice("_w", F.lit(3), F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), w),
    )
    d = d.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        three.alias("_three"),
    )
    d = d.withColumn("_again", F.size("_three") > F.size(F.array_distinct("_three")))
    at = F.sort_array(F.transform("_three", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_at", F.when(F.col("_again"), at))
    met = F.filter(
        "_at",
        lambda x, i: F.coalesce(F.get("_at", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_at", i + 1)["h"] == x["h"], F.lit(False)),
    )
    d = d.withColumn("_met", F.sort_array(F.transform(met, lambda x: x["i"])))
    n = F.size("_met")
    steps = F.zip_with(
        F.slice("_met", F.lit(2), n - 1), F.slice("_met", F.lit(1), n - 1), lambda b, a: F.least(b - a, F.lit(3))
    )
    covered = F.when(F.col("_again"), F.aggregate(steps, F.lit(3), lambda s, x: s + x)).otherwise(0)
    return d.select(
        *docs.columns, "n_words", "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def host_verdicts(measured: DataFrame, rules=RULES, limit=HOST_LIMIT) -> DataFrame:
    """A row per host: host, documents, a shrunk rate per rule, failed."""
    hosts = measured.groupBy("host").agg(
        F.count("*").alias("documents"), *[F.sum(F.expr(r).cast("long")).alias(f"n_{name}") for name, r in rules.items()]
    )
    hosts = materialise(hosts, "hosts")
    moments = [f(F.col(f"n_{name}") / F.col("documents")).alias(f"{k}_{name}") for name in rules for k, f in (("mean", F.avg), ("var", F.var_pop))]
    found = hosts.agg(*moments).first()
    rates, failed = [], F.lit(False)
    for name in rules:
        mean, var = found[f"mean_{name}"] or 0.0, found[f"var_{name}"] or 0.0
        prior = min(max(mean * (1 - mean) / var - 1 if var > 0 else PRIOR[1], PRIOR[0]), PRIOR[1])
        rate = (F.col(f"n_{name}") + mean * prior) / (F.col("documents") + prior)
        rates.append(rate.alias(f"rate_{name}"))
        failed = failed | (rate > limit)
    return hosts.select("host", "documents", *rates, failed.alias("failed"))


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", host: Column | str = "source",
                  rules=RULES, limit=HOST_LIMIT) -> DataFrame:
    """A row per row of ``docs``: doc_id, host, the measures, base_failed, host_failed, kept.

    Null text has no words and fails; a null host is a host of its own; repeated rows count
    each. Lines are parted by \\n; only lines with a word count. Empty in, empty out.
    """
    host = F.col(host) if isinstance(host, str) else host
    rows = docs.select(F.col(id_col).alias("doc_id"), host.cast("string").alias("host"), whole(text_col).alias("_text"))
    measured = materialise(text_measures(rows, F.col("_text")).drop("_text"), "measures")
    out = host_verdicts(measured, rules, limit).where("failed").select(F.col("host").alias("h"), "failed")
    base = F.expr(" OR ".join(f"({rules[b]})" for b in BASE if b in rules) or "false")
    joined = measured.join(out, F.col("host").eqNullSafe(F.col("h")), "left")
    return joined.select(
        *measured.columns, base.alias("base_failed"), F.col("failed").isNotNull().alias("host_failed"),
        (~base & F.col("failed").isNull()).alias("kept"),
    )
