"""How document filters interact: what each removes in every order they may be applied in.

Each text is tested once, in its row, for the four conditions that one row decides. Equal
texts are found by an existential self-join: a left-semi join on hash, exact text and a
smaller id. The failures of all filters are united by row and become one bit set; only the
counts of bit sets per part meet the orders.

The self-join moves few texts. Its right side is cut to the smallest id of each text, which
copies reach through partial aggregation, and to hashes that more than one row has. Where
the grouping by hash and text, which compares bytes, finds a single text under a hash, hash
and id decide; texts are joined only under hashes that several texts share.
"""

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import WORD, materialise, whole

#: The filters by letter; a document fails where the condition holds. E stands for the copies.
FAILS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_chars",
    "D": "has_symbol",
}
COPIES = "E"
LETTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
SYMBOLS = "[#$%&*|]"


def _tested(docs: DataFrame, text_hash: Callable[[Column], Column]) -> DataFrame:
    """doc_id, part, text, hash and the bits of A to D of every row."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    d = docs.withColumn("_words", words).select(
        "doc_id", "part", "text",
        text_hash(F.col("text")).alias("hash"),
        F.size("_words").alias("n_words"),
        F.size(F.array_distinct("_words")).alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]++", "")).alias("n_capitals"),
        F.length("text").alias("n_chars"),
        F.col("text").rlike(SYMBOLS).alias("has_symbol"),
    )
    bits = sum((F.when(F.expr(c), BIT[f]).otherwise(0) for f, c in FAILS.items()), F.lit(0))
    return d.select("doc_id", "part", "text", "hash", bits.alias("bits"))


def _with_labels(rows: DataFrame, labels: DataFrame, label_id: str) -> DataFrame:
    """Adds good and toxic; an id with several labels counts as each of them."""
    known = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).cast("long").alias("l_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    joined = rows.join(known, F.col("doc_id") == F.col("l_id"), "left").drop("l_id")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def failures(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", part_col="source",
             text_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """A row per row of ``docs``: doc_id, part, good, toxic, bits (bit i for the i-th of ABCDE).

    E: a row of a smaller id has the identical text. Null text counts as empty, a null part
    as the empty string; a null id is smaller than none and has none smaller, and it has no
    label. Rows that repeat id and text do not fail each other. ``text_hash`` only finds
    candidates: whatever it gives, texts decide.
    """
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        whole(text_col).alias("text"),
    )
    tested = _tested(own, text_hash)
    # Numbered where they are stored, so that a number names one row from here on.
    rows = materialise(tested.drop("text").withColumn("row", F.monotonically_increasing_id()), "audit-rows")
    again = materialise(
        rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "audit-hashes"
    )
    keyed = own.withColumn("hash", text_hash(F.col("text")))
    first = keyed.join(again, "hash", "left_semi").groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"))
    hashes = materialise(
        first.groupBy("hash").agg(F.count("*").alias("texts"), F.min("first_id").alias("first_id")), "audit-firsts"
    )
    smaller = lambda left, right: right["first_id"] < left["doc_id"]
    alone, shared = hashes.where("texts = 1"), hashes.where("texts > 1").select("hash")
    marks = rows.join(alone, (rows["hash"] == alone["hash"]) & smaller(rows, alone), "left_semi")
    if not shared.isEmpty():
        # These rows are tested again with their texts at hand, and numbered below zero.
        crowd = materialise(
            tested.join(shared, "hash", "left_semi").withColumn("row", -1 - F.monotonically_increasing_id()), "audit-crowd"
        )
        least = crowd.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"))
        same = (crowd["hash"] == least["hash"]) & (crowd["text"] == least["text"])
        met = crowd.join(least, same & smaller(crowd, least), "left_semi").drop("text")
        rows = rows.join(shared, "hash", "left_anti").unionByName(crowd.drop("text"))
        marks = marks.unionByName(met)
    found = rows.unionByName(marks.withColumn("bits", F.lit(BIT[COPIES])))
    united = found.groupBy("row").agg(
        F.min("doc_id").alias("doc_id"), F.min("part").alias("part"), F.bit_or("bits").alias("bits")
    )
    return _with_labels(united.drop("row"), labels, id_col).select("doc_id", "part", "good", "toxic", "bits")


def audit(failed: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order of the filters and step, from rows of :func:`failures`.

    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley. A part has all orders and steps, zeros included; no rows give no parts. Bit sets
    are counted per part first, so an order costs nothing per document.
    """
    counts = materialise(failed.groupBy("part", "good", "toxic", "bits").agg(F.count("*").alias("n")), "audit-counts")
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))
    )

    upto = F.aggregate(
        F.sequence(F.lit(1), F.col("step")), F.lit(0), lambda seen, i: seen.bitwiseOR(_bit_at(letters, i))
    )
    here = _bit_at(letters, F.col("step"))
    steps = steps.withColumns({"_here": here, "_upto": upto})
    before = F.col("_upto").bitwiseXOR(F.col("_here"))
    fails = F.col("bits").bitwiseAND(F.col("_here")) != 0
    gone = F.col("bits").bitwiseAND(before) != 0
    removed = fails & ~gone
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0).cast("long")))
    # Of k failing filters each comes first in one k-th of the orders.
    n_orders = len(list(permutations(letters)))
    share = F.when(fails, F.col("n") * F.expr(f"{n_orders} div bit_count(bits)")).otherwise(F.lit(0).cast("long"))
    return steps.groupBy("part", "filter_order", "step").agg(
        total(F.col("bits").bitwiseAND(F.col("_upto")) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("_here")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        F.sum(share).alias("shapley"),
    )


def _bit_at(letters: str, step: Column) -> Column:
    """The bit of the filter that stands at a step of the order."""
    at = F.substr(F.col("filter_order"), step, F.lit(1))
    cases = F.lit(0)
    for i, letter in enumerate(letters):
        cases = F.when(at == letter, 1 << i).otherwise(cases)
    return cases


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """:func:`audit` of the :func:`failures` of ``docs``; see there for odd rows."""
    return audit(failures(docs, labels, **columns))
