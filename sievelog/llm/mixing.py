"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source is a queue of its documents in a fixed random order. A copy of a document ends
its service at the virtual time (words of its source up to its end) / (target of its
source); all sources advance alike, so the copies in order of virtual time are the mix,
and it ends where the total budget is spent. Documents may come again, up to ``cap`` times
their source.

A source is never one task: its order is cut into ranges of the random number, whose sums
give each range its start. The end of the mix is found from sums over cells of virtual
time, which all hold about as many words, and from the rows of the one cell it falls into.
"""

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievelog.llm.common import materialise, packed, unpacked, whole, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2
#: Rows of a range or cell, on average; cells of virtual time are never more than 65,536 per unit.
RANGE_ROWS = 2_000
MOST_CELLS = 65_536
_HEX = 15


def shuffle_key(doc_id: str, text: str) -> Column:
    """A number below 16 ** 15, random over rows but the same in every run."""
    seed = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), whole(text))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, _HEX), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn and share ``share``
    of all words; a target stops at ``cap`` times its source and the rest is shared anew
    by weight. In order of cap to weight the full sources come first, so running sums
    tell which are full.
    """
    every = Window.partitionBy()  # a row per source
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    t = sizes.withColumn("nth", F.row_number().over(order) - 1).withColumn("weight", weight)
    t = t.withColumn("most", F.col("source_size").cast("double") * cap)
    before = Window.orderBy(F.col("most") / F.col("weight"), F.col("nth")).rowsBetween(Window.unboundedPreceding, -1)
    room = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    shares = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = t.withColumn("full", F.col("most") * shares <= room * F.col("weight"))
    rest = F.sum("source_size").over(every) * F.lit(float(share)) - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(every)
    parts = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * rest / F.nullif(parts, F.lit(0.0)))
    return t.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
                weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """A row per row of ``docs``: doc_id, source, shuffle, size, source_size, target, first_finish, copies, taken.

    ``first_finish`` is the virtual time of the first copy, ``copies`` how often the mix
    takes the document. Null text has size 0, a null source is a source of its own. Rows
    that repeat id and text stand at the same place and are taken alike. Documents
    without words and sources without words are never taken. Empty in, empty out.
    """
    sized = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            shuffle_key(id_col, text_col).alias("shuffle"), word_count(text_col).alias("size"),
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sizes = materialise(sizes, "mix-sources")
    n, words = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    targets = materialise(source_targets(sizes.drop("rows"), weights, share, cap), "mix-targets")
    ranges = max(1, ceil(n / RANGE_ROWS))
    ranged = sized.withColumn("range", F.floor(F.col("shuffle") / (16.0**_HEX) * ranges))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
        .withColumn("start", F.coalesce(F.sum("words").over(along), F.lit(0)))
        .drop("words").join(_named(targets, "t"), F.col("source").eqNullSafe(F.col("t_source")))
        .select(F.col("source").alias("s_source"), F.col("range").alias("s_range"), "start", "t_source_size", "t_target")
    )
    within = Window.partitionBy("source", "range").orderBy("shuffle", "doc_id").rangeBetween(Window.unboundedPreceding, 0)
    queued = ranged.withColumn("done", F.sum("size").over(within)).join(
        starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range"))
    )
    target = F.nullif(F.col("t_target"), F.lit(0.0))
    queued = materialise(
        queued.select(
            "doc_id", "source", "shuffle", "size", F.col("t_source_size").alias("source_size"),
            F.coalesce("t_target", F.lit(0.0)).alias("target"),
            *[((F.col("start") + F.col("done") + k * F.col("t_source_size")) / target).alias(f"finish_{k}") for k in range(cap)],
        ),
        "mix-queues",
    )
    last = _last_taken(queued, cap, words * share, max(1, min(MOST_CELLS, ceil(n * cap / RANGE_ROWS))))
    copies = F.lit(0)
    if last is not None:
        for k in range(cap):
            here = F.struct(F.col(f"finish_{k}").alias("finish"), "shuffle", F.col("doc_id").alias("doc_id"), F.lit(k).alias("copy"))
            copies = copies + F.when((F.col("size") > 0) & (here <= last), 1).otherwise(0)
    return queued.withColumn("copies", copies).select(
        "doc_id", "source", "shuffle", "size", "source_size", "target", F.col("finish_0").alias("first_finish"),
        "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def _last_taken(queued: DataFrame, cap: int, budget: float, cells: int) -> Column | None:
    """The place of the last copy within the budget, in the order of the mix."""
    copies = queued.where(F.col("size") > 0).select(
        "shuffle", "doc_id", "size",
        F.explode(F.array(*[F.struct(F.col(f"finish_{k}").alias("finish"), F.lit(k).alias("copy")) for k in range(cap)])).alias("c"),
    ).select("shuffle", "doc_id", "size", "c.finish", "c.copy")
    copies = copies.withColumn("cell", F.floor(F.least(F.col("finish"), F.lit(4.0)) * cells))
    upto = Window.orderBy("cell")  # at most 4 * cells + 1 rows, whatever the input
    sums = copies.groupBy("cell").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    edge = materialise(sums, "mix-cells")
    cut = edge.where(F.col("upto") > budget).orderBy("cell").first() or edge.orderBy(F.desc("cell")).first()
    if cut is None:
        return None
    place = Window.orderBy("finish", "shuffle", "doc_id", "copy").rangeBetween(Window.unboundedPreceding, 0)
    near = copies.where(F.col("cell").between(cut["cell"] - 1, cut["cell"]))  # two cells, so that one copy at least fits
    before = edge.where(F.col("cell") < cut["cell"] - 1).agg(F.coalesce(F.max("upto"), F.lit(0))).first()[0]
    taken = near.withColumn("sum", F.sum("size").over(place) + before).where(F.col("sum") <= budget)
    last = taken.agg(F.max(F.struct("finish", "shuffle", "doc_id", "copy")).alias("m")).select("m.*").first()
    if last["finish"] is None:  # the copies of both cells are too long: all before them are taken
        last = {"finish": float((cut["cell"] - 1) / cells), "shuffle": -1, "doc_id": None, "copy": -1}
    kind = dict(queued.dtypes)["doc_id"]
    return F.struct(
        F.lit(last["finish"]).alias("finish"), F.lit(last["shuffle"]).cast("long").alias("shuffle"),
        F.lit(last["doc_id"]).cast(kind).alias("doc_id"), F.lit(last["copy"]).alias("copy"),
    )


def mixed_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **how) -> DataFrame:
    """The mix itself: rows of ``docs``, once per copy, range-sorted by virtual time."""
    plan = mix_sources(docs, id_col, text_col, source_col, **how).where("copies > 0")
    plan = plan.select(F.col("doc_id").alias("p_id"), F.col("shuffle").alias("p_shuffle"), "first_finish", "source_size", "target", "copies")
    rows = docs.select(
        packed(docs), F.col(id_col).alias("id"), shuffle_key(id_col, text_col).alias("at")
    )
    taken = rows.join(plan.dropDuplicates(["p_id", "p_shuffle"]), (F.col("at") == F.col("p_shuffle")) & F.col("id").eqNullSafe(F.col("p_id")))
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    taken = taken.select("row", "at", "first_finish", (F.col("source_size") / F.col("target")).alias("round"), copy)
    ordered = taken.orderBy(F.col("first_finish") + F.col("copy") * F.col("round"), "at")
    return ordered.select(*unpacked(docs))
