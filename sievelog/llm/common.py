"""What the operators share: white space, tables read by folder, fold numbers, cut lineage."""

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelog.session import materialise, scratch_path  # noqa: F401

#: The ASCII white space of every operator here, and what stands between it.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: a batch of texts is held several times over, in the JVM and in Python.
ARROW_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to :data:`ARROW_ROWS`; fewer stay as they are.

    For chains of operators, whose Python workers keep what each of them needed most. Passage
    removal alone gathers by batch and does more work with small ones, so queries leave it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _show_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _show_package(spark: SparkSession) -> None:
    """On one machine, let Python workers import this package from where the driver did.

    On a cluster it is installed on the executors or given with ``--py-files``.
    """
    if spark.sparkContext.master.startswith("local["):
        root = str(Path(__file__).resolve().parents[2])
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (known, root) if p)


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def held_out(doc_id: Column) -> Column:
    """True for the documents no model may learn from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def word_count(text: str) -> Column:
    """Runs of other characters than ASCII white space."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def row_tasks(spark: SparkSession) -> int:
    """Partitions for a shuffle whose size the planner does not see."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, so that none clashes with a column of the operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def unpacked(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` from ``row``."""
    return [F.col(f"row.`{c}`").alias(c) for c in docs.columns]


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it new in ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
