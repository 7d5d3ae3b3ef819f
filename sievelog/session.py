"""Session settings every job relies on, and the shared folder for intermediate tables."""

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone; timestamps are parsed and printed in it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session on one machine may go without that setting and then uses its warehouse
    folder; a cluster must name a folder that all executors can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes, at its end, the intermediate tables that were written inside it.

    Results are lazy: write or collect what you need before the scope ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in _scopes.pop():
            at = hadoop(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/sievelog/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Lost executors then re-read files instead of recomputing the lineage, and the
    planner knows the true size, so its broadcast threshold is a real check.
    """
    return measured(df, name)[0]


def measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`materialise`, with aggregates of the rows taken while they are written."""
    path = scratch_path(df.sparkSession, name)
    seen = Observation(name)
    if metrics:
        df = df.observe(seen, *[m.alias(k) for k, m in metrics.items()])
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored, seen.get if metrics else {}
