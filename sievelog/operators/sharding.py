"""Shards: a deterministic placement of rows by id.

A shard is a column, and a table can be written with one folder per shard. Searching
shard by shard and merging by time equals searching the whole table, so the shard
search filters first and moves only the matches.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievelog.functions.keys import shard_id, stretch
from sievelog.operators.search import in_time_order, matching
from sievelog.schema import DEFAULT_SHARDS


def with_shard(logs: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    return logs.withColumn("shard", shard_id(F.col("log_id"), shards))


def write_sharded(logs: DataFrame, path: str, shards: int = DEFAULT_SHARDS) -> None:
    """One folder per shard; rebalancing gathers its rows and splits a large one by size."""
    rows = with_shard(logs, shards).withColumn("_stretch", stretch(1 << 20))
    rows.hint("rebalance", "shard", "_stretch").drop("_stretch").write.partitionBy("shard").parquet(path)


def scatter_gather(
    logs: DataFrame, shards: int = DEFAULT_SHARDS, only: list[int] | None = None, **filters
) -> DataFrame:
    """Matches of all shards (or of ``only`` some), each with its shard, ascending in time."""
    rows = logs if "shard" in logs.columns else with_shard(logs, shards)
    if only is not None:
        rows = rows.where(F.col("shard").isin(*only))
    return in_time_order(matching(rows, **filters))


def shard_load(logs: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Rows and share of all rows per shard, empty shards included."""
    counts = (
        logs.select(shard_id(F.col("log_id"), shards).alias("shard"))
        .groupBy("shard")
        .agg(F.count("*").alias("records"))
    )
    every = logs.sparkSession.range(shards).withColumnRenamed("id", "shard")
    load = every.join(counts, "shard", "left").select(
        "shard", F.coalesce("records", F.lit(0).cast("bigint")).alias("records")
    )
    # A total over as many rows as there are shards.
    total = F.sum("records").over(Window.partitionBy(F.lit(0)))
    return load.withColumn("pct", F.col("records") * 100.0 / F.greatest(total, F.lit(1)))
