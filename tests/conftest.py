import os
import random
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sievelog as sl  # noqa: E402
from sievelog.sources.csv_logs import with_times  # noqa: E402

BASE_MS = 1_704_067_200_000


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    path = sl.scratch_path(spark, "sample")
    sl.sample_logs(spark, 1000, BASE_MS).write.parquet(path)
    return spark.read.parquet(path)


def make_logs(spark, rows):
    """Logs from (log_id, timestamp, level, service, message)."""
    schema = "log_id BIGINT, timestamp STRING, level STRING, service STRING, message STRING"
    return with_times(spark.createDataFrame(rows, schema)).select(*sl.LOG_SCHEMA.names)


def at(second: int) -> str:
    return f"2024-01-0{1 + second // 86400} {second // 3600 % 24:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


@pytest.fixture(scope="session")
def messy(spark):
    """Seeded rows with repeated ids, times and rows, mixed case, odd text and nulls."""
    rng = random.Random(7)
    words = ["Error", "conn", "connection", "auth-service", "x_1", "Über", "straße", "a*b", "50%", "t", "ton", "é"]
    rows = []
    for _ in range(400):
        message = rng.choice(["", " ", ", ", "\n"]).join(rng.choices(words, k=rng.randint(0, 6)))
        rows.append(
            (
                rng.randint(1, 150),
                rng.choice([at(rng.randint(0, 3 * 86400)), at(30), "bad", None]),
                rng.choice(["ERROR", "error", " Warn ", "INFO", "", None]),
                rng.choice(["API", "auth-service", "Auth", "my svc", "", None]),
                rng.choice([message, message, message, None]),
            )
        )
    rows += rows[:40]
    path = sl.scratch_path(spark, "messy")
    make_logs(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


def as_multiset(df):
    from collections import Counter

    return Counter(map(tuple, df.collect()))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def matches_by_definition(logs, test):
    """Rows for which some token passes ``test``, a function of a token column."""
    tokens = sl.log_tokens(F.col("service"), F.col("level"), F.col("message"))
    return logs.where(F.exists(tokens, test))
