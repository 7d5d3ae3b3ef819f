import pytest
from pyspark.sql import functions as F

import sievelog as sl
from sievelog.functions.timestamps import bound_ms, resolve_bounds


def one(spark, column, **values):
    row = [tuple(values.values())]
    df = spark.createDataFrame(row, ", ".join(f"{k} STRING" for k in values))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, epoch",
    [
        ("2024-01-01 00:00:00", 1_704_067_200_000),
        ("\t 2024-01-01 00:00:01 \n", 1_704_067_201_000),
        ("1970-01-01 00:00:00", 0),
        ("2024-02-30 00:00:00", 0),
        ("2024-01-01", 0),
        ("2024-01-01 00:00:00.5", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_parse_epoch(spark, text, epoch):
    assert one(spark, sl.parse_epoch(F.col("t")), t=text) == epoch


def test_parse_and_format_in_another_zone(spark):
    assert one(spark, sl.parse_epoch(F.col("t"), "Asia/Tokyo"), t="2024-01-01 09:00:00") == 1_704_067_200_000
    got = one(spark, sl.format_epoch(F.lit(1_704_067_200_999), "Asia/Tokyo"), t="")
    assert got == "2024-01-01 09:00:00"


@pytest.mark.parametrize(
    "service, level, message, tokens",
    [
        ("auth-service", " Warn ", "Über-Straße x_1 ", {"auth-service", "warn", "ber", "stra", "e", "x_1"}),
        (None, None, None, set()),
        ("", "", "", set()),
        (" my svc\t", "INFO", "a a  A", {"my svc", "info", "a"}),
    ],
)
def test_tokens(spark, service, level, message, tokens):
    col = sl.log_tokens(F.col("s"), F.col("l"), F.col("m"))
    got = one(spark, col, s=service, l=level, m=message)
    assert sorted(got) == sorted(tokens)


@pytest.mark.parametrize(
    "message, expected",
    [
        ("a - b", "a  b"),
        ("user_id 0xFF <x>", "userid <*> x"),
        ("", ""),
        (None, ""),
        ("  lead\ttrail \n", "lead trail"),
        ("abc1 1abc a1b 12 --", "<*> <*> <*> <*>"),
        ("a.1,b2;c", "<*>"),
        ("héllo wörld9", "hllo <*>"),
    ],
)
def test_template(spark, message, expected):
    assert one(spark, sl.template(F.col("m")), m=message) == expected


def test_template_of_a_long_word(spark):
    word = "x" * 200_000
    assert one(spark, sl.template(F.col("m")), m=word + " 1") == word + " <*>"


@pytest.mark.parametrize(
    "log_id, shard",
    [
        (0, 0),
        (5, 2),
        (100001, 2),
        (-1, 0),
        (-2, 1),
        (2**31, 1),
        (2**32, 1),
        (2**40 + 7, 2),
        (-(2**63), 1),
        (2**63 - 1, 1),
    ],
)
def test_shard_id(spark, log_id, shard):
    assert spark.range(1).select(sl.shard_id(F.lit(log_id).cast("bigint"), 3)).first()[0] == shard


def test_log_date_covers_all_times(spark):
    times = [0, -1, 86_400_000, 2**62, -(2**62)]
    df = spark.createDataFrame([(t,) for t in times], "t BIGINT").select(sl.log_date(F.col("t")).cast("string"))
    assert [r[0] for r in df.collect()] == ["1970-01-01", "1969-12-31", "1970-01-02", "9999-12-31", "0001-01-01"]


def test_bounds():
    assert bound_ms(" 12 ") == 12
    assert bound_ms("2024-01-01 00:00:00") == 1_704_067_200_000
    assert bound_ms("1970-01-01 00:00:00") is None
    assert bound_ms("yesterday") is None
    assert bound_ms("2024-02-30 00:00:00") is None
    assert bound_ms("99999999999999999999") is None
    assert resolve_bounds("20", "10") == (10, 20)
    assert resolve_bounds("", "nonsense", 3, 9) == (3, 9)
    assert resolve_bounds("", "5") == (None, 5)
