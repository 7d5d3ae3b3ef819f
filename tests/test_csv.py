import pytest

import sievelog as sl
from sievelog import streaming
from sievelog.sources.csv_logs import ingest_csv
from sievelog.sources.tables import open_rejects

LINES = [
    "LogID,Timestamp,Level,Service,Message",
    "",
    "   ",
    "1,2024-01-01 00:00:00,INFO,API,plain message",
    '2,2024-01-01 00:00:01,WARN,Auth,"quoted, with comma"',
    '3,2024-01-01 00:00:02,ERROR,Database,"say ""hi"" now"',
    "4,2024-01-01 00:00:03,ERROR,API",
    "5,2024-01-01 00:00:04,error,API,msg,extra,cols",
    "x6,2024-01-01 00:00:05,INFO,API,bad id",
    "7,not-a-time,INFO,API,bad time",
    " 8 , 2024-01-01 00:00:07 , INFO , API ,  padded  ",
    "9,2024-02-30 00:00:00,INFO,API,smart date",
    '10,2024-01-01 00:00:09,INFO,"API",quoted service',
    '11,2024-01-01 00:00:10,INFO,API,"unbalanced, quote',
    "12.5,2024-01-01 00:00:11,INFO,API,fraction",
    "13,2024-01-01 00:00:12,INFO,API,",
    "14,2024-01-01 00:00:13,INFO,API,,extra",
    '+16,2024-01-01 00:00:15,INFO,API,he said "a, b" twice',
    '17,2024-01-01 00:00:16,INFO,API,"a, ""b""",more',
    '18,2024-01-01 00:00:17,INFO,API,"  inner blanks "',
    '19,2024-01-01 00:00:18,"API, INFO"',
]
NO_HEADER = ["15,2024-01-01 00:00:14,INFO,API,timestamp drift", "LogID,Timestamp,Level,Service,Message"]

MESSAGES = {
    1: "plain message",
    2: "quoted, with comma",
    3: 'say "hi" now',
    5: "msg",
    7: "bad time",
    8: "padded",
    9: "smart date",
    10: "quoted service",
    11: "unbalanced, quote",
    13: "",
    14: "",
    15: "timestamp drift",
    16: 'he said "a, b" twice',
    17: 'a, "b"',
    18: "  inner blanks ",
}
REJECTS = [
    ("12.5,2024-01-01 00:00:11,INFO,API,fraction", "bad_id"),
    ('19,2024-01-01 00:00:18,"API, INFO"', "too_few_columns"),
    ("4,2024-01-01 00:00:03,ERROR,API", "too_few_columns"),
    ("x6,2024-01-01 00:00:05,INFO,API,bad id", "bad_id"),
]


@pytest.fixture(scope="module")
def csv_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv")
    (path / "a.csv").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (path / "b.csv").write_text("\n".join(NO_HEADER) + "\n", encoding="utf-8")
    return str(path)


def check_rows(rows):
    got = {r.log_id: r for r in rows}
    assert {i: r.message for i, r in got.items()} == MESSAGES
    assert len(rows) == len(MESSAGES)
    assert (got[7].epoch_ms, got[7].ts_valid) == (0, False)
    assert (got[9].epoch_ms, got[9].ts_valid) == (0, False)
    assert (got[8].timestamp, got[8].level, got[8].service) == ("2024-01-01 00:00:07", "INFO", "API")
    assert (got[5].level, got[10].service) == ("error", "API")
    assert got[2].epoch_ms == 1_704_067_201_000 and got[2].ts_valid


def test_rows_and_rejects(spark, csv_dir):
    logs, rejects = sl.read_logs_csv(spark, csv_dir)
    check_rows(logs.collect())
    got = sorted((r.raw, r.reason) for r in rejects.collect())
    assert got == sorted(REJECTS)
    assert all(r.file.endswith("a.csv") for r in rejects.collect())
    # A narrow use of the rows must not change which rows there are.
    assert logs.count() == len(MESSAGES) and rejects.count() == len(REJECTS)
    assert logs.select("level").count() == len(MESSAGES)
    assert rejects.groupBy("reason").count().count() == 2


def test_bad_timestamps_can_be_rejected(spark, csv_dir):
    logs, rejects = sl.read_logs_csv(spark, csv_dir, on_bad_ts="reject")
    assert logs.count() == len(MESSAGES) - 2
    assert rejects.where("reason = 'bad_timestamp'").count() == 2
    with pytest.raises(ValueError):
        sl.read_logs_csv(spark, csv_dir, on_bad_ts="drop")


def test_missing_path_raises(spark):
    with pytest.raises(Exception):
        sl.read_logs_csv(spark, "/no/such/folder")


def test_ingest_is_one_pass_and_repeatable(spark, csv_dir, tmp_path):
    table = str(tmp_path / "table")
    for _ in range(2):
        seen = ingest_csv(spark, csv_dir, table, batch_id=3)
        assert seen == {"accepted": len(MESSAGES), "rejected": len(REJECTS), "bad_timestamps": 2}
    check_rows(sl.open_logs(spark, table).collect())
    assert {r.batch_id for r in sl.open_logs(spark, table).collect()} == {3}
    assert sorted((r.raw, r.reason) for r in open_rejects(spark, table).collect()) == sorted(REJECTS)


def test_roundtrip(spark, messy, tmp_path):
    logs = messy.where("NOT contains(coalesce(message, ''), '\n')")
    sl.write_csv(logs, str(tmp_path / "out"))
    back, rejects = sl.read_logs_csv(spark, str(tmp_path / "out"))
    assert rejects.count() == 0
    text = lambda df: sorted(
        (r.log_id, r.epoch_ms, (r.level or "").strip(), r.service or "", (r.message or ""))
        for r in df.collect()
    )
    assert text(back) == text(logs)


def test_a_line_of_many_quotes(spark, tmp_path):
    line = "1,2024-01-01 00:00:00,INFO,API," + '"a"' * 20_000 + ",more,fields"
    (tmp_path / "q.csv").write_text(line + "\n")
    logs, rejects = sl.read_logs_csv(spark, str(tmp_path / "q.csv"))
    assert logs.count() + rejects.count() == 1


def test_streaming_ingest(spark, csv_dir, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    parsed = streaming.stream_logs_csv(spark, csv_dir, max_files=1)
    streaming.start_ingest(parsed, table, state, availableNow=True).awaitTermination()
    check_rows(sl.open_logs(spark, table).collect())
    assert sl.open_rejects(spark, table).count() == len(REJECTS)
    assert sl.open_logs(spark, table).select("batch_id").distinct().count() == 2
    # Nothing new: a restart adds nothing.
    parsed = streaming.stream_logs_csv(spark, csv_dir, max_files=1)
    streaming.start_ingest(parsed, table, state, availableNow=True).awaitTermination()
    check_rows(sl.open_logs(spark, table).collect())


def test_streaming_ingest_with_defaults(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("500,2024-01-01 00:00:00,warn,,first\n,,,,second timestamp\nx,,,,bad\n")
    (source / "b.csv").write_text(",2024-01-01 00:00:05,, Auth ,third\n")
    table = str(tmp_path / "table")
    parsed = streaming.stream_logs_csv(spark, str(source), defaults=True, max_files=1)
    streaming.start_ingest(
        parsed, table, str(tmp_path / "state"), assign_ids=True, availableNow=True
    ).awaitTermination()
    rows = {r.message: r for r in sl.open_logs(spark, table).collect()}
    assert set(rows) == {"first", "second timestamp", "third"}
    assert (rows["first"].log_id, rows["first"].level, rows["first"].service) == (500, "WARN", "API")
    assert rows["second timestamp"].ts_valid and rows["second timestamp"].level == "INFO"
    assert rows["third"].service == "Auth"
    assert len({r.log_id for r in rows.values()}) == 3
    assert sl.open_rejects(spark, table).first().reason == "bad_id"
