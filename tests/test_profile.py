import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions.durations import clock_seconds, duration_text, log_timestamp
from ledgerleaf.plans import profile

START, FINISH = profile.START_CODE, profile.FINISH_CODE


@pytest.fixture(scope="module")
def inputs(spark):
    log = spark.createDataFrame(
        [
            (1, START, 352, "1/21/2023 3:03:32"),
            (2, START, 101, "01/21/2023 03:03:32"),
            (3, FINISH, 101, "1/21/2023 3:03:32"),
            (4, FINISH, 352, "1/21/2023 3:05:32"),
            (5, START, 7, "1/21/2023 4:00:00"),
            (6, START, 7, "1/21/2023 5:00:00"),
            (7, FINISH, 7, "1/21/2023 4:00:10"),
            (8, FINISH, 7, "1/21/2023 6:00:00"),
            (9, START, -2000000, "1/21/2023 3:00:00"),
            (10, START, 8, "1/21/2023 7:00:00"),
            (11, 1, 352, "not a time"),
        ],
        "Id int, No int, BatchId bigint, Timestamp string",
    ).where("Id < 11")
    batch = spark.createDataFrame(
        [(352, "All"), (101, "Set date"), (7, "Twice"), (8, "Open"), (9, "Never")],
        "Id bigint, Name string",
    )
    steps = spark.createDataFrame(
        [
            (352, 2, 1, "second", "00:01:00"),
            (352, 1, 0, "first", "0:00:30"),
            (352, 3, 3, "run batch", "0:10:00"),
            (352, 4, None, "no action", "0:00:01"),
            (352, 20, 2, None, "0:05:00"),
            (101, 1, 7, "unknown action", None),
            (8, 1, 4, "q", "0:00:05"),
            (9, 1, 4, "never", "0:00:05"),
        ],
        "Id bigint, Reference int, Act int, ArgumentNameTmp string, Time string",
    )
    return log, batch, steps


def _at(clock):
    return datetime.fromisoformat(f"2023-01-21 {clock}")


def test_events(spark, inputs):
    events = profile.batch_profile(*inputs)
    rows = {}
    for r in events.collect():
        rows.setdefault((r.batch_id, r.step_ref), []).append(r)
    simple = {
        key: (r[0].event_name, r[0].event_start, r[0].event_finish, r[0].duration_in_seconds)
        for key, r in rows.items()
    }
    assert simple == {
        (352, None): ("All", _at("03:03:32"), _at("03:05:32"), 120),
        (101, None): ("Set date", _at("03:03:32"), _at("03:03:32"), 0),
        (7, None): ("Twice", _at("04:00:00"), _at("04:00:10"), 10),
        (8, None): ("Open", _at("07:00:00"), None, None),
        (352, 1): ("Initialize: first", _at("03:03:32"), _at("03:04:02"), 30),
        (352, 2): ("Load: second", _at("03:04:02"), _at("03:05:02"), 60),
        (352, 4): ("Unknown", _at("03:05:02"), _at("03:05:02"), 0),
        (352, 20): ("Map: ", _at("03:05:02"), _at("03:05:32"), 30),
        (101, 1): ("Unknown", _at("03:03:31"), _at("03:03:31"), 0),
        (8, 1): ("Run query: q", _at("07:00:00"), None, None),
    }
    assert len(rows[7, None]) == 2
    assert rows[352, 20][0].event_id == pytest.approx(352.2)
    starts = [r.event_start for r in events.collect()]
    assert starts == sorted(starts)


def test_started_batches(inputs):
    log, batch, _ = inputs
    log = profile.clean_log(log)
    assert {r.Id for r in profile.started_batches(batch, log).collect()} == {352, 101, 7, 8}
    starts = profile.batch_starts(batch, log).where("Id = 7").collect()
    assert [r.start_time for r in sorted(starts, key=lambda r: r.start_time)] == [
        _at("04:00:00"),
        _at("05:00:00"),
    ]


def test_macros(inputs):
    _, batch, steps = inputs
    flags = {r.Id: r.is_macro for r in profile.flag_macros(batch, steps).collect()}
    assert flags == {352: True, 101: True, 7: False, 8: True, 9: True}


def test_trace(inputs, tmp_path):
    trace = profile.to_trace(profile.batch_profile(*inputs), pid=3)
    rows = {r.name: r for r in trace.collect()}
    assert (rows["All"].ts, rows["All"].dur) == (1_000_000, 120_000_000)
    assert rows["Set date"].dur == 1 and rows["Set date"].pid == 3
    assert min(r.ts for r in trace.collect()) == 0
    profile.write_trace(trace, str(tmp_path / "trace"))
    lines = [
        json.loads(line)
        for part in sorted((tmp_path / "trace").glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    assert len(lines) == trace.count()
    assert [x["ts"] for x in lines] == sorted(x["ts"] for x in lines)
    assert list(lines[0])[:5] == ["pid", "tid", "ph", "name", "ts"]


def test_events_as_csv(spark, inputs, tmp_path):
    profile.write_events(profile.batch_profile(*inputs), str(tmp_path / "events"))
    back = spark.read.csv(str(tmp_path / "events"), header=True)
    durations = {r.event_name: r.duration for r in back.collect()}
    assert durations["All"] == "0 days 00:02:00"


def test_clock_and_log_times(spark):
    df = spark.createDataFrame([("1:02:03", "1/2/2022 3:04:05"), (None, "01/02/2022 03:04:05")], "a string, b string")
    rows = df.select(clock_seconds(F.col("a")).alias("s"), log_timestamp(F.col("b")).alias("t")).collect()
    assert [r.s for r in rows] == [3723, None]
    assert rows[0].t == rows[1].t == datetime(2022, 1, 2, 3, 4, 5)
    text = spark.createDataFrame([(90061.0,)], "s double").select(duration_text(F.col("s"))).first()[0]
    assert text == "1 days 01:01:01"


def test_clock_texts_with_fractions_and_days(spark):
    texts = ["00:00:01.5", "1:02:03", "2 days 3:04:05", "1 day 00:00:00.999", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r.s for r in df.select("i", clock_seconds(F.col("t")).alias("s")).orderBy("i").collect()]
    assert found == [1, 3723, 2 * 86400 + 11045, 86400, None]
    back = df.select(clock_seconds(duration_text(F.lit(200000))).alias("s")).first()
    assert back.s == 200000
