"""Streaming intake against the batch result."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from postmill.operators.duplicates import keep_first
from postmill.streaming.intake import joined, run_intake

SCHEMA = "company string, title string, no bigint, at timestamp, pay double"
START = datetime(2026, 3, 1)


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"company": c, "title": t, "no": n, "at": at.isoformat(sep=" "), "pay": p}) for c, t, n, at, p in rows))


def posting(rng, n, minute):
    company = rng.choice(["hot", "hot", None, "b", "c"])
    return company, rng.choice(["x", "y", None]), n, START + timedelta(minutes=minute), rng.choice([None, 1.5])


def intake(spark, tmp_path, source="in"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / source))
    return run_intake(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), keys=["company", "title"], order=F.col("no"), event_time="at",
                      delay="10 minutes", horizon=timedelta(hours=3))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, tmp_path):
    rng = random.Random(1)
    rows = [posting(rng, n, n // 4) for n in range(400)]  # 100 minutes: one session a key
    write(tmp_path / "in", "a.json", rows[150:300])  # not the smallest numbers first, and within the delay
    first = intake(spark, tmp_path)
    write(tmp_path / "in", "b.json", [r for r in rows[300:]])
    late = [("hot", "x", -1, START - timedelta(hours=9), None), ("new", "x", -2, START - timedelta(hours=9), None)]
    write(tmp_path / "in", "c.json", late)
    second = intake(spark, tmp_path)
    write(tmp_path / "in", "d.json", [("end", "z", 10**6, START + timedelta(days=2), None)])
    intake(spark, tmp_path)
    write(tmp_path / "in", "e.json", [("end", "z", 10**6 + 1, START + timedelta(days=2, hours=1), None)])
    intake(spark, tmp_path)
    on_time = spark.createDataFrame(rows[150:], SCHEMA)
    assert rows_of(spark.read.schema(SCHEMA).parquet(str(tmp_path / "out"))) == rows_of(keep_first(on_time, ["company", "title"], ["no"]))
    assert first.read == 150 and (second.read, second.late) == (102, 2)


def test_a_key_that_comes_back_later_is_a_new_session(spark, tmp_path):
    day = timedelta(days=1)
    write(tmp_path / "in", "a.json", [("a", "x", 5, START, 1.0), ("a", "x", 4, START + timedelta(hours=2), 2.0), ("a", "x", 1, START + day, 3.0)])
    write(tmp_path / "in", "b.json", [("end", "z", 9, START + 9 * day, None)])
    intake(spark, tmp_path)
    assert [r.no for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).orderBy("no").collect()] == [1, 4]


def test_sessions_arriving_out_of_order_become_one(spark, tmp_path):
    hours = [0, 5, 4, 2, 10]  # 0-2-4-5 within three hours of each other, 10 apart
    write(tmp_path / "in", "a.json", [("a", "x", 50 - h, START + timedelta(hours=h), None) for h in hours[:2]])
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    take = lambda: run_intake(stream(), str(tmp_path / "out"), str(tmp_path / "checkpoint"), keys=["company"], order=F.col("no"),
                              event_time="at", delay="6 hours", horizon=timedelta(hours=3))
    take()
    write(tmp_path / "in", "b.json", [("a", "x", 50 - h, START + timedelta(hours=h), None) for h in hours[2:]])
    take()
    write(tmp_path / "in", "c.json", [("end", "z", 99, START + timedelta(days=9), None), (None, "no time", 1, START, None)])
    take()
    assert [r.no for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).orderBy("no").collect()] == [40, 45]


def test_joined_sessions():
    rng = random.Random(2)
    for _ in range(50):
        times = [rng.randint(0, 60) for _ in range(rng.randint(1, 12))]
        sessions = []
        for i, t in enumerate(times):
            sessions = joined(sessions, (t, t + 5, i, str(i)))
        expected, last = [], None
        for t, i in sorted((t, i) for i, t in enumerate(times)):
            if last is None or t > last + 5:
                expected.append([t, t + 5, i, str(i)])
            else:
                expected[-1][1:] = [t + 5, *min((expected[-1][2], expected[-1][3]), (i, str(i)))]
            last = t
        assert sorted(sessions) == [tuple(e) for e in expected]
