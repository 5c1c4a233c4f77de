"""Streams with state: months that close, events that cost their own size, runs held until complete, batches that run twice."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terrane.streaming import jobs as T


def files(spark, rows, schema, folder: Path, each: int):
    """Each batch of rows as a file of its own, read one file a batch, in order of time."""
    for k in range(0, len(rows), each):
        spark.createDataFrame(rows[k : k + each], schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(stream, folder: Path, mode: str):
    """Runs a stream to its end; each batch is written under its number."""
    write = lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")
    with T.keyed_state(stream.sparkSession):
        query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    return query, stream.sparkSession.read.parquet(f"{folder}/out")


@pytest.fixture(scope="module")
def requests():
    start = datetime(2023, 9, 1)
    months = [[(f"k{k}", start + timedelta(days=30.5 * m + 20 * (k % 2) / 2), 10 * m + k) for k in range(50)] for m in range(8)]
    return [r for rows in months for r in rows] + [(None, start, 5)]


def test_months_close(spark, requests, tmp_path):
    schema = "api_key string, ts timestamp, bytes long"
    query, out = drain(T.usage_stream(files(spark, requests, schema, tmp_path / "in", 50)), tmp_path, "update")
    last = out.groupBy("api_key", "month").agg(F.max_by(F.struct("bytes", "requests"), "batch").alias("r")).select("api_key", "month", "r.*")
    want = T.usage_stream(spark.createDataFrame(requests, schema))
    assert {tuple(r) for r in last.collect()} == {tuple(r) for r in want.collect()}
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert state[-1]["numRowsTotal"] <= 3 * 50 < 8 * 50
    assert sum(s["numRowsRemoved"] for s in state) >= 5 * 50


def test_closed_months_come_once(spark, requests, tmp_path):
    schema = "api_key string, ts timestamp, bytes long"
    _, out = drain(T.usage_stream(files(spark, requests, schema, tmp_path / "in", 50)), tmp_path, "append")
    got = [tuple(r) for r in out.drop("batch").collect()]
    want = {tuple(r) for r in T.usage_stream(spark.createDataFrame(requests, schema)).collect()}
    assert len(got) == len(set(got)) and set(got) < want
    assert {r[1] for r in want - set(got)} == set(sorted({r[1] for r in want})[-2:])


def test_requests_late_by_a_month_count(spark, tmp_path):
    rows = [("k", datetime(2024, 1, 31, 23), 1), ("k", datetime(2024, 2, 1), 10), ("k", datetime(2024, 1, 31, 22), 100), ("k", datetime(2024, 2, 28), 1000)]
    _, out = drain(T.usage_stream(files(spark, rows, "api_key string, ts timestamp, bytes long", tmp_path / "in", 1)), tmp_path, "update")
    assert {r["month"]: r["b"] for r in out.groupBy("month").agg(F.max("bytes").alias("b")).collect()} == {"2024-01": 101, "2024-02": 1010}


@pytest.fixture(scope="module")
def events():
    rng = random.Random(3)
    rows = [(rng.choice("aab") + str(rng.randint(0, 3)), f"2024-0{rng.randint(1, 9)}", k, rng.choice(["proposed", "designated", "retired"])) for k in range(240)]
    return rows + rows[:40] + [("hot", "2024-01", k, "x") for k in range(100)]


EVENT = "key string, date string, seq long, value string"


def test_status_log(spark, events, tmp_path):
    query, log = drain(T.status_stream(files(spark, events, EVENT, tmp_path / "in", 60)), tmp_path, "append")
    want = {tuple(map(str, r)) for r in T.status_now(spark.createDataFrame(events, EVENT)).collect()}
    assert {tuple(map(str, r)) for r in T.status_now(log).collect()} == want
    now = log.groupBy("key").agg(F.max_by(F.struct("latest_date", "latest_value", "events"), "events").alias("r")).select("key", "r.*")
    assert {tuple(map(str, r)) for r in now.collect()} == {(k, d, v, n) for k, d, v, _, n in want}
    assert log.count() == len(set(events))
    changed = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert max(changed) <= 3 * 60  # an event, the latest of its key; never what the key has gone through before


def test_status_log_goes_on_from_its_checkpoint(spark, events, tmp_path):
    stream = files(spark, events[:150], EVENT, tmp_path / "in", 150)
    drain(T.status_stream(stream), tmp_path, "append")
    stream = files(spark, events[100:], EVENT, tmp_path / "in", 400)
    _, log = drain(T.status_stream(stream), tmp_path, "append")
    want = {tuple(map(str, r)) for r in T.status_now(spark.createDataFrame(events, EVENT)).collect()}
    assert log.count() == len(set(events))
    assert {tuple(map(str, r)) for r in T.status_now(log).collect()} == want


PROBE = "slug string, source_no long, last_edit string, n long, checksum string, etag string"
OLD = [("same", 1, "d", 5, None, None), ("same", 2, None, 5, "c", None), ("edit", 1, "d", 5, None, None), ("edit", 2, "d", 5, None, None), ("gone", 1, "d", 5, None, None), ("gone", 2, "d", 5, None, None), ("bad", 1, "d", 5, None, None), ("bad", 2, "d", 5, None, None), ("short", 1, "d", 5, None, None), ("unseen", 1, "d", 5, None, None)]
NEW = [
    ("same", 1, "d", 5, None, None, None, 2), ("edit", 1, "d", 5, None, None, None, 3), ("gone", 1, "d", 5, None, None, None, 1), ("bad", 1, "e", 5, None, None, None, 2),
    ("edit", 2, "e", 5, None, None, None, 3), ("same", 2, None, 5, "c", None, None, 2), ("short", 1, "e", 5, None, None, None, 2), ("new", 7, "d", 1, None, None, None, 1),
    ("bad", 2, None, None, None, None, "timeout", 2), ("edit", 3, "d", 5, None, None, None, 3),
]
CHANGES = {("edit", 2, "last edit"), ("gone", 2, "source gone"), ("bad", 2, "failed: timeout"), ("new", 7, "new source")}


def changes(spark, folder, each, **options):
    stream = files(spark, NEW, f"{PROBE}, error string, sources long", folder / "in", each)
    T.change_stream(stream, spark.createDataFrame(OLD, PROBE), f"{folder}/out", f"{folder}/state", once=True, **options).awaitTermination()
    return [(r["slug"], r["source_no"], r["reason"]) for r in spark.read.parquet(f"{folder}/out").collect()]


@pytest.mark.parametrize("each", [3, 100])
def test_split_runs_wait_for_their_sources(spark, tmp_path, each):
    got = changes(spark, tmp_path, each)
    assert len(got) == len(CHANGES) and set(got) == CHANGES


def test_replayed_batches_add_nothing(spark, tmp_path):
    changes(spark, tmp_path, 4)
    done = sorted((tmp_path / "state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (done[-1], done[-1].with_name(f".{done[-1].name}.crc")):
        path.unlink(missing_ok=True)  # as if the driver was lost before the last batch was told as done
    stream = spark.readStream.schema(f"{PROBE}, error string, sources long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    T.change_stream(stream, spark.createDataFrame(OLD, PROBE), f"{tmp_path}/out", f"{tmp_path}/state", once=True).awaitTermination()
    got = [(r["slug"], r["source_no"], r["reason"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(got) == len(CHANGES) and set(got) == CHANGES


def test_incomplete_runs_are_told_after_their_wait(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(*r, start + timedelta(minutes=k)) for k, r in enumerate(NEW)] + [("other", 1, "d", 1, None, None, None, 1, start + timedelta(hours=k)) for k in (2, 3)]
    stream = files(spark, rows, f"{PROBE}, error string, sources long, at timestamp", tmp_path / "in", len(NEW))
    T.change_stream(stream, spark.createDataFrame(OLD, PROBE), f"{tmp_path}/out", f"{tmp_path}/state", once=True, at="at").awaitTermination()
    got = {(r["slug"], r["source_no"], r["reason"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == CHANGES | {("short", 1, "incomplete"), ("other", 1, "new source")}


def test_the_session_is_left_as_it_was(spark):
    before = spark.conf.get(T._PROVIDER)
    with T.keyed_state(spark):
        assert spark.conf.get(T._PROVIDER) == T._ROCKS
    assert spark.conf.get(T._PROVIDER) == before
