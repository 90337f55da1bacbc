"""Incremental alert ingest: the look-back rule and repeated ids across micro-batches."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from tidemark.operators.keyed_load import read_table
from tidemark.session import scratch_path
from tidemark.streaming.alerts import ingest_alerts


def _line(ts: dt.datetime, log: str) -> str:
    text = ts.strftime("%Y-%m-%d %H:%M:%S")
    return json.dumps({"timestamp": text, "rule": {"id": 1, "level": 3, "description": "d"}, "full_log": log})


def test_old_and_repeated_alerts_are_dropped(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    src = scratch_path(spark, "sync").removeprefix("file:")
    os.makedirs(src)
    a = _line(now - dt.timedelta(hours=1), "a")
    syncs = (
        [a, _line(now - dt.timedelta(hours=2), "b")],
        [a, _line(now - dt.timedelta(hours=30), "old"), _line(now - dt.timedelta(minutes=10), "c")],
        [a],  # the same alert once more, in a later batch
    )
    for i, lines in enumerate(syncs):
        path = os.path.join(src, f"sync{i}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (time.time() + i, time.time() + i))
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    ingest_alerts(spark, src, out, ckpt, lookback_hours=24, max_files_per_trigger=1)
    assert sorted(r.full_log for r in read_table(spark, out).collect()) == ["a", "b", "c"]
    # a replay of the same input (new checkpoint) inserts nothing
    ingest_alerts(spark, src, out, scratch_path(spark, "ckpt2"), lookback_hours=24)
    assert read_table(spark, out).count() == 3


def test_alerts_without_a_time_are_kept(spark):
    from tidemark.streaming.alerts import daily_counts_stream

    src = scratch_path(spark, "sync_null").removeprefix("file:")
    os.makedirs(src)
    lines = [_line(dt.datetime(2024, 1, 1, 5), "a"), json.dumps({"rule": {"id": 1, "level": 3}, "full_log": "b"})]
    with open(os.path.join(src, "x.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    out = scratch_path(spark, "out_null")
    ingest_alerts(spark, src, out, scratch_path(spark, "ckpt_null"))
    assert sorted(r.full_log for r in read_table(spark, out).collect()) == ["a", "b"]
    daily = scratch_path(spark, "daily_null")
    daily_counts_stream(spark, src, daily, scratch_path(spark, "ckpt_daily_null"))
    got = {r.date: r.alert_count for r in spark.read.parquet(daily).collect()}
    assert got == {dt.date(2024, 1, 1): 1, None: 1}


def _events(spark, rows):
    """An events table as `<dir>/events.parquet`, from (event_id, ts) rows, all of them alerts."""
    base = scratch_path(spark, "tables")
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")
    frame.selectExpr("event_id", "ts", "event_id % 100 as user_id", "'error' as event_type", "1.0D as value",
                     "'{}' as props").coalesce(1).write.parquet(f"{base}/events.parquet")
    return base


def test_a_sync_is_written_by_several_tasks_and_stays_one_batch(spark):
    """one task wrote a sync. The alerts cover three months, so rows of each sync are older than 24 hours before
    the newest of the syncs before it: they are dropped by the watermark of the sync before the last, as with one file each."""
    from tidemark.plans import scenarios
    from tidemark.sources import fixtures as fx

    start = dt.datetime(2024, 1, 1)
    base = _events(spark, [(i, start + dt.timedelta(minutes=13 * i)) for i in range(9000)])
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "2000")
        seen, files = set(), []
        for src in scenarios._stream_syncs(spark, base):
            now = {f for f in os.listdir(src.removeprefix("file:")) if f.endswith(".txt")}
            files.append(len(now - seen))
            seen = now
        assert len(files) == 4 and all(n > 1 for n in files)
        written = sorted(r.value for r in spark.read.text(src).collect())
        assert written == sorted(r.line for r in fx.alert_lines(spark, base).collect())
        got = sorted(r.raw for r in scenarios.stream_alert_ingest(spark, base).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    # by hand: an alert with a time is late if older than the newest alert up to the sync before the last, less 24 hours
    from tidemark.sources.alert_json import alerts_from_lines
    day = {r.event_id: r.ts for r in spark.read.parquet(f"{base}/events.parquet").collect()}
    lines = fx.alert_lines(spark, base).withColumnRenamed("line", "value")
    alerts = {r.raw: r.timestamp for r in alerts_from_lines(lines).collect()}
    syncs = {n: [] for n in range(1, 5)}
    for r in lines.collect():
        dom, held = day[r.event_id].day, r.event_id % 7 == 3
        n = 4 if held and (dom <= 5 or dom == 30) else 3 if held and dom == 20 else 1 if dom <= 10 else 2 if dom <= 20 else 3
        if r.value in alerts:
            syncs[n].append(r.value)
    want, mark, marks = set(), None, [None]
    for n in range(1, 5):
        late = marks[-2] if len(marks) > 1 else None
        want |= {v for v in syncs[n] if alerts[v] is None or late is None or alerts[v] >= late}
        kept = [alerts[v] for v in syncs[n] if alerts[v] is not None]
        mark = max([x - dt.timedelta(hours=24) for x in kept] + ([mark] if mark else []))
        marks.append(mark)
    assert got == sorted(want)
    assert len(want) < len(alerts)
