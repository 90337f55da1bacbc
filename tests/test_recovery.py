"""Loads and streams that die between their rows and their entry, lookups that read no data, and days on which nothing
is delivered."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streaming import _line
from tidemark.operators import keyed_load
from tidemark.session import scratch_path
from tidemark.sources import fixtures as fx
from tidemark.streaming.alerts import ingest_alerts

KEYS = ("k",)


def rows(spark, *numbers):
    return spark.createDataFrame([(f"k{i}", i) for i in numbers], "k string, v long")


class Killed(RuntimeError):
    pass


@pytest.fixture
def dying(monkeypatch):
    """Makes a load die after its rows and before its entry, for as long as it is told to."""
    state, real = {"dies": True}, keyed_load.stats_frame

    def stats_frame(*args):
        if state["dies"]:
            raise Killed("before the entry")
        return real(*args)

    monkeypatch.setattr(keyed_load, "stats_frame", stats_frame)
    return state


def table(spark, path):
    return sorted((r.k, r.id) for r in keyed_load.read_table(spark, path).collect())


def test_first_load_without_an_entry(spark, dying):
    path = scratch_path(spark, "loads")
    with pytest.raises(Killed):
        keyed_load.keyed_append(spark, path, rows(spark, 1, 2, 3), KEYS, surrogate="id")
    dying["dies"] = False
    again = keyed_load.keyed_append(spark, path, rows(spark, 1, 2, 3), KEYS, surrogate="id")
    assert (again.load_id, again.inserted, again.skipped, again.rows_before, again.rows_after) == (2, 0, 3, 3, 3)
    more = keyed_load.keyed_append(spark, path, rows(spark, 3, 4), KEYS, surrogate="id")
    assert (more.load_id, more.inserted, more.rows_after) == (3, 1, 4)
    got = table(spark, path)
    assert [k for k, _ in got] == ["k1", "k2", "k3", "k4"] and sorted(i for _, i in got) == [1, 2, 3, 4]


def test_later_load_without_an_entry(spark, dying):
    path = scratch_path(spark, "loads")
    dying["dies"] = False
    keyed_load.keyed_append(spark, path, rows(spark, 1, 2), KEYS, surrogate="id")
    dying["dies"] = True
    with pytest.raises(Killed):
        keyed_load.keyed_append(spark, path, rows(spark, 2, 3, 4), KEYS, surrogate="id")
    dying["dies"] = False
    last = keyed_load.keyed_append(spark, path, rows(spark, 3, 4, 5), KEYS, surrogate="id")
    assert (last.load_id, last.inserted, last.rows_before, last.rows_after) == (3, 1, 4, 5)
    got = table(spark, path)
    assert len(got) == 5 and sorted(i for _, i in got) == [1, 2, 3, 4, 5]


def test_entries_gone_altogether(spark):
    path = scratch_path(spark, "loads")
    for batch in (rows(spark, 1, 2), rows(spark, 3)):
        keyed_load.keyed_append(spark, path, batch, KEYS, surrogate="id")
    fs, log = keyed_load._fs_path(spark, f"{path}__loads")
    fs.delete(log, True)
    next_ = keyed_load.keyed_append(spark, path, rows(spark, 1, 9), KEYS, surrogate="id")
    assert (next_.load_id, next_.inserted, next_.rows_before) == (3, 1, 3)
    assert sorted(i for _, i in table(spark, path)) == [1, 2, 3, 4]


def test_named_batch_is_loaded_once(spark, dying):
    path = scratch_path(spark, "loads")
    with pytest.raises(Killed):
        keyed_load.keyed_append(spark, path, rows(spark, 1, 2), KEYS, surrogate="id", batch_name="b0")
    dying["dies"] = False
    # the replay holds a row that the first try had not written
    replay = keyed_load.keyed_append(spark, path, rows(spark, 1, 2, 3), KEYS, surrogate="id", batch_name="b0")
    assert (replay.load_id, replay.attempted, replay.inserted, replay.rows_before, replay.rows_after) == (1, 3, 3, 0, 3)
    assert keyed_load.keyed_append(spark, path, rows(spark, 1, 2, 3, 4), KEYS, surrogate="id", batch_name="b0") == replay
    after = keyed_load.keyed_append(spark, path, rows(spark, 3, 4), KEYS, surrogate="id", batch_name="b1")
    assert (after.load_id, after.inserted, after.rows_after) == (2, 1, 4)
    assert sorted(i for _, i in table(spark, path)) == [1, 2, 3, 4]


def _syncs(spark, files):
    src = scratch_path(spark, "sync").removeprefix("file:")
    os.makedirs(src)
    for i, lines in enumerate(files):
        path = os.path.join(src, f"sync{i}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (time.time() - 100 + i, time.time() - 100 + i))
    return src


def test_killed_stream_counts_every_alert_once(spark, dying):
    day = dt.datetime(2024, 1, 10)
    src = _syncs(spark, [[_line(day, "a"), _line(day, "b")], [_line(day, "b"), _line(day, "c")], [_line(day, "d")]])
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    with pytest.raises(StreamingQueryException):            # the first micro-batch dies
        ingest_alerts(spark, src, out, ckpt, max_files_per_trigger=1)
    dying["dies"] = False
    real, keyed_load.stats_frame = keyed_load.stats_frame, _once_then_die(keyed_load.stats_frame)
    try:
        with pytest.raises(StreamingQueryException):        # replayed; then the second dies
            ingest_alerts(spark, src, out, ckpt, max_files_per_trigger=1)
    finally:
        keyed_load.stats_frame = real
    assert keyed_load.loads(spark, out).count() == 1
    ingest_alerts(spark, src, out, ckpt, max_files_per_trigger=1)
    assert sorted(r.full_log for r in keyed_load.read_table(spark, out).collect()) == ["a", "b", "c", "d"]
    log = keyed_load.loads(spark, out).collect()
    assert sum(r.inserted for r in log) == 4 and max(r.rows_after for r in log) == 4
    assert len({r.load_batch for r in log}) == len(log) == len({r.load_id for r in log})


def _once_then_die(real):
    calls = []

    def stats_frame(*args):
        calls.append(1)
        if len(calls) > 1:
            raise Killed("before the entry")
        return real(*args)

    return stats_frame


def test_late_alerts_are_dropped_by_event_time(spark):
    day = dt.datetime(2024, 1, 10)
    at = lambda hours: day + dt.timedelta(hours=hours)
    src = _syncs(spark, [[_line(at(0), "a")], [_line(at(48), "b")], [_line(at(30), "slightly late"), _line(at(72), "c")],
                         [_line(at(2), "late"), _line(at(60), "d"), _line(at(0), "a")]])
    out = scratch_path(spark, "out")
    ingest_alerts(spark, src, out, scratch_path(spark, "ckpt"), lateness="24 hours", max_files_per_trigger=1)
    assert sorted(r.full_log for r in keyed_load.read_table(spark, out).collect()) == ["a", "b", "c", "d", "slightly late"]


def scanned(df):
    """Rows that the scans of a query return, after it has run."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if "Scan parquet" in node.nodeName() and "load" in node.toString():
            n += node.metrics().get("numOutputRows").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_lookup_reads_no_rows_of_keys_that_are_new(spark):
    key = lambda c: F.md5(c.cast("string"))
    path, seen = scratch_path(spark, "loads"), []
    for load in range(4):
        batch = spark.range(load * 3000, load * 3000 + 3000).select(key(F.col("id")).alias("k"), F.col("id").alias("v"))
        new = spark.range(10**6, 10**6 + 200).select(key(F.col("id")).alias("k"))
        keyed_load.keyed_append(spark, path, batch, KEYS)
        found = keyed_load.hits(spark, path, new, ["k"], "k", 200)
        assert "PushedFilters: [In(k" in found._jdf.queryExecution().executedPlan().toString()
        seen.append(scanned(found))
    assert seen == [0] * 4                    # however many keys the table has
    old = batch.limit(200).select("k")
    assert keyed_load.hits(spark, path, old, ["k"], "k", 200).count() == 200
    assert keyed_load.hits(spark, path, old, ["k"], "k", keyed_load.PUSHED + 1).count() == 200      # by bounds


def test_days_without_deliveries(spark):
    from tidemark.plans import daily, scenarios

    prices, geo = fx.benchmark_prices(spark, SF_SMALL), fx.ip_geo(spark, SF_SMALL)
    brokers = scenarios.write_broker_files(spark, SF_SMALL)
    base, nowhere = scratch_path(spark, "daily"), scratch_path(spark, "nowhere")
    missing = [(f"{nowhere}/{s}", s, t) for _, s, t in brokers]
    nothing = daily.run(spark, daily.Inputs(missing, f"{nowhere}/alerts", prices.limit(0), geo), base,
                        dt.date(2024, 2, 1), raise_on_failure=False)
    assert nothing.rows == {"trades": 0, "alerts": 0, "prices": 0} and not nothing.versions
    assert spark.read.parquet(nothing.models["fct_trades"]).count() == 0
    assert spark.read.parquet(nothing.models["mart_cross_domain"]).count() == 0
    one = daily.run(spark, daily.Inputs(brokers[:1] + missing[1:], f"{nowhere}/alerts", prices, geo), base,
                    dt.date(2024, 2, 2), raise_on_failure=False)
    assert one.rows["alerts"] == 0 and 0 < one.rows["trades"] == spark.read.parquet(one.models["fct_trades"]).count()


def test_a_load_moves_no_whole_rows(spark, monkeypatch):
    """a load shuffled its rows for the first of a key, for the keys already there and for the files' sizes."""
    from tidemark.operators import keyed_load
    from tidemark.session import materialize

    n = 400
    rows = spark.range(n).selectExpr("id as at", "concat('k', id) as k", "repeat(md5(cast(id as string)), 4) as wide")
    batch = rows.repartition(4).withColumn(keyed_load.POSITION, F.monotonically_increasing_id())
    staged = materialize(batch, "batch")
    first = keyed_load.first_positions(staged, ("k",))
    assert "wide" not in first.columns
    same, whole = keyed_load._only(staged, first, n)
    assert whole and same is staged
    for keep in (10, 390):                       # few stay, few go: only the short list of positions is moved
        some, whole = keyed_load._only(staged, first.where(F.expr(f"cast(substr(k, 2) as int) < {keep}")), n)
        assert not whole and some.count() == keep
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    # numbers are dense over loads that take all rows, some and none
    monkeypatch.setattr(keyed_load, "SMALL", 0)
    path = scratch_path(spark, "numbered")
    for upto, new in ((300, 300), (n, 100), (n, 0)):
        twice = rows.where(F.col("at") < upto).unionByName(rows.where((F.col("at") < 50) & F.lit(upto == n)))
        assert keyed_load.keyed_append(spark, path, twice, ("k",), surrogate="id").inserted == new
    got = keyed_load.read_table(spark, path)
    assert sorted(r.id for r in got.collect()) == list(range(1, n + 1))
    assert got.select("k").distinct().count() == n
