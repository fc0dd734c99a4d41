import glob
import os
import shutil
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from raceway import session, streaming
from raceway.streaming import live
from raceway.operators import latest_per_key

START = datetime(2024, 3, 2, 15)
DDL = "id bigint, car int, at timestamp_ntz, position int"


def at(minutes):
    return START + timedelta(minutes=minutes)


@pytest.fixture
def feed(spark, tmp_path):
    """A landing folder, files dropped into it in order, and a stream that takes one at a time."""
    folder = tmp_path / "landing"
    folder.mkdir()
    schema = spark.createDataFrame([], DDL).schema

    class Feed:
        files = 0

        def land(self, *records):
            Feed.files += 1
            part = f"{tmp_path}/part{Feed.files}"
            spark.createDataFrame(list(records), DDL).coalesce(1).write.parquet(part)
            (file,) = glob.glob(f"{part}/part-*.parquet")
            target = f"{folder}/{Feed.files:03d}.parquet"
            shutil.copy(file, target)
            # The file source takes the oldest file first.
            os.utime(target, (1_700_000_000 + Feed.files * 60,) * 2)

        def open(self, max_files=1):
            stream = streaming.open_stream(spark, str(folder), schema, max_files=max_files)
            return stream.withColumn("at", F.col("at").cast("timestamp"))

        def path(self, name):
            return f"{tmp_path}/{name}"

    return Feed()


def ntz(df, column="at"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def test_latest_follows_changes_and_resumes(spark, feed):
    out, checkpoint = feed.path("out"), feed.path("cp")

    def run():
        latest = streaming.latest_stream(feed.open(), ["car"], ["at", "position"])
        streaming.run_available(streaming.write_changes(latest, out, checkpoint))
        return rows(ntz(streaming.read_changes(spark, out, ["car"], ["at", "position"])), "car", "at", "position")

    feed.land((1, 1, at(0), 5), (2, 44, at(0), 2))
    feed.land((3, 1, at(2), 3), (4, 1, at(1), 9))
    assert run() == [(1, at(2), 3), (44, at(0), 2)]
    feed.land((5, 1, at(1), 1), (6, 44, at(0), 4), (7, 7, None, 8))
    assert run() == [(1, at(2), 3), (7, None, 8), (44, at(0), 4)]
    assert run() == [(1, at(2), 3), (7, None, 8), (44, at(0), 4)]


def test_latest_agrees_with_the_batch_operator(spark, feed):
    records = [(i, i % 5, at(i * 7 % 60), i % 3) for i in range(200)]
    feed.land(*records)
    out = feed.path("out")
    latest = streaming.latest_stream(feed.open(), ["car"], ["at", "position", "id"])
    streaming.run_available(streaming.write_changes(latest, out, feed.path("cp")))
    batch = latest_per_key(spark.createDataFrame(records, DDL), ["car"], ["at", "position", "id"])
    got = ntz(streaming.read_changes(spark, out, ["car"], ["at", "position", "id"]))
    assert rows(got, "car", "id", "at") == rows(batch, "car", "id", "at")


def test_window_means_take_late_rows_within_the_watermark_only(spark, feed):
    feed.land((1, 1, at(0), 10), (2, 1, at(9), 20))
    feed.land((3, 1, at(16), 1))  # the watermark moves to minute 11
    feed.land((4, 1, at(11), 3))  # late, but its window is still open
    feed.land((5, 1, at(2), 99))  # beyond the watermark
    feed.land((6, 1, at(60), 7))
    feed.land((7, 1, at(61), 7))
    means = streaming.window_mean(feed.open(), "at", ["position"], "10 minutes", "5 minutes")
    writer = streaming.land_stream(means, feed.path("out"), feed.path("cp"))
    streaming.run_available(writer)
    got = ntz(spark.read.parquet(feed.path("out")), "window_start")
    assert rows(got) == [(at(0), 15.0), (at(10), 2.0)]


@pytest.mark.parametrize("salts", [1, 8])
def test_repeated_polls_count_once(spark, feed, salts):
    first = [(i, 1, at(i), i) for i in range(5)]
    feed.land(*first)
    feed.land(*first, (5, 1, at(5), 5))  # the poll again, with one new row
    feed.land(*[(7, 1, at(6), 7)] * 50)  # one row many times
    once = streaming.dedupe_stream(feed.open(), ["id"], "at", "1 hour", salts)
    streaming.run_available(streaming.land_stream(once, feed.path("out"), feed.path("cp")))
    assert rows(spark.read.parquet(feed.path("out")), "id") == [(i,) for i in (0, 1, 2, 3, 4, 5, 7)]


def test_landing_counts_each_file_once(spark, feed):
    def run():
        streaming.run_available(streaming.land_stream(feed.open(), feed.path("out"), feed.path("cp")))
        return spark.read.parquet(feed.path("out")).count()

    feed.land((1, 1, at(0), 1))
    assert run() == 1
    feed.land((2, 1, at(0), 1), (3, 1, at(0), 1))
    assert run() == 3
    assert run() == 3


def test_changed_windows_take_the_place_of_their_older_means(spark, feed):
    out = feed.path("out")
    feed.land((1, 1, at(0), 10))
    feed.land((2, 1, at(5), 20), (3, 1, at(12), 7))
    feed.land((4, 1, at(13), 9))
    means = streaming.window_mean(feed.open(), "at", ["position"], "10 minutes", "1 hour")
    streaming.run_available(streaming.write_changes(means, out, feed.path("cp")))
    want = [(at(0), 15.0), (at(10), 8.0)]
    assert rows(ntz(streaming.read_changes(spark, out, ["window_start"]), "window_start")) == want


def state_rows(query):
    return sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])


def test_old_state_is_freed(spark, feed):
    for k in range(6):
        feed.land((k, 1, at(k * 600), k))
    for stream in (
        streaming.dedupe_stream(feed.open(), ["id"], "at", "1 hour"),
        streaming.window_mean(feed.open(), "at", ["position"], "10 minutes", "1 hour"),
    ):
        path = feed.path(f"out-{len(stream.columns)}")
        query = streaming.land_stream(stream, path, f"{path}-cp").trigger(availableNow=True).start()
        query.awaitTermination()
        assert state_rows(query) <= 2


def test_a_compacted_log_reads_the_same(spark, feed):
    out, keys, newest = feed.path("out"), ["car"], ["at", "position"]

    def run():
        latest = streaming.latest_stream(feed.open(), keys, newest)
        streaming.run_available(streaming.write_changes(latest, out, feed.path("cp")))
        return rows(ntz(streaming.read_changes(spark, out, keys, newest)), "car", "at", "position")

    for k in range(5):
        feed.land((k, k % 2, at(k), k))
    before = run()
    streaming.compact_changes(spark, out, keys, newest)
    assert sorted(os.listdir(out)) == ["batch=3.5", "batch=4"] and run() == before
    feed.land((9, 0, at(60), 3))
    assert run() == [(0, at(60), 3), before[1]]
    streaming.compact_changes(spark, out, keys, newest)
    assert len([n for n in os.listdir(out) if n.startswith("batch")]) == 2 and run() == [(0, at(60), 3), before[1]]


@pytest.mark.parametrize("stop", ["move_folder", "remove_folder"])
def test_a_compaction_that_stopped_is_cleared_by_the_next(spark, feed, monkeypatch, stop):
    out, keys, newest = feed.path("out"), ["car"], ["at", "position"]

    def run():
        latest = streaming.latest_stream(feed.open(), keys, newest)
        streaming.run_available(streaming.write_changes(latest, out, feed.path("cp")))
        return rows(ntz(streaming.read_changes(spark, out, keys, newest)), "car", "at", "position")

    for k in range(12):  # batch 10 must come after batch 9
        feed.land((k, k % 2, at(k // 3), k))
    want = run()
    done = []

    def stopped(*a):
        if len(done) == (stop == "remove_folder"):
            raise OSError("stop")
        done.append(getattr(session, stop)(*a))

    with monkeypatch.context() as patch:
        patch.setattr(live, stop, stopped)
        with pytest.raises(OSError):
            streaming.compact_changes(spark, out, keys, newest)
    assert run() == want
    streaming.compact_changes(spark, out, keys, newest)
    assert run() == want and len([n for n in os.listdir(out) if n.startswith("batch")]) == 2
    feed.land((99, 0, at(60), 3))
    want = [(0, at(60), 3), want[1]]
    assert run() == want
    streaming.compact_changes(spark, out, keys, newest)
    assert run() == want and len([n for n in os.listdir(out) if n.startswith("batch")]) == 2
