import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import EDGE_CSV
from skyledger import schemas
from skyledger.operators.gold import to_daily
from skyledger.operators.layers import to_bronze, to_silver
from skyledger.sources.csv import read_raw, stream_raw
from skyledger.streaming import continuous

HEADER, *LINES = EDGE_CSV.splitlines()


class Feed:
    """A folder of arriving files and the copy that follows it."""

    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.incoming = tmp_path / "incoming"
        self.incoming.mkdir()
        self.target, self.work = str(tmp_path / "target"), str(tmp_path / "work")
        self.files = 0

    def add(self, *lines):
        self.files += 1
        path = self.incoming / f"{self.files:03}.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")

    def copy(self, work=None, files_per_batch=1):
        raw = stream_raw(self.spark, str(self.incoming), files_per_batch)
        query = continuous.start(raw, self.target, work or self.work, available_now=True)
        query.awaitTermination()

    def stamp(self, n, at):
        seconds = 1_700_000_000 + at
        os.utime(self.incoming / f"{n:03}.csv", (seconds, seconds))

    def served(self):
        target = continuous.read_target(self.spark, self.target)
        return target.select(*schemas.DAILY.names)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def batch_rows(spark, tmp_path, lines, rows):
    path = tmp_path / "whole.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return rows(to_daily(to_silver(to_bronze(read_raw(spark, str(path))))))


def corrected(line, value):
    time, _, rest = line.split(",", 2)
    return f"{time},{value},{rest}"


def test_stream_ends_where_the_batch_does(spark, feed, tmp_path, rows):
    for line in LINES:
        feed.add(line)
    feed.copy()
    assert rows(feed.served()) == batch_rows(spark, tmp_path, LINES, rows)


def test_corrections_replace_rows_and_leave_other_months(spark, feed, tmp_path, rows):
    feed.add(*LINES)
    feed.copy()
    feed.add(corrected(LINES[0], 31.5))
    feed.copy()
    expected = [corrected(LINES[0], 31.5), *LINES[1:]]
    assert rows(feed.served()) == batch_rows(spark, tmp_path, expected, rows)


def test_newest_file_wins_within_a_batch(spark, feed, tmp_path, rows):
    for n, value in enumerate((1.0, 2.0, 3.0)):
        feed.add(corrected(LINES[0], value))
        stamp = 1_700_000_000 + n
        os.utime(feed.incoming / f"{feed.files:03}.csv", (stamp, stamp))
    feed.copy(files_per_batch=10)
    assert [r.max_temp_c for r in feed.served().collect()] == [3.0]


def test_replay_from_a_fresh_checkpoint_changes_nothing(feed, tmp_path, rows):
    feed.add(*LINES)
    feed.add(corrected(LINES[0], 31.5))
    feed.copy()
    before = rows(feed.served())
    feed.copy(work=str(tmp_path / "other"))
    assert rows(feed.served()) == before


def test_batch_that_died_before_the_switch_is_finished_from_the_stage(
    spark, feed, tmp_path, rows, monkeypatch
):
    feed.add(*LINES[:4])
    feed.copy()
    feed.add(*LINES[4:])

    def dies(*args):
        raise OSError("executor host lost")

    monkeypatch.setattr(continuous, "clustered", dies)
    with pytest.raises(Exception, match="executor host lost"):
        feed.copy()
    monkeypatch.undo()
    # The old month is lost as well: what a half-done overwrite can leave behind.
    empty = spark.createDataFrame([], continuous.STORED)
    empty.write.mode("overwrite").partitionBy(continuous.PERIOD).parquet(feed.target)
    feed.copy()
    assert rows(feed.served()) == batch_rows(spark, tmp_path, LINES, rows)


def test_incomplete_stage_is_built_again(spark, feed, tmp_path, rows, monkeypatch):
    feed.add(*LINES)
    real = continuous._staged_batch
    monkeypatch.setattr(continuous, "_staged_batch", lambda *a: None)
    feed.copy()
    monkeypatch.setattr(continuous, "_staged_batch", real)
    feed.add(LINES[0])
    feed.copy()
    assert rows(feed.served()) == batch_rows(spark, tmp_path, LINES, rows)


def test_rows_without_key_are_not_published(feed):
    feed.add(LINES[5], LINES[6])
    feed.copy()
    assert feed.served().count() == 0


def test_a_late_older_file_does_not_win(spark, feed, tmp_path, rows):
    feed.add(*LINES)
    feed.stamp(1, 500)
    feed.copy()
    before = rows(feed.served())
    feed.add(*(corrected(line, 99.0) for line in LINES[:4]), "2024-01-20" + LINES[0][10:])
    feed.stamp(2, 100)
    feed.copy()
    found = rows(feed.served())
    assert [r for r in found if r in before] == before
    assert len(found) == len(before) + 1  # its day of its own is new


@pytest.mark.parametrize("files_per_batch", [1, 2, 7])
def test_no_order_and_no_cut_of_files_matters(spark, feed, tmp_path, rows, files_per_batch):
    """Corrections arrive shuffled, some with equal times; the newest of each key stays."""
    draw = random.Random(files_per_batch)
    versions = [(at, line, 10.0 + at) for at in (1, 2, 3) for line in LINES[:4]]
    draw.shuffle(versions)
    for n, (at, line, value) in enumerate(versions, start=1):
        feed.add(corrected(line, value))
        feed.stamp(n, at)
        if n % 5 == 0:
            feed.copy(files_per_batch=files_per_batch)
    feed.add(corrected(LINES[0], 12.5), corrected(LINES[1], 13.5))
    feed.stamp(len(versions) + 1, 3)
    feed.copy(files_per_batch=files_per_batch)
    expected = {"2024-01-01": 13.0, "2024-01-02": 13.5, "2024-01-03": 13.0, "2024-01-04": 13.0}
    assert {str(r.weather_date): r.max_temp_c for r in feed.served().collect()} == expected
    feed.copy(work=str(tmp_path / "again"), files_per_batch=3)
    assert {str(r.weather_date): r.max_temp_c for r in feed.served().collect()} == expected


def test_rows_stored_without_a_time_are_the_oldest(spark, feed, rows):
    """What a target held before it kept times."""
    feed.add(LINES[0])
    feed.copy()
    old = continuous.read_target(spark, feed.target).withColumn("max_temp_c", F.lit(99.0))
    kept = [*schemas.DAILY.names, continuous.PERIOD]
    spark.createDataFrame(old.select(*kept).collect(), old.select(*kept).schema).write.mode("overwrite").partitionBy(continuous.PERIOD).parquet(feed.target)
    assert [r.max_temp_c for r in feed.served().collect()] == [99.0]
    feed.copy(work=feed.work + "_new")
    assert [r.max_temp_c for r in feed.served().collect()] == [29.99]


def test_a_batch_costs_what_it_brings(spark, feed, tmp_path, rows, monkeypatch):
    """Months are not rewritten by every batch, and readers see its rows all the same."""
    monkeypatch.setattr(continuous, "FEW", 0)
    merges = []
    real = continuous.clustered
    monkeypatch.setattr(continuous, "clustered", lambda *a: merges.append(1) or real(*a))
    lines = [f"2024-{m:02}-{d:02}" + LINES[0][10:] for m in range(1, 4) for d in range(1, 9)]
    feed.add(*lines)
    feed.stamp(1, 0)
    feed.copy()
    assert len(merges) == 1
    now = dict(enumerate(lines))
    for n in range(12):
        now[n] = corrected(lines[n], 40.0 + n)
        feed.add(now[n], corrected(lines[n + 1], 39.0))  # the next one replaces the second
        feed.stamp(n + 2, n + 1)
    now[12] = corrected(lines[12], 39.0)
    feed.copy()
    assert len(merges) == 1
    assert rows(feed.served()) == batch_rows(spark, tmp_path, now.values(), rows)
    march = continuous.read_target(spark, feed.target).filter(f"{continuous.PERIOD} = '2024-03-01'")
    assert march.count() == 8
    for again in ("again", "third"):
        feed.copy(work=str(tmp_path / again), files_per_batch=2)
        assert rows(feed.served()) == batch_rows(spark, tmp_path, now.values(), rows)
    assert 1 < len(merges) <= 4  # of 15 batches
    stored = spark.read.schema(continuous.STORED).parquet(feed.target)
    assert stored.count() == len(lines)


def test_a_run_without_a_date_is_refused(spark, feed):
    feed.add(LINES[0])
    feed.copy()
    undated = continuous.read_target(spark, feed.target).withColumn(
        "weather_date", F.lit(None).cast("date")
    )
    with pytest.raises(ValueError, match="rows without weather_date"):
        continuous.upsert(undated, 7, feed.target, feed.work)
    assert feed.served().count() == 1


def _months_of_rows(feed, months, files):
    """Files with days of all months each, the later ones correcting every other day."""
    days = [f"2024-{m:02}-{d:02}" + LINES[0][10:] for m in range(1, months + 1) for d in range(1, 5)]
    now = dict(enumerate(days))
    for n in range(files):
        now |= {k: corrected(days[k], 20.0 + n) for k in now if k % 2 == n % 2}
        feed.add(*(now.values() if n == 0 else [now[k] for k in now if k % 2 == n % 2]))
        feed.stamp(n + 1, n)
    return list(now.values())


def test_a_merge_goes_over_few_months_at_a_time(spark, feed, tmp_path, rows, monkeypatch):
    """No exchange of a merge gets more rows than a slice has, unless one month has more."""
    monkeypatch.setattr(continuous, "SLICE", 20)
    settled, placed = [], []
    latest, clustered = continuous.latest_per_key, continuous.clustered
    monkeypatch.setattr(
        continuous, "latest_per_key", lambda df, *a: settled.append(df.count()) or latest(df, *a)
    )
    monkeypatch.setattr(
        continuous, "clustered", lambda df, *a: placed.append(df.count()) or clustered(df, *a)
    )
    lines = _months_of_rows(feed, months=7, files=3)
    feed.copy(files_per_batch=2)
    assert sum(settled) > 2 * 20 and max(settled) <= 20
    assert len(placed) > 2 and max(placed) <= 20
    monkeypatch.undo()
    assert rows(feed.served()) == batch_rows(spark, tmp_path, lines, rows)
    assert spark.read.schema(continuous.STORED).parquet(feed.target).count() == len(lines)


def test_a_month_with_more_rows_than_a_slice_is_merged_whole(
    spark, feed, tmp_path, rows, monkeypatch
):
    monkeypatch.setattr(continuous, "SLICE", 3)
    lines = _months_of_rows(feed, months=3, files=4)
    feed.copy()
    assert rows(feed.served()) == batch_rows(spark, tmp_path, lines, rows)


def test_a_batch_that_died_between_two_slices_is_finished(
    spark, feed, tmp_path, rows, monkeypatch
):
    monkeypatch.setattr(continuous, "SLICE", 8)
    lines = _months_of_rows(feed, months=6, files=1)
    real, calls = continuous.clustered, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("executor host lost")
        return real(*args)

    monkeypatch.setattr(continuous, "clustered", dies)
    with pytest.raises(Exception, match="executor host lost"):
        feed.copy()
    monkeypatch.setattr(continuous, "clustered", real)
    stored = spark.read.schema(continuous.STORED).parquet(feed.target)
    assert 0 < stored.count() < len(lines)
    feed.copy()
    assert rows(feed.served()) == batch_rows(spark, tmp_path, lines, rows)


def test_only_the_quarantine_stays_beside_the_target(spark, feed, tmp_path, rows):
    """Stage and arrived rows of a batch go when it is done."""
    feed.add(*LINES, corrected(LINES[3], "n/a"))
    raw = stream_raw(spark, str(feed.incoming), 1, on_bad="mark")
    continuous.start(raw, feed.target, feed.work, available_now=True).awaitTermination()
    left = {d.name for d in (tmp_path / "work").iterdir() if d.name != "stream"}
    held = {n for n in left if spark.read.parquet(f"{feed.work}/{n}").count()}
    assert held == {"quarantine"}
    assert rows(feed.served()) == batch_rows(spark, tmp_path, LINES, rows)


def _shuffles(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    names = env.blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
    return {name for name in names if name.startswith("shuffle_")}


def test_merges_leave_no_shuffle_files(spark, feed):
    before = _shuffles(spark)
    _months_of_rows(feed, months=3, files=3)
    feed.copy()
    for _ in range(100):  # files go in the background
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.1)
    assert not left
