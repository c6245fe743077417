"""Table totals from the days that a run wrote."""

from __future__ import annotations

import datetime

from eventlake.sinks import writers
from eventlake.sinks.day_counts import DayCounts

DAYS = [datetime.date(2024, 1, d) for d in range(1, 7)]


def _rows(spark, *numbers):
    """``numbers[i]`` rows of the day i."""
    days = [(i, d) for d, n in zip(DAYS, numbers, strict=False) for i in range(n)]
    return spark.createDataFrame(days, "k long, event_date date")


def test_totals_follow_the_days_written(spark, tmp_root):
    a, b = f"{tmp_root}/a", f"{tmp_root}/b"
    counts = DayCounts(spark, f"{tmp_root}/counts")
    assert counts.record({"a": a}, DAYS) == {"a": 0}  # no table yet
    writers.overwrite_table(_rows(spark, 3, 4, 5), a)
    assert counts.record({"a": a}, DAYS[:1]) == {"a": 12}  # met for the first time: all days
    writers.overwrite_partitions(_rows(spark, 0, 1, 0, 7), a, expected=DAYS[1:4])
    writers.overwrite_table(_rows(spark, 2), b)
    assert counts.record({"a": a, "b": b}, DAYS[1:4]) == {"a": 11, "b": 2}  # an emptied day counts no more
    assert counts.record({"a": a}, DAYS[1:4]) == {"a": 11}  # a rerun changes nothing
    assert {(r["name"], r["rows"]) for r in counts.read().collect()} == {("a", 3), ("a", 1), ("a", 7), ("b", 2)}
    writers.overwrite_table(_rows(spark, 1, 1), a)
    assert counts.record({"a": a}, None) == {"a": 2}
    assert counts.record({"a": a, "b": b}, []) == {"a": 2, "b": 2}


def test_days_that_were_not_written_are_not_counted_again(spark, tmp_root):
    path = f"{tmp_root}/a"
    counts = DayCounts(spark, f"{tmp_root}/counts")
    writers.overwrite_table(_rows(spark, 3, 4), path)
    counts.record({"a": path}, None)
    writers.delete_path(spark, f"{path}/event_date=2024-01-01")  # a look at this day would find it gone
    writers.overwrite_partitions(_rows(spark, 0, 9), path)
    assert counts.record({"a": path}, DAYS[1:2]) == {"a": 12}
    assert counts.record({"a": path}, DAYS[:2]) == {"a": 9}
