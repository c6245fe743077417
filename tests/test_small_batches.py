"""A stream's small batches: what each costs does not grow with those before it."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import event, lines
from eventlake.plans import jobs
from eventlake.queries import Interrupted, drain
from eventlake.sinks import files
from eventlake.sinks import key_sketch as ks
from eventlake.sinks import row_log as rl
from eventlake.sinks import writers as w


def keyed(spark, ids, day="2024-01-01"):
    return spark.createDataFrame([(i if i is None else str(i), dt.date.fromisoformat(day)) for i in ids], "event_id string, event_date date")


def ids(df):
    return sorted((r[0] for r in df.select("event_id").collect()), key=str)


def index(spark, path):
    return [n for n in files.list_children(spark, f"{path}.keys/index") if n.endswith(".json")]


def test_a_key_of_a_small_batch_is_known_without_the_table(spark, tmp_root):
    path = f"{tmp_root}/t"
    for i in range(3):
        w.merge_insert_only(spark, keyed(spark, range(100 * i, 100 * i + 100), f"2024-01-0{i + 1}"), path)
    done = w.merge_insert_only(spark, keyed(spark, range(50, 310), "2024-01-09"), path)
    assert (done["inserted"], done["suspects"], done["rows"]) == (10, 0, 260)
    done = w.merge_insert_only(spark, keyed(spark, range(300)), path)  # more than are looked for one by one
    assert (done["inserted"], done["suspects"]) == (0, 0)
    assert len(ids(spark.read.parquet(path))) == 310 and not any(n.endswith(ks.OPEN) for n in index(spark, path))


def test_rows_without_a_key_and_copies_of_a_new_key_stay(spark, tmp_root):
    path = f"{tmp_root}/t"
    for inserted in (4, 1):
        assert w.merge_insert_only(spark, keyed(spark, [None, "a", "a", "b"]), path)["inserted"] == inserted
    assert ids(spark.read.parquet(path)) == [None, None, "a", "a", "b"]


def test_lists_become_files_and_files_larger_ones(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(ks, "LISTS", 3)
    monkeypatch.setattr(ks, "FILES", 2)
    path = f"{tmp_root}/t"
    for i in range(13):
        done = w.merge_insert_only(spark, keyed(spark, range(10 * i - 5, 10 * i + 10), f"2024-01-{i % 4 + 1:02d}"), path)
        assert (done["inserted"], done["suspects"]) == (10 if i else 15, 0), i
    entries = w.key_sketch(spark, path)._entries()
    assert sorted(e.get("level", 0) for e in entries.values()) == [0, 3]
    assert len(files.list_children(spark, f"{path}.keys/listed")) == 1
    assert ids(spark.read.parquet(path)) == sorted((str(i) for i in range(-5, 130)), key=str)
    sketch = w.key_sketch(spark, path)
    assert sketch.suspect_days(keyed(spark, [7, 12, 125])) == ["2024-01-01", "2024-01-02"]
    assert {(r["key"], r["day"]) for r in sketch.suspects(keyed(spark, [7, 999])).collect()} == {("7", "2024-01-01")}
    assert w.days_of_keys(spark, keyed(spark, [25]), path)["days"] == [dt.date(2024, 1, 3)]


def test_a_large_batch_meets_the_lists(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    w.merge_insert_only(spark, keyed(spark, range(10)), path)
    done = w.merge_insert_only(spark, spark.range(40000).select(F.col("id").cast("string").alias("event_id"), F.lit(dt.date(2024, 1, 2)).alias("event_date")), path)
    assert (done["few"], done["inserted"], done["suspects"]) == (False, 39990, 1)


@pytest.mark.parametrize("take", ["replace", "overwrite", "folder", "table"])
def test_rows_that_were_taken_out_can_come_again(spark, tmp_root, take):
    path, first = f"{tmp_root}/t", keyed(spark, ["a", "b"])
    w.merge_insert_only(spark, first, path)
    w.merge_insert_only(spark, keyed(spark, ["c"], "2024-01-02"), path)
    left = ["c"]
    if take == "replace":
        w.replace_partition(first.filter("event_id = 'x'"), path, dt.date(2024, 1, 1))
    elif take == "overwrite":
        w.overwrite_table(keyed(spark, ["c"], "2024-01-02"), path)
    elif take == "folder":
        files.delete_path(spark, f"{path}/event_date=2024-01-01")
    else:
        files.delete_path(spark, path)
        left = []
    for key in ("a", "b"):
        assert w.merge_insert_only(spark, first.filter(F.col("event_id") == key), path)["inserted"] == 1
    assert w.merge_insert_only(spark, first, path)["inserted"] == 0
    assert ids(spark.read.parquet(path)) == ["a", "b", *left]


def test_an_open_list_is_not_believed(spark, tmp_root):
    path = f"{tmp_root}/t"
    w.merge_insert_only(spark, keyed(spark, ["a"]), path)
    w.key_sketch(spark, path).list_keys([("b", "2024-01-01"), ("c", "2024-01-01")])  # a write that failed before its rows
    keyed(spark, ["c"]).write.mode("append").partitionBy("event_date").parquet(path)  # or after some of them
    done = w.merge_insert_only(spark, keyed(spark, ["a", "b", "c", "d"]), path)
    assert (done["inserted"], done["suspects"]) == (2, 1)
    assert ids(spark.read.parquet(path)) == ["a", "b", "c", "d"]


def rows(spark, data):
    return spark.createDataFrame([(i, v, dt.date.fromisoformat(d)) for i, v, d in data], "event_id string, v int, event_date date")


def test_a_small_commit_is_one_file(spark, tmp_root):
    log = rl.RowLog(spark, f"{tmp_root}/silver")
    many = rows(spark, [(str(d), 1, f"2024-01-{d:02d}") for d in range(1, 11)]).coalesce(1)
    log.append(many, "stream", 0, small=True)
    assert not log.append(many, "stream", 0, small=True)
    (commit,) = log.commits()
    assert len([n for n in files.list_children(spark, f"{log.root}/commit={commit.name}") if n.startswith("part-")]) == 1
    log.append(rows(spark, [("3", 2, "2024-01-20")]), "batch", 0)
    log.append(rows(spark, [("4", 3, "2024-01-01")]).coalesce(1), "stream", 1, small=True)
    want = sorted([(str(d), 1, f"2024-01-{d:02d}") for d in range(1, 11) if d not in (3, 4)] + [("3", 2, "2024-01-20"), ("4", 3, "2024-01-01")])
    state = lambda df: sorted((r["event_id"], r["v"], str(r["event_date"])) for r in df.collect())
    assert log.read().columns == ["event_id", "v", "event_date"] and state(log.read()) == want
    assert state(log.read([dt.date(2024, 1, 1)])) == [("1", 1, "2024-01-01"), ("4", 3, "2024-01-01")]
    assert log.days_of_keys(rows(spark, [("4", 0, "2024-01-01")])) == [dt.date(2024, 1, 1), dt.date(2024, 1, 4)]
    log.fold()
    assert state(spark.read.parquet(log.path)) == want and log.commits() == []


def test_sinks_of_a_bounded_stream_are_done_once_each(spark, tmp_root, monkeypatch):
    """A trigger's batch fails ahead of each sink; bad lines only in one batch."""
    from eventlake.sources.message_log import message_log
    from eventlake.streaming import ingest

    lake, topic, checkpoint = jobs.Lake(f"{tmp_root}/lake"), f"{tmp_root}/topic", f"{tmp_root}/ckpt"
    recs = ["broken"] * 4 + [event(id=str(i % 9), created_at=f"2024-01-{i % 5 + 1:02d}T00:00:00Z") for i in range(16)]
    lines(spark, recs).coalesce(1).write.text(f"{topic.replace('file://', '')}/p=0")
    due = {(1, "bronze"), (2, "silver"), (3, "quarantine")}

    def fail_once(sink, batch_id):
        if (batch_id, sink) in due:
            due.discard((batch_id, sink))
            raise Interrupted(f"ahead of {sink}")

    start = ingest.start_ingestion
    monkeypatch.setattr(ingest, "start_ingestion", lambda *a, **k: start(*a, **k, most_rows=4))
    failures = 0
    for _ in range(9):  # an available-now run of the source is a trigger
        failures += drain(spark, message_log(spark, topic, checkpoint, 4), lake, checkpoint, fail_once)
    assert failures == 3 and not due
    silver = jobs.read_silver(spark, lake)
    assert ids(silver) == ids(spark.read.parquet(lake.bronze_stream)) == [str(i) for i in range(9)]
    assert spark.read.parquet(lake.quarantine).count() == 4
    commits = jobs.silver_log(spark, lake).commits()
    assert len(commits) == 5 and len(jobs.silver_log(spark, lake)._filled(commits)) == 4
    days = {n: len(files.list_children(spark, f"{lake.bronze_stream}/{n}")) for n in files.list_children(spark, lake.bronze_stream) if "=" in n}
    assert len(days) == 5
