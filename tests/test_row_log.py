"""Commits of several writers: last writer wins, no day rewritten, folds that can fail."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import SMOKE_SF
from eventlake import queries
from eventlake.plans.jobs import Lake, silver_log
from eventlake.sinks import files
from eventlake.sinks import row_log as rl
from eventlake.sinks import writers as w


def rows(spark, data):
    return spark.createDataFrame([(i, v, dt.date.fromisoformat(d)) for i, v, d in data], "event_id string, v int, event_date date")


def state(df):
    return sorted((r["event_id"], r["v"], str(r["event_date"])) for r in df.collect())


def table_files(spark, path):
    return sorted(f"{d}/{n}" for d in files.list_children(spark, path) if "=" in d for n in files.list_children(spark, f"{path}/{d}") if n.endswith(".parquet"))


@pytest.fixture
def log(spark, tmp_root):
    return rl.RowLog(spark, f"{tmp_root}/silver")


def test_last_writer_wins_and_rows_move_between_days(spark, log):
    log.append(rows(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")]), "batch", "1")
    log.append(rows(spark, [("a", 2, "2024-01-03"), ("c", 2, "2024-01-02")]), "stream", "1")
    want = [("a", 2, "2024-01-03"), ("b", 1, "2024-01-01"), ("c", 2, "2024-01-02")]
    assert state(log.read()) == want
    assert state(log.read([dt.date(2024, 1, 1)])) == [("b", 1, "2024-01-01")]
    assert [str(d) for d in log.days_of_keys(rows(spark, [("a", 0, "2024-02-01")]))] == ["2024-01-01", "2024-01-03"]
    assert log.fold()["commits"] == 2
    assert state(log.read()) == state(spark.read.parquet(log.path)) == want and log.commits() == []
    log.append(rows(spark, [("a", 3, "2024-01-01")]), "batch", "2")
    assert state(log.read()) == [("a", 3, "2024-01-01"), *want[1:]]
    assert [str(d) for d in log.days_of_keys(rows(spark, [("c", 0, "2024-02-01")]))] == ["2024-01-02"]


def test_a_batch_written_again_is_one_commit(spark, log):
    assert log.append(rows(spark, [("a", 1, "2024-01-01")]), "stream", 7)
    assert not log.append(rows(spark, [("a", 9, "2024-01-01")]), "stream", 7)
    files.delete_path(spark, f"{log.root}/commit={log.commits()[0].name}/_SUCCESS")  # the write did not end
    assert log.append(rows(spark, [("a", 2, "2024-01-01")]), "stream", 7)
    assert state(log.read()) == [("a", 2, "2024-01-01")] and len(log.commits()) == 1


def test_a_fold_waits_for_an_unfinished_commit(spark, log):
    log.append(rows(spark, [("a", 1, "2024-01-01")]), "batch", "1")
    files.make_folder(spark, f"{log.root}/commit={log.commits()[0].stamp + 1:015d}.stream.3")
    log.append(rows(spark, [("a", 5, "2024-01-02")]), "batch", "2")
    out = log.fold()
    assert (out["commits"], out["waiting"]) == (1, 2)
    assert state(log.read()) == [("a", 5, "2024-01-02")]
    assert log.fold(given_up_hours=0)["commits"] == 1  # its writer is taken to be dead
    assert state(spark.read.parquet(log.path)) == [("a", 5, "2024-01-02")]


def test_a_fold_that_fails_can_be_run_again(spark, log, monkeypatch):
    log.append(rows(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")]), "batch", "1")
    log.fold()
    log.append(rows(spark, [("a", 2, "2024-01-02")]), "stream", "1")
    want = [("a", 2, "2024-01-02"), ("b", 1, "2024-01-01")]
    with monkeypatch.context() as m:
        m.setattr(rl.files, "delete_path", lambda *_: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            log.fold()
    assert state(log.read()) == want
    log.fold()
    assert state(spark.read.parquet(log.path)) == want and log.commits() == []


def test_an_upsert_cut_off_between_append_and_rewrite_loses_no_row(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/silver"
    w.merge_upsert(spark, rows(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")]), path)
    source = rows(spark, [("a", 2, "2024-01-05")])
    with monkeypatch.context() as m:
        m.setattr(w, "Observation", lambda *_: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            w.merge_upsert(spark, source, path)
    assert ("a", 2, "2024-01-05") in state(spark.read.parquet(path))
    w.merge_upsert(spark, source, path)
    assert state(spark.read.parquet(path)) == [("a", 2, "2024-01-05"), ("b", 1, "2024-01-01")]


def test_empty_commits_and_empty_tables(spark, log):
    assert not log.exists()
    log.append(rows(spark, []), "stream", "0")
    assert not log.exists() and log.days_of_keys(rows(spark, [("a", 1, "2024-01-01")])) == []
    log.append(rows(spark, [("a", 1, "2024-01-01")]), "stream", "1")
    assert log.exists() and state(log.read()) == [("a", 1, "2024-01-01")]
    assert log.fold()["commits"] == 2


def test_writers_rewrite_no_day(spark, tmp_root):
    log = silver_log(spark, Lake(f"{tmp_root}/lake"))
    queries.two_writers(spark, SMOKE_SF, log)
    before = table_files(spark, log.path)
    log.append(queries.silver_df(spark, SMOKE_SF, "stream"), "stream", "9")
    assert table_files(spark, log.path) == before and before
    assert {r["source"] for r in log.read().select("source").distinct().collect()} == {"stream"}
