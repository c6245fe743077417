from __future__ import annotations

import pytest

import datetime as dt

from pyspark.sql import functions as F

from eventlake.sinks import writers as w

SCHEMA = "event_id string, v int, event_date date"


def _df(spark, rows):
    return spark.createDataFrame([(i, v, dt.date.fromisoformat(d)) for i, v, d in rows], SCHEMA)


def _state(spark, path):
    return sorted((r["event_id"], r["v"], str(r["event_date"])) for r in spark.read.parquet(path).collect())


def test_insert_only_merge_is_idempotent(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    assert w.merge_insert_only(spark, _df(spark, [("a", 1, "2024-01-01")]), path)["created"]
    src = _df(spark, [("a", 2, "2024-01-01"), ("b", 2, "2024-01-02")])
    assert w.merge_insert_only(spark, src, path)["inserted"] == 1
    assert w.merge_insert_only(spark, src, path)["inserted"] == 0
    assert _state(spark, path) == [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")]


def test_upsert_updates_and_inserts(spark, tmp_root):
    path = f"{tmp_root}/silver"
    w.merge_upsert(spark, _df(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), path)
    src = _df(spark, [("a", 2, "2024-01-01"), ("c", 2, "2024-01-01")])
    res = w.merge_upsert(spark, src, path)
    assert (res["partitions"], res["appended"]) == (1, 0)
    w.merge_upsert(spark, src, path)  # rerun converges
    assert _state(spark, path) == [("a", 2, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 2, "2024-01-01")]


def test_upsert_of_new_keys_only_appends(spark, tmp_root):
    path = f"{tmp_root}/silver"
    w.merge_upsert(spark, _df(spark, [("a", 1, "2024-01-01")]), path)
    res = w.merge_upsert(spark, _df(spark, [("b", 1, "2024-01-01"), ("c", 1, "2024-01-02")]), path)
    assert (res["partitions"], res["rewritten"], res["appended"]) == (0, 0, 2)
    assert _state(spark, path) == [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01"), ("c", 1, "2024-01-02")]


def test_upsert_moves_row_between_days(spark, tmp_root):
    path = f"{tmp_root}/silver"
    w.merge_upsert(spark, _df(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), path)
    res = w.merge_upsert(spark, _df(spark, [("a", 5, "2024-01-03")]), path)
    assert [str(d) for d in res["days"]] == ["2024-01-01"]
    assert _state(spark, path) == [("a", 5, "2024-01-03"), ("b", 1, "2024-01-02")]
    assert not w.path_exists(spark, f"{path}/event_date=2024-01-01")


def test_replace_partition_and_empty_replace(spark, tmp_root):
    path = f"{tmp_root}/gold"
    w.overwrite_table(_df(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), path)
    w.replace_partition(_df(spark, [("x", 9, "2024-01-01")]), path, "2024-01-01")
    w.replace_partition(_df(spark, [("x", 9, "2024-01-01")]), path, "2024-01-02")  # nothing for that day
    assert _state(spark, path) == [("x", 9, "2024-01-01")]


def test_overwrite_reads_its_own_table_and_a_failed_one_leaves_it(spark, tmp_root):
    path = f"{tmp_root}/gold"
    w.overwrite_table(_df(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), path)
    own = spark.read.parquet(path).withColumn("event_date", F.date_add("event_date", 5)).where("event_date > '2024-01-06'")
    assert w.overwrite_table(own, path) == 1
    assert _state(spark, path) == [("b", 1, "2024-01-07")]
    broken = spark.read.parquet(path).withColumn("event_date", F.raise_error(F.lit("stop")).cast("date"))
    with pytest.raises(Exception, match="stop"):
        w.overwrite_table(broken, path)
    assert _state(spark, path) == [("b", 1, "2024-01-07")]
    assert w.list_children(spark, tmp_root) == ["gold"]  # nothing is left beside it


def test_overwrite_partitions_keeps_other_days(spark, tmp_root):
    path = f"{tmp_root}/gold"
    w.overwrite_table(_df(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), path)
    w.overwrite_partitions(_df(spark, [("c", 3, "2024-01-02")]), path)
    assert _state(spark, path) == [("a", 1, "2024-01-01"), ("c", 3, "2024-01-02")]


def test_versioned_overwrite_reads_its_own_input(spark, tmp_root):
    root = f"{tmp_root}/dim"
    assert w.read_versioned(spark, root) is None
    w.write_version(spark, spark.createDataFrame([(1,), (2,)], "k long"), root)
    cur = w.read_versioned(spark, root)
    w.write_version(spark, cur.withColumn("k", F.col("k") + 10), root)
    w.write_version(spark, w.read_versioned(spark, root).withColumn("k", F.col("k") + 10), root, retain_hours=0)
    assert sorted(r["k"] for r in w.read_versioned(spark, root).collect()) == [21, 22]
    assert sorted(n for n in w.list_children(spark, root) if n.startswith("v=")) == ["v=2", "v=3"]


def test_insert_only_merge_matches_keys_of_every_day(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    w.merge_insert_only(spark, _df(spark, [("a", 1, "2024-01-01")]), path)
    assert w.merge_insert_only(spark, _df(spark, [("a", 2, "2024-01-02")]), path)["inserted"] == 0
    assert _state(spark, path) == [("a", 1, "2024-01-01")]


def test_an_empty_first_batch_and_a_failed_create_do_not_block(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    assert w.merge_insert_only(spark, _df(spark, []), path)["inserted"] == 0
    assert not w.table_exists(spark, path)
    fs, p = w.fs_path(spark, f"{path}/_temporary/0/task_left_over")
    fs.mkdirs(p)
    assert w.merge_upsert(spark, _df(spark, [("a", 1, "2024-01-01")]), path)["created"]
    assert w.merge_insert_only(spark, _df(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), path)["inserted"] == 1


def test_a_failed_version_does_not_block_the_next(spark, tmp_root):
    root = f"{tmp_root}/dim"
    w.write_version(spark, spark.createDataFrame([(1,)], "k long"), root)
    fs, p = w.fs_path(spark, f"{root}/v=2/_temporary/0")
    fs.mkdirs(p)
    assert w.write_version(spark, spark.createDataFrame([(2,)], "k long"), root)["version"] == 3
    assert [r["k"] for r in w.read_versioned(spark, root).collect()] == [2]
    assert w.read_versioned(spark, root) is not None and w.path_exists(spark, f"{root}/v=1")


def test_quarantine_append_keeps_every_line_and_is_replay_safe(spark, tmp_root):
    path = f"{tmp_root}/quarantine"
    q = spark.createDataFrame(
        [("1", "f", None, "missing_repo_id", "{bad}"), ("1", "f", None, "missing_repo_id", "{bad}")],
        "event_id string, source_file string, ingestion_timestamp timestamp, dq_reason string, raw_record string",
    )
    assert w.append_quarantine(spark, q, path, "micro-batch 0") == 2
    assert w.append_quarantine(spark, q, path, "micro-batch 0") == 0
    assert w.append_quarantine(spark, q, path, "micro-batch 1") == 2
    assert spark.read.parquet(path).count() == 4


def test_compaction_keeps_content_and_sorts(spark, tmp_root):
    path = f"{tmp_root}/silver"
    rows = [(f"e{i}", i % 7, "2024-01-01") for i in range(50)] + [("z", 1, "2024-01-02")]
    w.create_table(_df(spark, rows).repartition(5), path)
    before = _state(spark, path)
    n = w.compact_partition(spark, path, "2024-01-01", ["v"], target_file_bytes=1 << 30)
    assert n == 1
    assert _state(spark, path) == before
    files = [f for f in w.list_children(spark, f"{path}/event_date=2024-01-01") if f.endswith(".parquet")]
    assert len(files) == 1
    vs = [r["v"] for r in spark.read.parquet(f"{path}/event_date=2024-01-01").collect()]
    assert vs == sorted(vs)


def test_two_writers_parse_once_and_dedup_once(spark):
    from conftest import SMOKE_SF
    from eventlake.queries import two_writers

    class Log:
        plans = []

        def append(self, rows, writer, batch):
            done = rows._jdf.queryExecution()
            self.plans.append((done.analyzed().toString().count("Aggregate ["), "InMemoryTableScan" in done.executedPlan().toString()))

        def fold(self):
            pass

    two_writers(spark, SMOKE_SF, Log())
    assert Log.plans == [(1, True)] * 5
