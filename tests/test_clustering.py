"""Z-order clustering, one-scan gold and sketches over hours."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SMOKE_SF
from eventlake import queries
from eventlake.operators import clustering, gold, serving
from eventlake.sinks import files, writers


def skipped(spark, folder, column, value) -> tuple[int, int]:
    """(row groups that statistics rule out, row groups) for a filter column = value."""
    out = total = 0
    for name in files.list_children(spark, folder):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{folder}/{name}".removeprefix("file:")).metadata
            for g in range(meta.num_row_groups):
                stats = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column)
                total, out = total + 1, out + (not stats.min <= value <= stats.max)
    return out, total


def test_each_column_alone_skips(spark, tmp_root):
    path, day = f"{tmp_root}/silver", "2024-01-05"
    rows = spark.range(8000).select(F.col("id").cast("string").alias("event_id"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("repo_id"),
                                    F.element_at(F.array(*[F.lit(t) for t in ("Fork", "Issues", "Push", "Watch")]), (F.pmod(F.hash("id"), F.lit(4)) + 1).cast("int")).alias("event_type"),
                                    F.lit(day).cast("date").alias("event_date"))
    writers.create_table(rows, path)
    size = writers.path_bytes(spark, f"{path}/event_date={day}")
    writers.compact_partition(spark, path, day, ["repo_id", "event_type"], target_file_bytes=size // 32)
    folder = f"{path}/event_date={day}"
    for column, value in (("repo_id", 77), ("event_type", "Push")):
        out, total = skipped(spark, folder, column, value)
        assert total >= 12 and out >= total * 0.5, (column, out, total)
    assert spark.read.parquet(path).select("event_id").distinct().count() == 8000


def test_ranks_and_bounds(spark):
    df = spark.createDataFrame([(str(i), i, None if i % 3 else "a") for i in range(1000)], "k string, v int, w string")
    bounds = clustering.quantiles(df, ["v", "w"], "k", bits=3)
    assert len(bounds["v"]) == 7 and bounds["w"] == []
    ranks = df.select("v", clustering.rank_among(F.col("v"), bounds["v"]).alias("r")).collect()
    assert all(r["r"] == sum(b <= r["v"] for b in bounds["v"]) for r in ranks)
    assert df.limit(0).select(clustering.z_value(df.limit(0), ["v", "w"], "k")).count() == 0


def test_gold_sets_scan_silver_once(spark, tmp_root):
    path = f"{tmp_root}/silver"
    writers.create_table(queries.silver_df(spark, SMOKE_SF), path)
    plan = gold.gold_sets(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "payload" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_sketches_add_up_over_hours(spark):
    # an actor comes back in every hour
    events = spark.range(24 * 3000).select((F.col("id") % 24).cast("int").alias("event_hour"), F.lit("2024-01-01").cast("date").alias("event_date"), F.lit("r").alias("repo_name"), F.floor(F.col("id") / 24).alias("actor_id"))
    row = serving.contributors_rollup(gold.hot_repos_sketches(events)).first()
    assert row["contributors_summed"] == 72000 and row["events"] == 72000
    assert abs(row["contributors"] - 3000) <= 150
