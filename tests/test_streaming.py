from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMOKE_SF
from eventlake.operators.bronze import split_valid_quarantine, to_bronze
from eventlake import queries
from eventlake.plans.jobs import Lake, read_silver
from eventlake.sources import fixtures
from eventlake.streaming.ingest import file_source, start_ingestion

CMP = ["event_id", "event_type", "event_action", "actor_id", "repo_id", "push_size", "pr_or_issue_number",
       "pr_merged", "payload", "event_timestamp", "event_date", "event_hour"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*CMP).collect())


def test_stream_equals_batch_and_replay_is_safe(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    lines = fixtures.raw_event_lines(spark, SMOKE_SF, with_day=True)
    lines.repartition("day").write.partitionBy("day").text(f"{landing}/first")
    lake = Lake(f"{tmp_root}/lake")
    ckpt = f"{tmp_root}/ckpt"
    start_ingestion(spark, file_source(spark, f"{landing}/*/*", 1), lake, ckpt).awaitTermination()
    silver = read_silver(spark, lake)
    batch = queries.silver_df(spark, SMOKE_SF)
    assert _rows(silver) == _rows(batch)
    assert {r["source"] for r in silver.select("source").distinct().collect()} == {"stream"}
    q_before = spark.read.parquet(lake.quarantine).count()
    b_before = spark.read.parquet(lake.bronze_stream).count()

    # a second delivery of two days under new file names changes no event; its
    # bad lines are kept, as many as were delivered
    early = lines.filter(F.col("day") <= F.to_date(F.lit("2024-01-02")))
    early.repartition("day").write.partitionBy("day").text(f"{landing}/replay")
    start_ingestion(spark, file_source(spark, f"{landing}/*/*", 1), lake, ckpt).awaitTermination()
    assert _rows(read_silver(spark, lake)) == _rows(batch)
    bad = split_valid_quarantine(to_bronze(early.select("value"), "again"))[1].count()
    assert bad > 0 and spark.read.parquet(lake.quarantine).count() == q_before + bad
    assert spark.read.parquet(lake.bronze_stream).count() == b_before
