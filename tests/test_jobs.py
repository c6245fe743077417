from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_SF
from eventlake import queries
from eventlake.operators import quality
from eventlake.plans import jobs
from eventlake.sources import fixtures


def _landing(spark, root):
    parts = ["year", "month", "day", "hour"]
    lines = fixtures.raw_event_lines(spark, SMOKE_SF, with_slot=True)
    lines.write.partitionBy(*parts).option("compression", "gzip").text(root)


def test_backfill_end_to_end_and_rerun(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    _landing(spark, landing)
    lake = jobs.Lake(f"{tmp_root}/lake")
    for i in (1, 2):
        jobs.refresh_dimension(spark, lake, fixtures.repo_snapshot(spark, SMOKE_SF, i), queries.SNAPSHOT_TS[i])
    rep = jobs.backfill(spark, lake, landing, "2024-01-01 00:00:00", "2024-01-31 23:00:00", run_id="r1")
    assert rep.metrics["bronze"]["inserted"] > 0
    silver = jobs.read_silver(spark, lake)
    expected = queries.silver_df(spark, SMOKE_SF)
    assert silver.count() == expected.count()
    # rerun of the same window converges
    rep2 = jobs.backfill(spark, lake, landing, "2024-01-01 00:00:00", "2024-01-31 23:00:00", run_id="r2")
    assert rep2.metrics["bronze"]["inserted"] == 0
    assert rep2.metrics["bronze"]["quarantined"] == 0
    assert jobs.read_silver(spark, lake).count() == expected.count()
    gold = {p: spark.read.parquet(lake.gold(p)).count() for p in
            ["event_type_summary_hourly", "hot_repos_hourly", "contributor_activity_daily",
             "language_trends_daily", "topic_trends_daily"]}
    assert all(n > 0 for n in gold.values())
    dq = spark.read.parquet(lake.dq_results)
    assert set(r["layer"] for r in dq.select("layer").distinct().collect()) == {"bronze", "silver", "gold"}
    assert dq.filter((F.col("severity") == "critical") & ~F.col("passed")).count() == 0
    views = jobs.register_lake_views(spark, lake)
    assert len(views) == 10
    top = spark.sql("SELECT * FROM vw_trending_repos ORDER BY contributors DESC, events DESC, repo_name LIMIT 20")
    assert top.count() == 20
    assert spark.sql("SELECT sum(events) AS n FROM vw_hourly_activity").first()["n"] == expected.count()


def test_critical_failure_stops_the_chain(spark, tmp_root):
    lake = jobs.Lake(f"{tmp_root}/lake")
    empty = queries.bronze_valid_df(spark, SMOKE_SF).limit(0)
    with pytest.raises(quality.CriticalQualityFailure, match="row_count_min"):
        jobs.run_quality(spark, lake, "bronze", empty, "r1", "2024-01-15")
    # results are recorded before the gate raises
    assert spark.read.parquet(lake.dq_results).filter(~F.col("passed")).count() >= 1


def test_dimension_refresh_versions(spark, tmp_root):
    lake = jobs.Lake(f"{tmp_root}/lake")
    r1 = jobs.refresh_dimension(spark, lake, fixtures.repo_snapshot(spark, SMOKE_SF, 1), queries.SNAPSHOT_TS[1])
    r2 = jobs.refresh_dimension(spark, lake, fixtures.repo_snapshot(spark, SMOKE_SF, 2), queries.SNAPSHOT_TS[2])
    assert (r1["version"], r2["version"]) == (1, 2)
    assert r2["rows_total"] == r2["current"] + r2["historical"]
    assert r2["historical"] > 0 and r2["closed"] == r2["historical"]
    # a rerun of the same snapshot changes nothing
    r3 = jobs.refresh_dimension(spark, lake, fixtures.repo_snapshot(spark, SMOKE_SF, 2), queries.SNAPSHOT_TS[2])
    assert (r3["rows_total"], r3["closed"]) == (r2["rows_total"], 0)
    full = jobs.read_dimension(spark, lake)
    expected = queries.dimension(spark, SMOKE_SF, 2)
    cols = expected.columns
    assert sorted(tuple(r) for r in full.select(*cols).collect()) == sorted(tuple(r) for r in expected.collect())


def test_maintain_day_keeps_content(spark, tmp_root):
    from eventlake.sinks import writers

    lake = jobs.Lake(f"{tmp_root}/lake")
    silver = queries.silver_df(spark, SMOKE_SF)
    writers.create_table(silver, lake.silver)
    writers.overwrite_table(queries.gold.event_type_summary_hourly(silver), lake.gold("event_type_summary_hourly"))
    before = spark.read.parquet(lake.silver).count(), spark.read.parquet(lake.gold("event_type_summary_hourly")).count()
    out = jobs.maintain_day(spark, lake, "2024-01-05")
    assert set(out) == {"silver/events", "gold/event_type_summary_hourly"}
    after = spark.read.parquet(lake.silver).count(), spark.read.parquet(lake.gold("event_type_summary_hourly")).count()
    assert before == after


def test_dq_job_scopes_to_the_day(spark, tmp_root):
    from eventlake.sinks import writers

    lake = jobs.Lake(f"{tmp_root}/lake")
    writers.create_table(queries.silver_df(spark, SMOKE_SF), lake.silver)
    res = {r["check_name"]: r for r in jobs.dq_job(spark, lake, "silver", "2024-01-05").collect()}
    day_rows = spark.read.parquet(lake.silver).filter("event_date = DATE'2024-01-05'").count()
    assert res["row_count_min"]["observed"] == str(day_rows)
    assert res["row_count_min"]["execution_date"] == "2024-01-05"
    with pytest.raises(quality.CriticalQualityFailure):
        jobs.dq_job(spark, lake, "silver", "2030-01-01")  # no rows that day
