"""Micro-batches cut off between sinks, bad first batches, moved days, shifted dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMOKE_SF, event, lines
from eventlake import queries
from eventlake.operators.bronze import split_valid_quarantine, to_bronze
from eventlake.plans import jobs
from eventlake.sinks import files
from eventlake.sinks.ledger import KEPT, Ledger
from eventlake.sources import fixtures
from eventlake.streaming.ingest import SINKS, file_source, start_ingestion


def ids(df):
    return sorted(r[0] for r in df.select("event_id").collect())


def test_a_replayed_batch_goes_on_where_it_failed(spark):
    lake, failures = queries.replayed_lake(spark, SMOKE_SF)
    assert failures == len(SINKS)
    assert ids(jobs.read_silver(spark, lake)) == ids(queries.silver_df(spark, SMOKE_SF)) == ids(spark.read.parquet(lake.bronze_stream))
    delivered = fixtures.raw_event_lines(spark, SMOKE_SF, with_day=True)
    early = delivered.filter(F.col("day") <= F.to_date(F.lit(queries.REPLAY_UNTIL)))
    bad = sum(split_valid_quarantine(to_bronze(x.select("value"), "s"))[1].count() for x in (delivered, early))
    assert spark.read.parquet(lake.quarantine).count() == bad


def test_ledger_runs_a_sink_once_and_forgets_old_batches(spark, tmp_root):
    ledger, calls = Ledger(spark, f"{tmp_root}/ledger", "s"), []
    for _ in range(2):
        assert ledger.once(3, "silver", lambda: calls.append(1) or {"rows": 5}) == {"rows": 5}
    assert calls == [1] and ledger.done(3, "bronze") is None
    assert Ledger(spark, f"{tmp_root}/ledger", "other").done(3, "silver") is None
    ledger.once(3 + KEPT, "silver", dict)
    ledger.forget(3 + KEPT)
    assert ledger.done(3, "silver") is None and ledger.done(3 + KEPT, "silver") == {}


def test_equal_bad_lines_of_two_streams_are_all_kept(spark, tmp_root):
    lake, landing = jobs.Lake(f"{tmp_root}/lake"), f"{tmp_root}/landing"
    lines(spark, ["broken", "broken", event(id="1")]).coalesce(1).write.text(landing)
    for name in ("one", "two"):  # each has a batch 0 of its own
        start_ingestion(spark, file_source(spark, landing, 1), lake, f"{tmp_root}/{name}").awaitTermination()
    assert spark.read.parquet(lake.quarantine).count() == 4
    assert jobs.read_silver(spark, lake).count() == 1


def test_a_first_batch_of_bad_lines_does_not_stop_the_stream(spark, tmp_root):
    lake, landing = jobs.Lake(f"{tmp_root}/lake"), f"{tmp_root}/landing"
    lines(spark, ["broken", event(id=None)]).coalesce(1).write.text(f"{landing}/1")
    run = lambda: start_ingestion(spark, file_source(spark, f"{landing}/*", 1), lake, f"{tmp_root}/ckpt").awaitTermination()
    run()
    assert spark.read.parquet(lake.quarantine).count() == 2 and not jobs.silver_log(spark, lake).exists()
    lines(spark, [event(id="7")]).coalesce(1).write.text(f"{landing}/2")
    run()
    assert ids(jobs.read_silver(spark, lake)) == ["7"]


def test_gold_of_the_day_an_event_left_is_computed_again(spark):
    lake, report = queries.moved_lake(spark, SMOKE_SF)
    silver = jobs.read_silver(spark, lake)
    left = report.metrics["silver"]["days"]
    moved = [r["event_date"] for r in silver.where("source = 'batch'").select("event_date").distinct().collect()]
    assert left and min(left) < min(moved)
    gold = spark.read.parquet(lake.gold("event_type_summary_hourly"))
    want = sorted(map(tuple, silver.groupBy("event_date").count().collect()))
    assert sorted(map(tuple, gold.groupBy("event_date").agg(F.sum("event_count")).collect())) == want


def test_results_do_not_hang_on_the_fixtures_dates(spark, tmp_root):
    """All events 45 days later: the same rows, 45 days later."""
    shifted = f"{tmp_root}/sf"
    for name in ("events", "part"):
        df = fixtures.read_driver(spark, SMOKE_SF, name)
        df = df.withColumn("ts", F.col("ts") + F.expr("INTERVAL 45 DAYS")) if name == "events" else df
        df.coalesce(1).write.parquet(f"{shifted}/{name}.parquet")
    for query in ("silver_events", "event_type_summary_hourly", "language_trends_daily", "vw_trending_repos", "vw_dq_health", "hour_slots", "lake_trending_repos"):
        there, here = (queries.QUERIES[query](spark, sf) for sf in (shifted, SMOKE_SF))
        back = {"event_date": F.date_sub("event_date", 45), "slot_date": F.date_sub("slot_date", 45)}
        there = there.withColumns({c: x for c, x in back.items() if c in there.columns}).drop("event_timestamp", "slot_start", "file_name", "folder")
        here = here.drop("event_timestamp", "slot_start", "file_name", "folder")
        assert sorted(map(str, there.collect())) == sorted(map(str, here.collect())), query


def test_a_rerun_of_a_check_replaces_its_results(spark, tmp_root):
    lake = jobs.Lake(f"{tmp_root}/lake")
    valid = queries.bronze_valid_df(spark, SMOKE_SF)
    for _ in range(2):
        jobs.run_quality(spark, lake, "bronze", valid, "r1", "2024-01-15")
    jobs.run_quality(spark, lake, "bronze", valid, "r2", "2024-01-15")
    assert sorted(set(files.list_children(spark, lake.dq_results)) - {"_SUCCESS"}) == ["delivery=r1-bronze", "delivery=r2-bronze"]
    per = spark.read.parquet(lake.dq_results).groupBy("run_id").count().collect()
    assert len({r["count"] for r in per}) == 1 and len(per) == 2
