"""What must not grow with the tables: what is sent to the driver, and a snapshot's refusal."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_SF
from eventlake import queries
from eventlake.plans import jobs
from eventlake.sinks.key_sketch import KeySketch

REPO = "repo_id long, repo_name string, primary_language string, stargazers_count int, forks_count int, open_issues_count int, topics string, description string, is_fork boolean, size_kb int"


def first_plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


GUESSED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture
def threshold(spark):
    """Sets the session's threshold; as it was afterwards."""

    def put(value):
        spark.conf.unset(MEASURED)
        spark.conf.set(GUESSED, value)

    held = spark.conf.get(GUESSED), spark.conf.get(MEASURED, None)
    yield put
    put(held[0])
    if held[1] is not None:
        spark.conf.set(MEASURED, held[1])


def test_parsed_lines_are_not_broadcast_by_a_guess(spark, threshold):
    """Before anything is measured, a line of JSON counts as 20 bytes."""
    threshold("16k")
    for name in ("language_trends_daily", "topic_trends_daily"):
        for _ in range(2):  # the settings may be applied again
            assert "BroadcastHashJoin" not in first_plan(queries.QUERIES[name](spark, SMOKE_SF))
    assert (spark.conf.get(GUESSED), spark.conf.get(MEASURED)) == ("256", "16k")
    threshold("-1")
    queries.apply_job_conf(spark)
    assert (spark.conf.get(GUESSED), spark.conf.get(MEASURED)) == ("-1", "-1")


def test_a_probe_deals_keys_once_for_each_size_of_a_sketch(spark, tmp_root, threshold):
    """Not once for each day, and no day's bits are sent to the driver."""
    threshold("-1")
    sketch = KeySketch(spark, f"{tmp_root}/t", "event_id", "event_date")
    days = spark.range(0, 40).select(F.col("id").cast("string").alias("event_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("event_date"))
    sketch.add(days)
    found = sketch.suspects(days)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "inline(" not in plan and plan.count("Generate explode([1])") == 1
    assert first_plan(found).count("BroadcastHashJoin") == 1  # the list of sketches
    assert {(str(i), f"2024-01-{1 + i % 20:02d}") for i in range(40)} <= {(r["key"], r["day"]) for r in found.collect()}


def test_a_snapshot_may_hold_several_records_of_a_key(spark, tmp_root):
    """As the fixture's second one does past a million parts: both are versions."""
    lake = jobs.Lake(tmp_root)
    repo = lambda key, name, stars=1: (key, name, "Go", stars, 1, 1, "", "", False, 1)
    both = spark.createDataFrame([repo(1, "a/one"), repo(1, "b/other"), repo(2, "a/two")], REPO)
    with pytest.raises(ValueError):
        jobs.refresh_dimension(spark, lake, both, "2024-01-16T00:00:00Z")
    first = spark.createDataFrame([repo(1, "a/one"), repo(2, "a/two", 7)], REPO)
    jobs.refresh_dimension(spark, lake, first, "2024-01-15T00:00:00Z", several=True)
    jobs.refresh_dimension(spark, lake, both, "2024-01-16T00:00:00Z", several=True)
    rows = {(r["repo_id"], r["repo_name"], r["is_current"]) for r in jobs.read_dimension(spark, lake).collect()}
    # the contract's SQL: kept by the record that is equal, closed by the one that is not
    assert rows == {(1, "a/one", True), (1, "a/one", False), (1, "b/other", True), (2, "a/two", False), (2, "a/two", True)}
    for bad in ([repo(1, "a/one"), repo(1, "a/one")], [repo(None, "a/one")]):
        with pytest.raises(ValueError):
            jobs.refresh_dimension(spark, lake, spark.createDataFrame(bad, REPO), "2024-01-17T00:00:00Z", several=True)
