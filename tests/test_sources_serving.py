from __future__ import annotations


from eventlake.operators import ranking, serving
from eventlake.sources.landing import hour_slot, hour_slots
from eventlake.sources.snapshots import normalize_repo_records
from eventlake.schemas import REPO_API_JSON


def test_hour_slots_inclusive_and_names(spark):
    rows = hour_slots(spark, "2024-01-15 22:10:00", "2024-01-16 02:00:00").orderBy("slot_start").collect()
    assert len(rows) == 5
    assert rows[0]["file_name"] == "2024-01-15-22.json.gz"
    assert rows[-1]["file_name"] == "2024-01-16-2.json.gz"  # hour not padded in the name
    assert rows[-1]["folder"] == "year=2024/month=01/day=16/hour=02"  # padded in the folder


def test_hourly_slot_offset(spark):
    r = hour_slot(spark, "2024-01-15 10:45:00", -2).collect()[0]
    assert r["file_name"] == "2024-01-15-8.json.gz" and str(r["slot_date"]) == "2024-01-15"


def test_snapshot_normalisation(spark):
    recs = spark.createDataFrame(
        [(1, "a/b", "Go", 5, 1, 0, ["web", "api"], "d", None, 10), (2, "c/d", None, 1, 0, 0, None, None, True, 3)],
        REPO_API_JSON,
    )
    out = {r["repo_id"]: r for r in normalize_repo_records(recs).collect()}
    assert out[1]["topics"] == "api,web" and out[1]["is_fork"] is False and out[1]["size_kb"] == 10
    assert out[2]["topics"] == "" and out[2]["is_fork"] is True and out[2]["primary_language"] is None


def _contrib(spark):
    return spark.createDataFrame(
        [
            ("2024-01-01", 1, "alice", False, 5, 2, 1, 0),
            ("2024-01-02", 1, "alice", False, 3, 1, 0, 1),
            ("2024-01-01", 2, "bot[bot]", True, 9, 1, 4, 0),
            ("2024-01-01", 3, None, None, 2, 1, 0, 0),
            ("2024-01-01", 4, "bob", False, 1, 1, 0, 0),
        ],
        "event_date string, actor_id long, actor_login string, is_bot boolean, total_events long, "
        "repos_touched long, prs_opened long, issues_opened long",
    )


def test_top_contributors_excludes_bots_nulls_and_idle(spark):
    out = serving.top_contributors(_contrib(spark)).collect()
    assert [(r["actor_login"], r["prs_opened"], r["issues_opened"], r["repos"], r["events"]) for r in out] == [
        ("alice", 1, 1, 3, 8)
    ]


def test_bot_vs_human_null_flag_is_second_human_row(spark):
    rows = sorted((r["actor_kind"], r["events"]) for r in serving.bot_vs_human(_contrib(spark)).collect())
    assert rows == [("bot", 9), ("human", 2), ("human", 9)]


def test_rankings_tie_break(spark):
    df = spark.createDataFrame([("b", 5, 1), ("a", 5, 1), ("c", 9, 0)], "repo_name string, contributors long, events long")
    assert [r["repo_name"] for r in serving.top_trending(df, 2).collect()] == ["c", "a"]


def test_enrichment_targets(spark):
    rows = [(1, "r/one", a, False) for a in (1, 2, 3)] + [(2, "r/two", a, False) for a in (1, 2)] + \
           [(3, "r/three", a, a == 3) for a in (1, 2, 3, 3)]
    silver = spark.createDataFrame(rows, "repo_id long, repo_name string, actor_id long, is_bot boolean")
    out = ranking.enrichment_targets(silver, batch_size=10).collect()
    assert [(r["repo_id"], r["actors"], r["activity"]) for r in out] == [(1, 3, 3)]


def test_register_views(spark):
    tables = {"silver_events": spark.createDataFrame([("batch",), ("stream",), ("batch",)], "source string")}
    assert serving.register_views(spark, tables) == ["vw_batch_vs_stream"]
    got = {r["source"]: r["events"] for r in spark.sql("SELECT * FROM vw_batch_vs_stream").collect()}
    assert got == {"batch": 2, "stream": 1}


def test_kpi_totals(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "repo_id long, actor_id long")
    r = serving.kpi_totals(df).collect()[0]
    assert (r["total_events"], r["distinct_repos"], r["distinct_contributors"]) == (3, 2, 2)


def test_whole_results_come_in_order(spark):
    from conftest import SMOKE_SF
    from eventlake import queries

    types = [(-r["events"], r["event_type"]) for r in queries.QUERIES["event_types_ordered"](spark, SMOKE_SF).collect()]
    hours = [r["event_hour"] for r in queries.QUERIES["hours_ordered"](spark, SMOKE_SF).collect()]
    layers = [r["layer"] for r in queries.QUERIES["dq_health_ordered"](spark, SMOKE_SF).collect()]
    assert len(types) > 3 and types == sorted(types) and hours == sorted(set(hours)) and layers == ["bronze", "gold", "silver"]
