"""Registered queries against their DuckDB oracles on the smallest driver tables."""

from __future__ import annotations

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare_oracles import canon, duck  # noqa: E402
from conftest import SMOKE_SF  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FAST = [
    "bronze_valid", "bronze_quarantine", "quarantine_reasons", "silver_events", "event_type_summary_hourly",
    "hot_repos_hourly", "contributor_activity_daily", "language_trends_daily", "topic_trends_daily",
    "scd2_initial", "scd2_second_snapshot", "scd2_version_stats", "snapshot_normalise", "enrichment_targets",
    "vw_dq_health", "vw_bot_vs_human", "vw_batch_vs_stream", "trending_top20", "languages_top15",
    "topics_top20", "contributors_top20", "dq_bronze", "dq_silver", "dq_declarative", "hour_slots",
    "target_snapshot", "batch_job_metrics", "lake_trending_repos", "lake_batch_vs_stream",
    "merge_upsert", "replace_day", "merge_insert_only", "compact_day", "stream_dedup_watermark",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_SF)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "double": "DOUBLE"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMOKE_SF)
    a, ac = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    b, bc = canon([d[0] for d in cur.description], cur.fetchall())
    assert ac == bc
    assert Counter(a) == Counter(b)
    rel = con.sql(entry.oracle_sql()[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == duck_types


def test_every_query_of_the_event_engine_has_an_oracle():
    from eventlake.oracles import oracle_sql
    from eventlake.queries import QUERIES

    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["repo_name", "contributors", "events", "stars", "forks"]
    assert df.count() == 20
