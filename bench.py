"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ..., ...}

Each query is run to completion with the no-op sink (full computation, no
collection to the driver).  ``comparisons`` times the designs chosen here
against their naive forms on the same data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bronze_valid",
    "bronze_quarantine",
    "silver_events",
    "event_type_summary_hourly",
    "hot_repos_hourly",
    "contributor_activity_daily",
    "language_trends_daily",
    "topic_trends_daily",
    "scd2_second_snapshot",
    "enrichment_targets",
    "trending_top20",
    "contributors_top20",
    "kpi_totals",
    "vw_dq_health",
    "merge_upsert",
    "stream_available_now",
    "batch_job_gold",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def comparisons(spark, sf_dir: str) -> dict:
    """Chosen design vs naive form, same input (seconds)."""
    from pyspark.sql import functions as F

    from eventlake import queries
    from eventlake.operators import quality
    from eventlake.sinks import writers
    from eventlake.session import scratch_dir
    from eventlake.sources import fixtures

    out = {}
    raw_path = scratch_dir(spark, "bench-raw")
    fixtures.raw_event_lines(spark, sf_dir).write.text(raw_path)
    raw = spark.read.text(raw_path)

    def parse_once():
        from eventlake.operators.bronze import to_bronze

        _run(to_bronze(raw, "f").drop("_raw"))

    def parse_per_field():
        g = lambda p: F.get_json_object("value", p)
        _run(raw.select(g("$.id"), g("$.type"), g("$.actor.id"), g("$.actor.login"), g("$.repo.id"),
                        g("$.repo.name"), g("$.payload"), g("$.created_at")))

    out["parse_json_tuple_once"] = _timed(parse_once)
    out["parse_get_json_object_x8"] = _timed(parse_per_field)

    silver_path = scratch_dir(spark, "bench-silver")
    writers.create_table(queries.silver_df(spark, sf_dir), silver_path)
    silver = spark.read.parquet(silver_path)
    suite = quality.layer_suite("silver")
    out["dq_suite_one_pass"] = _timed(lambda: quality.run_checks(silver, suite).collect())

    def per_check():
        for c in suite:
            quality.run_checks(silver, [c]).collect()

    out["dq_suite_job_per_check"] = _timed(per_check)

    events = queries.silver_df(spark, sf_dir).persist()
    events.count()

    def observed_write():
        writers.create_table(events, scratch_dir(spark, "bench-observed"))

    def count_then_write():
        events.count()
        events.write.partitionBy("event_date").parquet(scratch_dir(spark, "bench-counted"))

    out["write_with_observed_metrics"] = _timed(observed_write)
    out["count_then_write"] = _timed(count_then_write)
    events.unpersist()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from eventlake.queries import QUERIES
    from eventlake.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "16g"})
    # warm-up (JVM, codegen, file listing) — not timed
    _run(QUERIES["quarantine_reasons"](spark, sf_dir))

    times, errors = {}, {}
    for name in HEADLINE:
        try:
            times[name] = _timed(lambda n=name: _run(QUERIES[n](spark, sf_dir)))
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the rest
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    extra = {}
    if os.environ.get("BENCH_COMPARE", "1") == "1":
        try:
            extra = comparisons(spark, sf_dir)
        except Exception as exc:  # noqa: BLE001
            errors["comparisons"] = f"{type(exc).__name__}: {str(exc)[:200]}"
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "comparisons": extra,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
