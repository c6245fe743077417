"""Print the formatted physical plans of the headline operators.

Usage: python tools/show_plans.py [sf_dir]

Shows what the README claims: one json_tuple per line, dedup with partial
aggregation, silver reusing bronze's partitioning, day scans with
PartitionFilters and pruned ReadSchema, trend joins on pre-aggregated events
with a broadcast dimension, single-join SCD2, one-scan DQ suite.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from eventlake import queries  # noqa: E402
from eventlake.operators import gold, quality, scd2  # noqa: E402
from eventlake.schemas import REPO_TRACKED  # noqa: E402
from eventlake.session import build_session, scratch_dir  # noqa: E402
from eventlake.sinks import writers  # noqa: E402
from eventlake.sources import fixtures  # noqa: E402
from eventlake.sources.landing import read_table  # noqa: E402


def show(title: str, df) -> None:
    print(f"\n==== {title} ====")
    df.explain("formatted")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    show("bronze valid rows (json_tuple parse, partial+final dedup)", queries.bronze_valid_df(spark, sf))
    show("silver events (dedup reuses the event_id partitioning)", queries.silver_df(spark, sf))

    path = scratch_dir(spark, "plans-silver")
    writers.create_table(queries.silver_df(spark, sf), path)
    day = read_table(spark, path, "2024-01-05")
    show("gold hourly summary over one day (partition + column pruning)", gold.event_type_summary_hourly(day))
    events = spark.read.parquet(path)
    show("language trends (pre-aggregated events, sized broadcast)",
         gold.language_trends_daily(events, queries.dimension(spark, sf)))
    show("activity cube", gold.activity_cube(events))
    d1 = queries.dimension(spark, sf, 1)
    show("SCD2 upsert (one full outer join)",
         scd2.scd2_upsert(d1, fixtures.repo_snapshot(spark, sf, 2), "repo_id", REPO_TRACKED, "2024-01-16T00:00:00Z"))
    show("silver DQ suite (one scan)", quality.run_checks(events, quality.layer_suite("silver")))
    src = events.filter(F.col("event_date") == F.to_date(F.lit("2024-01-05")))
    target = events.filter(F.col("event_date").isin(writers.partition_values(src)))
    show("insert-only merge anti join (target pruned to the source's days)",
         src.join(target.select("event_id"), "event_id", "left_anti"))


if __name__ == "__main__":
    main()
