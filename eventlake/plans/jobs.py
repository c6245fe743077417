"""Batch jobs (sections 3.1 and 3.3 of the design): bronze, silver, gold,
dimension refresh, each followed by its quality gate (Q10).

Tables live under one root (on a cluster: the shared folder the session names):

    {root}/bronze/events_batch     event_date-partitioned, insert-only merge
    {root}/silver/events              event_date-partitioned; upserts are commits in
                                      events.log beside it until a fold (row_log)
    {root}/gold/<table>               event_date-partitioned, partition replace
    {root}/silver/repos_scd2/open/v=N versioned open (current) rows
    {root}/silver/repos_scd2/history  closed versions, keyed append
    {root}/ops/quarantine             keyed append, by delivery
    {root}/ops/dq_results             by run and layer
    {root}/ops/ledger                 sinks that a stream's micro-batches finished
    {root}/ops/day_counts             versioned rows by table and day

Sketches of a table's keys stand in <table>.keys beside it (key_sketch).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import gold, quality, ranking, scd2
from eventlake.operators.bronze import split_valid_quarantine, to_bronze
from eventlake.operators.silver import to_silver_events
from eventlake.schemas import REPO_TRACKED
from eventlake.sinks import writers
from eventlake.sinks.day_counts import DayCounts
from eventlake.sinks.row_log import RowLog
from eventlake.sources.landing import existing_paths, hour_slots, spread_landing
from eventlake.sources.snapshots import target_snapshot


@dataclass
class Lake:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    bronze = property(lambda s: s.path("bronze/events_batch"))
    bronze_stream = property(lambda s: s.path("bronze/events_stream"))
    silver = property(lambda s: s.path("silver/events"))
    repos = property(lambda s: s.path("silver/repos_scd2"))
    repos_open = property(lambda s: s.path("silver/repos_scd2/open"))
    repos_history = property(lambda s: s.path("silver/repos_scd2/history"))
    quarantine = property(lambda s: s.path("ops/quarantine"))
    dq_results = property(lambda s: s.path("ops/dq_results"))
    ledger = property(lambda s: s.path("ops/ledger"))
    day_counts = property(lambda s: s.path("ops/day_counts"))

    def gold(self, name: str) -> str:
        return self.path(f"gold/{name}")


def silver_log(spark: SparkSession, lake: Lake) -> RowLog:
    return RowLog(spark, lake.silver)


def read_silver(spark: SparkSession, lake: Lake, days: list | None = None) -> DataFrame:
    """Silver events after all commits of all writers, or some days of them."""
    return silver_log(spark, lake).read(days)


@dataclass
class RunReport:
    metrics: dict = field(default_factory=dict)


def _scope(df: DataFrame, dates: list | None) -> DataFrame:
    if dates is None:
        return df
    return df.filter(F.col("event_date").isin(dates))


def run_quality(
    spark: SparkSession, lake: Lake, layer: str, df: DataFrame, run_id: str, execution_date: str | None
) -> DataFrame:
    """Run the layer suite in one pass, append the results, raise on a critical failure."""
    table = quality.LAYER_TABLE[layer]
    results = quality.run_checks(
        df, quality.layer_suite(layer), layer=layer, table=table, run_id=run_id, execution_date=execution_date or ""
    )
    results = results.persist()
    writers.append_results(results, lake.dq_results, run_id, layer)
    try:
        quality.gate(results, layer, table)
    finally:
        results.unpersist()
    return results


def rows_of_keys(spark: SparkSession, log: RowLog, keys: DataFrame) -> DataFrame:
    """All rows that the table has of the keys, on whatever day.  Only days
    that hold one of the keys are read."""
    days = log.days_of_keys(keys)
    return log.read(days).join(keys.select(log.key).distinct(), log.key, "left_semi") if days else log.read([])


def check_unique(spark: SparkSession, lake: Lake, keys: DataFrame, run_id: str, execution_date: str) -> DataFrame:
    """One row in silver, on whatever day, for every event of this run (Q3).

    A table whose keys were unique before stays so if the keys that were written
    are; the first run's keys are all there are.  Other events are not read.
    """
    table = quality.LAYER_TABLE["silver"]
    mine = rows_of_keys(spark, silver_log(spark, lake), keys).select("event_id")
    results = quality.run_checks(mine, [quality.unique("event_id")], layer="silver", table=table, run_id=run_id, execution_date=execution_date)
    results = results.persist()
    writers.append_results(results, lake.dq_results, run_id, "silver-unique")
    try:
        quality.gate(results, "silver", table)
    finally:
        results.unpersist()
    return results


def bronze_job(
    spark: SparkSession, lake: Lake, raw: DataFrame, source_file=None, ingestion_ts: str | None = None
) -> dict:
    """Raw lines -> quarantine append + insert-only merge into bronze.

    The parsed frame is persisted so the two outputs share one parse, the valid rows
    because they are merged and then counted; both are recomputed from the landing
    files if an executor is lost.
    """
    parsed = to_bronze(raw, source_file, ingestion_ts).persist(StorageLevel.MEMORY_AND_DISK)
    valid, bad = split_valid_quarantine(parsed)
    valid = valid.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quarantined = writers.append_quarantine(spark, bad, lake.quarantine)
        merged = writers.merge_insert_only(spark, valid, lake.bronze)
        days = valid.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each day of the batch
    finally:
        valid.unpersist()
        parsed.unpersist()
    dates = sorted(r["event_date"] for r in days)
    name = "bronze/events_batch"
    return {
        "valid": sum(r["n"] for r in days),
        "quarantined": quarantined,
        "inserted": merged["inserted"],
        "table_total": DayCounts(spark, lake.day_counts).record({name: lake.bronze}, dates)[name],
        "dates": dates,
    }


def silver_job(spark: SparkSession, lake: Lake, dates: list | None, source: str = "batch", run_id: str | None = None) -> dict:
    """Upsert the days' bronze events into silver, as a commit of this run.

    ``days`` are those that held one of the events before: an event that moved
    leaves its old day, which has to be computed again with the new one.
    """
    bronze = _scope(spark.read.parquet(lake.bronze), dates)
    log = silver_log(spark, lake)
    events = to_silver_events(bronze, source).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = log.days_of_keys(events.select("event_id"))
        log.append(events, source, f"{run_id or 'run'}-{uuid.uuid4().hex[:8]}")  # a rerun is a later commit
        return {"days": days}
    finally:
        events.unpersist()


def gold_job(spark: SparkSession, lake: Lake, dates: list | None) -> dict:
    """Recompute gold for the given days (all days when None) and replace them."""
    events = read_silver(spark, lake, dates)
    repos = read_dimension(spark, lake)
    # One scan of silver gives every grain; the five tables are cut from it
    # (computed from silver again if an executor is lost).
    sets = gold.gold_sets(events).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = {}
        for name, df in gold.gold_tables(sets, repos).items():
            path = lake.gold(name)
            if dates is None or not writers.table_exists(spark, path):
                written = writers.overwrite_table(df, path)
            else:
                written = writers.overwrite_partitions(df, path, expected=dates)
            out[name] = {"written": written}
    finally:
        sets.unpersist()
    totals = DayCounts(spark, lake.day_counts).record({f"gold/{name}": lake.gold(name) for name in out}, dates)
    for name, m in out.items():
        m["table_total"] = totals[f"gold/{name}"]
    return out


def batch_run(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    run_id: str | None = None,
    ingestion_ts: str | None = None,
) -> RunReport:
    """One batch end to end: bronze -> DQ -> silver -> DQ -> gold -> DQ.

    The days present in this batch are read back and recomputed, and with them
    the days that lost a row because its event moved.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    rep = RunReport()
    b = bronze_job(spark, lake, raw, None, ingestion_ts)
    rep.metrics["bronze"] = b
    dates = b["dates"]
    label = ",".join(writers.date_text(d) for d in dates)
    run_quality(spark, lake, "bronze", _scope(spark.read.parquet(lake.bronze), dates), run_id, label)
    rep.metrics["silver"] = silver_job(spark, lake, dates, run_id=run_id)
    keys = _scope(spark.read.parquet(lake.bronze), dates).select("event_id")
    dates = sorted({*dates, *rep.metrics["silver"]["days"]})
    check_unique(spark, lake, keys, run_id, label)
    run_quality(spark, lake, "silver", read_silver(spark, lake, dates), run_id, label)
    rep.metrics["gold"] = gold_job(spark, lake, dates)
    run_quality(
        spark, lake, "gold", _scope(spark.read.parquet(lake.gold("event_type_summary_hourly")), dates), run_id, label
    )
    return rep


def backfill(
    spark: SparkSession,
    lake: Lake,
    landing_root: str,
    start: str,
    end: str,
    run_id: str | None = None,
    ingestion_ts: str | None = None,
) -> RunReport:
    """Every landing hour from ``start`` to ``end`` (inclusive) in one scan.

    Only the folders ``year=/month=/day=/hour=`` of the window are looked at,
    however long the landing tree has grown; hours without a folder are skipped.
    """
    wanted = [r["folder"] for r in hour_slots(spark, start, end).select("folder").collect()]
    folders = existing_paths(spark, [f"{landing_root.rstrip('/')}/{f}" for f in wanted])
    if not folders:
        return RunReport()
    return batch_run(spark, lake, spread_landing(spark, folders), run_id, ingestion_ts)


def run_day(spark: SparkSession, lake: Lake, landing_root: str, day: str, run_id: str | None = None) -> RunReport:
    """All 24 landing hours of one day (the daily form of :func:`backfill`)."""
    return backfill(spark, lake, landing_root, f"{day} 00:00:00", f"{day} 23:00:00", run_id)


def dq_job(spark: SparkSession, lake: Lake, layer: str, execution_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """Stand-alone quality run for one layer's table.

    The table is scoped to ``execution_date`` when it has ``event_date``;
    results are appended to the DQ results table and a critical failure raises.
    """
    path = lake.path(quality.LAYER_TABLE.get(layer, quality.LAYER_TABLE["gold"]))
    df = quality.scope_to_date(read_silver(spark, lake) if path == lake.silver else spark.read.parquet(path), execution_date)
    return run_quality(spark, lake, layer, df, run_id or f"{layer}-{execution_date or 'all'}", execution_date)


def ingest_files(spark: SparkSession, lake: Lake, paths, run_id: str | None = None) -> RunReport:
    """The hourly run, over landing files."""
    return batch_run(spark, lake, spread_landing(spark, paths), run_id)


VERSION_KEY = "version_key"


def read_dimension(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Full dimension state: closed history plus the current open version."""
    open_rows = writers.read_versioned(spark, lake.repos_open)
    if open_rows is None:
        return None
    if not writers.table_exists(spark, lake.repos_history):
        return open_rows
    history = spark.read.parquet(lake.repos_history).drop(VERSION_KEY)
    return history.unionByName(open_rows)


def refresh_dimension(
    spark: SparkSession, lake: Lake, snapshot: DataFrame, effective_ts: str, several: bool = False
) -> dict:
    """SCD2 upsert of a metadata snapshot.

    Only open rows take part: rows the snapshot closes are appended to the
    history (keyed on repo and valid_from, so a rerun appends nothing twice)
    and the open rows are written as the next version.  ``effective_ts`` is the
    run's own time: a rerun after a failure must be given the same one.  The
    history is read for its keys; its rows are counted in its files' footers, and
    the open ones as they are written (V5).

    A snapshot that has a key twice is refused; with ``several`` only one that has
    no key or the same record twice: different records of a key open a version each.
    """
    scd2.check_snapshot_keys(snapshot, "repo_id", REPO_TRACKED if several else ())
    current_open = writers.read_versioned(spark, lake.repos_open)
    state = scd2.scd2_upsert(current_open, snapshot, "repo_id", REPO_TRACKED, effective_ts)
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        closed = state.filter(~F.col("is_current")).withColumn(
            VERSION_KEY, F.concat_ws("|", F.col("repo_id").cast("string"), F.col("valid_from").cast("string"))
        )
        appended = writers.merge_insert_only(spark, closed, lake.repos_history, key=VERSION_KEY, partition_col=None)
        cols = writers.CLUSTERING["silver/repos_scd2"]
        opened = state.filter(F.col("is_current")).repartitionByRange(*cols).sortWithinPartitions(*cols)
        res = writers.write_version(spark, opened, lake.repos_open)
    finally:
        state.unpersist()
    past = spark.read.parquet(lake.repos_history).count() if writers.table_exists(spark, lake.repos_history) else 0
    return {**res, "closed": appended["inserted"], "rows_total": res["rows"] + past, "current": res["rows"], "historical": past}


def fold_silver(spark: SparkSession, lake: Lake) -> dict:
    """Merge the writers' commits into the silver table (the daily job's part of
    W3; no other job rewrites a day of silver)."""
    return silver_log(spark, lake).fold()


def maintain_day(spark: SparkSession, lake: Lake, day: str, target_file_bytes: int = writers.TARGET_FILE_BYTES) -> dict:
    """Fold silver's commits, then compact and cluster one day of every
    day-partitioned table (W10) and put its key sketches together.

    Each table's day is rewritten as range-clustered, sorted files on its
    usual filter keys; tables or days that do not exist are skipped.
    """
    fold_silver(spark, lake)
    out = {}
    for name, cols in writers.CLUSTERING.items():
        path = lake.path(name)
        if writers.path_exists(spark, f"{path}/event_date={day}"):
            out[name] = writers.compact_partition(spark, path, day, cols, target_file_bytes=target_file_bytes)
            if writers.path_exists(spark, f"{path}.keys"):
                writers.key_sketch(spark, path).rebuild(spark.read.parquet(path), day)
    return out


def select_enrichment_targets(spark: SparkSession, lake: Lake, batch_size: int = 100) -> DataFrame:
    return ranking.enrichment_targets(read_silver(spark, lake), batch_size)


def enrich_dimension(spark: SparkSession, lake: Lake, records: DataFrame, effective_ts: str, batch_size: int = 100) -> dict:
    """Refresh the dimension with the metadata of the ranked targets.

    ``fetched`` of the ``targets`` had a record; the others are left as they are.
    """
    targets = select_enrichment_targets(spark, lake, batch_size).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        snapshot = target_snapshot(targets, records)
        found = {"targets": targets.count(), "fetched": snapshot.count()}
        return {**refresh_dimension(spark, lake, snapshot, effective_ts), **found}
    finally:
        targets.unpersist()


GOLD_TABLES = [
    "event_type_summary_hourly",
    "hot_repos_hourly",
    "contributor_activity_daily",
    "language_trends_daily",
    "topic_trends_daily",
]


def lake_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Every table of the lake that exists, keyed by its serving-source name."""
    out: dict[str, DataFrame] = {}
    for name in GOLD_TABLES:
        if writers.table_exists(spark, lake.gold(name)):
            out[name] = spark.read.parquet(lake.gold(name))
    if silver_log(spark, lake).exists():
        out["silver_events"] = read_silver(spark, lake)
    if writers.path_exists(spark, lake.dq_results):
        out["dq_results"] = spark.read.parquet(lake.dq_results).drop(writers.DELIVERY)
    repos = read_dimension(spark, lake)
    if repos is not None:
        out["repos_scd2"] = repos
    return out


def register_lake_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Create or replace the serving views over the lake's tables."""
    from eventlake.operators.serving import register_views

    return register_views(spark, lake_tables(spark, lake))
