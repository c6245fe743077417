"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the driver tables (via :mod:`eventlake.sources.fixtures`)
and runs the library's operators over the whole input.  Outputs drop
processing-time columns and render timestamps as UTC text so they compare
exactly with the SQL oracles in :mod:`eventlake.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import gold, quality, ranking, scd2, serving
from eventlake.operators.bronze import quarantine_rows, to_bronze, valid_rows
from eventlake.operators.silver import to_silver_events
from eventlake.schemas import REPO_TRACKED
from eventlake.session import apply_job_conf
from eventlake.sources import fixtures
from eventlake.sources.landing import slots_between
from eventlake.sources.snapshots import target_snapshot

INGEST_TS = "2024-02-01T00:00:00Z"
SNAPSHOT_TS = {1: "2024-01-15T00:00:00Z", 2: "2024-01-16T00:00:00Z"}
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def ts_text(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.date_format(F.col(c), TS_TEXT))
    return df


# ---- shared building blocks ------------------------------------------------

def bronze_parsed(spark: SparkSession, sf: str) -> DataFrame:
    apply_job_conf(spark)
    return to_bronze(fixtures.raw_event_lines(spark, sf), fixtures.FIXTURE_SOURCE_FILE, INGEST_TS)


def bronze_valid_df(spark: SparkSession, sf: str) -> DataFrame:
    return valid_rows(bronze_parsed(spark, sf))


def silver_df(spark: SparkSession, sf: str, source: str = "batch") -> DataFrame:
    return to_silver_events(bronze_valid_df(spark, sf), source=source)


def dimension(spark: SparkSession, sf: str, snapshots: int = 2) -> DataFrame:
    state = None
    for i in range(1, snapshots + 1):
        state = scd2.scd2_upsert(state, fixtures.repo_snapshot(spark, sf, i), "repo_id", REPO_TRACKED, SNAPSHOT_TS[i])
    return state


def gold_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    events = silver_df(spark, sf)
    if name in ("language_trends_daily", "topic_trends_daily"):
        return getattr(gold, name)(events, dimension(spark, sf))
    return getattr(gold, name)(events)


# ---- bronze / silver -------------------------------------------------------

def q_bronze_valid(spark, sf):
    return ts_text(bronze_valid_df(spark, sf).drop("ingestion_timestamp"), "event_timestamp")


def q_bronze_quarantine(spark, sf):
    return quarantine_rows(bronze_parsed(spark, sf)).drop("ingestion_timestamp")


def q_quarantine_reasons(spark, sf):
    q = quarantine_rows(bronze_parsed(spark, sf))
    return q.groupBy("dq_reason").agg(F.count(F.lit(1)).alias("rows"))


def q_silver_events(spark, sf):
    df = silver_df(spark, sf).drop("ingestion_timestamp", "silver_processed_at")
    return ts_text(df, "event_timestamp")


# ---- gold ------------------------------------------------------------------

def _gold_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        return gold_table(spark, sf, name)

    q.__name__ = f"q_{name}"
    return q


# ---- serving ---------------------------------------------------------------

def q_trending_repos(spark, sf):
    return serving.trending_repos(gold_table(spark, sf, "hot_repos_hourly"))


def q_trending_top20(spark, sf):
    return serving.top_trending(q_trending_repos(spark, sf), 20)


def q_event_type_distribution(spark, sf):
    return serving.event_type_distribution(gold_table(spark, sf, "event_type_summary_hourly"))


def q_language_trends(spark, sf):
    return serving.language_trends(gold_table(spark, sf, "language_trends_daily"))


def q_topic_trends(spark, sf):
    return serving.topic_trends(gold_table(spark, sf, "topic_trends_daily"))


def q_top_contributors(spark, sf):
    return serving.top_contributors(gold_table(spark, sf, "contributor_activity_daily"))


def q_bot_vs_human(spark, sf):
    return serving.bot_vs_human(gold_table(spark, sf, "contributor_activity_daily"))


def q_hourly_activity(spark, sf):
    return serving.hourly_activity(gold_table(spark, sf, "event_type_summary_hourly"))


BATCH_UNTIL = "2024-01-15"


def silver_mixed(spark, sf):
    """Silver fed by both paths: days up to BATCH_UNTIL by the batch job, the
    rest by the stream (same transform, different lineage tag)."""
    valid = bronze_valid_df(spark, sf)
    early = F.col("event_date") <= F.to_date(F.lit(BATCH_UNTIL))
    return to_silver_events(valid.filter(early), "batch").unionByName(to_silver_events(valid.filter(~early), "stream"))


def q_batch_vs_stream(spark, sf):
    return serving.batch_vs_stream(silver_mixed(spark, sf))


def q_repo_versions(spark, sf):
    return serving.repo_versions(dimension(spark, sf))


def q_kpi_totals(spark, sf):
    return serving.kpi_totals(silver_df(spark, sf))


def q_languages_top15(spark, sf):
    return serving.top_languages(q_language_trends(spark, sf), 15)


def q_topics_top20(spark, sf):
    return serving.top_topics(q_topic_trends(spark, sf), 20)


def q_contributors_top20(spark, sf):
    return serving.top_contributor_ranking(q_top_contributors(spark, sf), 20)


def q_enrichment_targets(spark, sf):
    return ranking.enrichment_targets(silver_df(spark, sf), batch_size=100, min_actors=3)


def q_target_snapshot(spark, sf):
    """Metadata of the ranked repositories, found by name."""
    return target_snapshot(q_enrichment_targets(spark, sf), fixtures.repo_records(spark, sf, 1))


# ---- dimension -------------------------------------------------------------

def _dim_out(df: DataFrame) -> DataFrame:
    return ts_text(df, "valid_from", "valid_to")


def q_scd2_initial(spark, sf):
    return _dim_out(dimension(spark, sf, 1))


def q_scd2_second_snapshot(spark, sf):
    return _dim_out(dimension(spark, sf, 2))


def q_scd2_version_stats(spark, sf):
    return scd2.version_stats(dimension(spark, sf, 2))


def q_snapshot_normalise(spark, sf):
    """Metadata records written as JSON files, read back with the explicit
    schema (S6) and normalised (S7)."""
    from eventlake.session import scratch_dir
    from eventlake.sources.snapshots import normalize_repo_records, read_repo_records

    path = scratch_dir(spark, "repo-records")
    fixtures.repo_records(spark, sf, 2).write.mode("overwrite").json(path)
    return normalize_repo_records(read_repo_records(spark, path))


# ---- data quality ----------------------------------------------------------

DQ_OUT = ["check_name", "check_type", "severity", "passed", "observed", "expected", "layer"]


def layer_frames(spark, sf):
    events = silver_df(spark, sf)
    return {
        "bronze": bronze_valid_df(spark, sf),
        "silver": events,
        "gold": gold.event_type_summary_hourly(events),
    }


def _dq(spark, sf, layers, custom: bool, declarative: bool) -> DataFrame:
    frames = layer_frames(spark, sf)
    out = None
    for layer in layers:
        checks = []
        if custom:
            checks += quality.layer_checks(layer)
        if declarative:
            checks += [quality.expectation(e) for e in quality.expectation_suite(layer)]
        res = quality.run_checks(frames[layer], checks, layer=layer, table=quality.LAYER_TABLE[layer])
        out = res if out is None else out.unionByName(res)
    return out.select(*DQ_OUT)


def q_dq_bronze(spark, sf):
    return _dq(spark, sf, ["bronze"], True, False)


def q_dq_silver(spark, sf):
    return _dq(spark, sf, ["silver"], True, False)


def q_dq_gold(spark, sf):
    return _dq(spark, sf, ["gold"], True, False)


def q_dq_declarative(spark, sf):
    return _dq(spark, sf, ["bronze", "silver", "gold"], False, True)


def q_dq_health(spark, sf):
    return quality.dq_health(_dq(spark, sf, ["bronze", "silver", "gold"], True, True))


# ---- whole results in order (K6) ---------------------------------------------

def q_dq_health_ordered(spark, sf):
    return serving.layers_in_order(q_dq_health(spark, sf))


def q_event_types_ordered(spark, sf):
    return serving.event_types_in_order(q_event_type_distribution(spark, sf))


def q_hours_ordered(spark, sf):
    return serving.hours_in_order(q_hourly_activity(spark, sf))


# ---- hour slots ------------------------------------------------------------

def q_hour_slots(spark, sf):
    """Backfill window covering every hour of the event table."""
    ev = fixtures.read_driver(spark, sf, "events")
    bounds = ev.agg(F.min("ts").cast("timestamp").alias("start"), F.max("ts").cast("timestamp").alias("end"))
    return ts_text(slots_between(bounds), "slot_start")


# ---- writers (results are the table state after the writes) --------------

def _lake(spark, name: str):
    from eventlake.plans.jobs import Lake
    from eventlake.session import scratch_dir

    return Lake(scratch_dir(spark, name))


def _silver_out(df: DataFrame) -> DataFrame:
    return ts_text(df.drop("ingestion_timestamp", "silver_processed_at"), "event_timestamp").select(*SILVER_OUT)


SILVER_OUT = [
    "event_id", "event_type", "event_action", "actor_id", "actor_login", "is_bot", "repo_id", "repo_name",
    "repo_owner", "ref", "ref_type", "push_size", "pr_or_issue_number", "pr_merged", "payload",
    "event_timestamp", "event_date", "event_hour", "source_file", "source",
]


def q_merge_insert_only(spark, sf):
    """Create from the early days, merge everything twice: existing keys keep
    their first lineage tag, the rerun inserts nothing (W1, W2)."""
    from eventlake.sinks import writers

    lake = _lake(spark, "merge-insert")
    valid = bronze_valid_df(spark, sf)
    early = F.col("event_date") <= F.to_date(F.lit(BATCH_UNTIL))
    writers.merge_insert_only(spark, valid.filter(early).withColumn("source_file", F.lit("batch-1")), lake.bronze)
    second = valid.withColumn("source_file", F.lit("batch-2"))
    writers.merge_insert_only(spark, second, lake.bronze)
    writers.merge_insert_only(spark, second, lake.bronze)
    out = spark.read.parquet(lake.bronze).drop("ingestion_timestamp")
    return ts_text(out, "event_timestamp")


UPSERT_FIRST_UNTIL = "2024-01-20"
UPSERT_SECOND_FROM = "2024-01-11"


def q_merge_upsert(spark, sf):
    """Batch silver for days <= 01-20, then stream silver for days >= 01-11
    upserted twice: overlapping keys take the stream version (W3)."""
    from eventlake.sinks import writers

    lake = _lake(spark, "merge-upsert")
    valid = bronze_valid_df(spark, sf)
    d = F.col("event_date")
    first = to_silver_events(valid.filter(d <= F.to_date(F.lit(UPSERT_FIRST_UNTIL))), "batch")
    second = to_silver_events(valid.filter(d >= F.to_date(F.lit(UPSERT_SECOND_FROM))), "stream")
    writers.merge_upsert(spark, first, lake.silver)
    writers.merge_upsert(spark, second, lake.silver)
    writers.merge_upsert(spark, second, lake.silver)
    return _silver_out(spark.read.parquet(lake.silver))


def moved(valid: DataFrame) -> DataFrame:
    """Every 50th event or so, delivered again with a date one day later."""
    again = valid.filter(F.substring("event_id", -2, 2).isin("00", "50"))
    return again.withColumns({"event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 1 DAY"), "event_date": F.date_add("event_date", 1)})


def q_merge_insert_moved_day(spark, sf):
    """A known event that comes again with another date is not inserted."""
    from eventlake.sinks import writers

    lake = _lake(spark, "insert-moved")
    valid = bronze_valid_df(spark, sf)
    writers.merge_insert_only(spark, valid, lake.bronze)
    writers.merge_insert_only(spark, moved(valid), lake.bronze)
    return ts_text(spark.read.parquet(lake.bronze).drop("ingestion_timestamp"), "event_timestamp")


def q_merge_upsert_moved_day(spark, sf):
    """A known event that comes again with another date moves there."""
    from eventlake.sinks import writers

    lake = _lake(spark, "upsert-moved")
    valid = bronze_valid_df(spark, sf)
    writers.merge_upsert(spark, to_silver_events(valid, "batch"), lake.silver)
    for _ in range(2):
        writers.merge_upsert(spark, to_silver_events(moved(valid), "stream"), lake.silver)
    return _silver_out(spark.read.parquet(lake.silver))


def q_merge_insert_bloom_days(spark, sf):
    """Early days, then the later ones (all new: of the days before, none but
    those that the key sketches name falsely are looked at), then known events
    under other dates and the later days again, of which none is inserted (W2)."""
    from eventlake.sinks import writers

    lake = _lake(spark, "merge-bloom")
    valid = bronze_valid_df(spark, sf)
    early = F.col("event_date") <= F.to_date(F.lit(BATCH_UNTIL))
    writers.merge_insert_only(spark, valid.filter(early), lake.bronze)
    writers.merge_insert_only(spark, valid.filter(~early), lake.bronze)
    writers.merge_insert_only(spark, moved(valid), lake.bronze)
    writers.merge_insert_only(spark, valid.filter(~early), lake.bronze)
    return ts_text(spark.read.parquet(lake.bronze).drop("ingestion_timestamp"), "event_timestamp")


def two_writers(spark, sf, log):
    """Batch and stream upsert into one silver table in turn, with a fold in
    between; the last commits are not folded.  The valid rows, one for each event,
    are parsed once for all of the writes."""
    valid = bronze_valid_df(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    rows = lambda df, source: to_silver_events(df, source, dedup=False)
    d = F.col("event_date")
    try:
        log.append(rows(valid.filter(d <= F.to_date(F.lit(UPSERT_FIRST_UNTIL))), "batch"), "batch", "1")
        log.append(rows(valid.filter(d >= F.to_date(F.lit(UPSERT_SECOND_FROM))), "stream"), "stream", "1")
        log.fold()
        log.append(rows(valid.filter(d >= F.to_date(F.lit(UPSERT_THIRD_FROM))), "batch"), "batch", "2")
        log.append(rows(moved(valid), "stream"), "stream", "2")
        log.append(rows(moved(valid), "stream"), "stream", "2")  # the same batch again
    finally:
        valid.unpersist()


UPSERT_THIRD_FROM = "2024-01-18"


def q_upsert_two_writers(spark, sf):
    """Every event as its last writer left it, whoever that was."""
    from eventlake.plans.jobs import silver_log

    log = silver_log(spark, _lake(spark, "two-writers"))
    two_writers(spark, sf, log)
    return _silver_out(log.read())


def q_dq_unique_incremental(spark, sf):
    """Uniqueness of a batch's keys in the whole table (Q3): a table in which
    every 50th event or so was written a second time, on another day; the batch
    checks the events of the later days."""
    from eventlake.plans.jobs import rows_of_keys, silver_log
    from eventlake.sinks import writers

    lake = _lake(spark, "unique")
    valid = bronze_valid_df(spark, sf)
    rows = to_silver_events(valid, "batch").unionByName(to_silver_events(moved(valid), "batch"))
    writers.create_table(rows, lake.silver)
    batch = valid.filter(F.col("event_date") > F.to_date(F.lit(BATCH_UNTIL))).select("event_id")
    mine = rows_of_keys(spark, silver_log(spark, lake), batch)
    return quality.run_checks(mine, [quality.unique("event_id")], layer="silver", table=quality.LAYER_TABLE["silver"]).select(*DQ_OUT)


def q_gold_grouping_sets(spark, sf):
    """The three event tables out of one aggregate over one scan, side by side."""
    sets = gold.gold_sets(silver_df(spark, sf))
    keys = list(dict.fromkeys(k for g in gold.GRAINS.values() for k in g.keys))
    kinds, out = {f.name: f.dataType for f in sets.schema.fields}, None
    for name, grain in gold.GRAINS.items():
        table = gold.from_sets(sets, grain)
        counts = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in sorted(set(table.columns) - set(keys))])
        row = [F.col(k) if k in grain.keys else F.lit(None).cast(kinds[k]).alias(k) for k in keys]
        shown = table.select(F.lit(name).alias("table_name"), *row, counts.alias("counts"))
        out = shown if out is None else out.unionByName(shown)
    return out


def q_contributors_rollup(spark, sf):
    """Hourly sketches of a repository's actors, stored and added up over all
    hours, against the exact number: within 5 per cent, three standard errors (A12, A20)."""
    from eventlake.session import scratch_dir

    events = silver_df(spark, sf)
    path = scratch_dir(spark, "actor-sketches")
    gold.hot_repos_sketches(events).write.partitionBy("event_date").parquet(path)
    rolled = serving.contributors_rollup(spark.read.parquet(path))
    exact = events.groupBy("repo_name").agg(F.count_distinct("actor_id").alias("contributors_exact"))
    near = F.abs(F.col("contributors") - F.col("contributors_exact")) <= 0.05 * F.col("contributors_exact")
    return rolled.join(exact, "repo_name").select("repo_name", "events", "contributors_summed", "contributors_exact", near.alias("within_error"))


CORRECTED_DAY = "2024-01-10"
EMPTIED_DAY = "2024-01-11"


def q_replace_day(spark, sf):
    """Gold written in full, then two days recomputed from corrected silver:
    one loses its PushEvents, the other loses every event and ends empty (W4, W5)."""
    from eventlake.sinks import writers

    lake = _lake(spark, "replace-day")
    silver = silver_df(spark, sf)
    path = lake.gold("event_type_summary_hourly")
    writers.overwrite_table(gold.event_type_summary_hourly(silver), path)
    d = F.col("event_date")
    corrected = silver.filter(
        ~((d == F.to_date(F.lit(CORRECTED_DAY))) & (F.col("event_type") == "PushEvent"))
        & (d != F.to_date(F.lit(EMPTIED_DAY)))
    )
    fixed = gold.event_type_summary_hourly(corrected)
    for day in (CORRECTED_DAY, EMPTIED_DAY):
        writers.replace_partition(fixed, path, day)
    return spark.read.parquet(path)


COMPACT_DAY = "2024-01-05"


def q_compact_day(spark, sf):
    """Silver written, one day compacted and clustered; content unchanged."""
    from eventlake.sinks import writers

    lake = _lake(spark, "compact")
    writers.create_table(silver_df(spark, sf), lake.silver)
    writers.compact_partition(spark, lake.silver, COMPACT_DAY, writers.CLUSTERING["silver/events"])
    return _silver_out(spark.read.parquet(lake.silver))


def q_compact_day_zorder(spark, sf):
    """Every day of silver rewritten along a Z-order curve of repository and
    event type, several files a day; content unchanged (W10)."""
    from eventlake.sinks import writers

    lake = _lake(spark, "zorder")
    writers.create_table(silver_df(spark, sf), lake.silver)
    for day in writers.partition_values(spark.read.parquet(lake.silver)):
        writers.compact_partition(spark, lake.silver, day, writers.CLUSTERING["silver/events"], target_file_bytes=ZORDER_FILE_BYTES)
    return _silver_out(spark.read.parquet(lake.silver))


ZORDER_FILE_BYTES = 64 * 1024


# ---- streaming ---------------------------------------------------------------

STREAM_FILES_PER_TRIGGER = 3
REPLAY_UNTIL = "2024-01-03"


def stream_landing(spark, sf) -> str:
    """One text file per event day, plus the first days written a second time
    under another folder (a replayed delivery).  Returns a glob over both."""
    from eventlake.session import scratch_dir

    root = scratch_dir(spark, "stream-landing")
    lines = fixtures.raw_event_lines(spark, sf, with_day=True)
    lines.repartition("day").write.partitionBy("day").text(f"{root}/first")
    replay = lines.filter(F.col("day") <= F.to_date(F.lit(REPLAY_UNTIL)))
    replay.repartition("day").write.partitionBy("day").text(f"{root}/replay")
    return f"{root}/*/*"


def _stream_lake(spark, sf):
    """File stream -> foreachBatch (bronze insert-only, silver upsert,
    quarantine keyed append), drained with availableNow (ST1-ST5)."""
    from eventlake.streaming.ingest import file_source, start_ingestion

    apply_job_conf(spark)
    glob = stream_landing(spark, sf)
    lake = _lake(spark, "stream-lake")
    src = file_source(spark, glob, STREAM_FILES_PER_TRIGGER)
    q = start_ingestion(spark, src, lake, lake.path("_checkpoints/ingest"), available_now=True)
    q.awaitTermination()
    return lake


def q_stream_available_now(spark, sf):
    from eventlake.plans.jobs import read_silver

    return _silver_out(read_silver(spark, _stream_lake(spark, sf)))


def q_stream_bronze(spark, sf):
    """Stream bronze table after the replayed delivery: one row per event."""
    lake = _stream_lake(spark, sf)
    return ts_text(spark.read.parquet(lake.bronze_stream).drop("ingestion_timestamp"), "event_timestamp")


def q_stream_quarantine(spark, sf):
    """Quarantine after a replayed delivery: every bad line of both deliveries."""
    lake = _stream_lake(spark, sf)
    return spark.read.parquet(lake.quarantine).drop("ingestion_timestamp", "record_key", "delivery")


class Interrupted(Exception):
    """A failure put in on purpose."""


def drain(spark, source, lake, checkpoint, before=None) -> int:
    """Run the ingestion to the end, starting again after each failure put in;
    how often that was."""
    from pyspark.errors import StreamingQueryException

    from eventlake.streaming.ingest import start_ingestion

    failures = 0
    while True:
        try:
            start_ingestion(spark, source, lake, checkpoint, before=before).awaitTermination()
            return failures
        except StreamingQueryException as e:
            if Interrupted.__name__ not in str(e):
                raise
            failures += 1


def replayed_lake(spark, sf):
    """A stream that fails once ahead of each sink, in different batches."""
    from eventlake.streaming.ingest import SINKS, file_source

    apply_job_conf(spark)
    lake = _lake(spark, "replayed")
    source = file_source(spark, stream_landing(spark, sf), STREAM_FILES_PER_TRIGGER)
    due = {(i, sink) for i, sink in enumerate(SINKS)}

    def fail_once(sink: str, batch_id: int) -> None:
        if (batch_id, sink) in due:
            due.discard((batch_id, sink))
            raise Interrupted(f"ahead of {sink}")

    failures = drain(spark, source, lake, lake.path("_checkpoints/ingest"), fail_once)
    return lake, failures


def q_stream_replayed_batch(spark, sf):
    """Silver of a stream whose batches were cut off between sinks (ST1, ST3)."""
    from eventlake.plans.jobs import read_silver

    return _silver_out(read_silver(spark, replayed_lake(spark, sf)[0]))


def q_stream_bad_first_batch(spark, sf):
    """A stream whose first batch has bad lines only (ST1)."""
    from eventlake.plans.jobs import read_silver
    from eventlake.session import scratch_dir
    from eventlake.streaming.ingest import file_source

    lake, landing = _lake(spark, "bad-first"), scratch_dir(spark, "bad-first-landing")
    lines = fixtures.raw_event_lines(spark, sf).select("value")
    bad = to_bronze(lines, "x").where("_dq_reason is not null").select(F.col("_raw").alias("value"))
    bad.coalesce(1).write.text(f"{landing}/part=1")
    lines.write.text(f"{landing}/part=2")
    drain(spark, file_source(spark, f"{landing}/*", 1), lake, lake.path("_checkpoints/ingest"))
    return _silver_out(read_silver(spark, lake))


def recent_landing(spark, sf) -> str:
    """Files of the first days, then of the others, then the first days again."""
    from eventlake.session import scratch_dir

    root = scratch_dir(spark, "recent-landing")
    lines = fixtures.raw_event_lines(spark, sf, with_day=True)
    first = F.col("day") <= F.to_date(F.lit(REPLAY_UNTIL))
    for name, rows in (("a", lines.filter(first)), ("b", lines.filter(~first)), ("c", lines.filter(first))):
        rows.hint("rebalance", "day").write.partitionBy("day").text(f"{root}/{name}")
    return f"{root}/*/*"


RECENT_BYTES_PER_TRIGGER = 256 << 20


def q_stream_recent_set(spark, sf):
    """Ids remembered by number (ST6): events that come again after some
    thousands of others are let through again.  A file is a poll; a micro-batch
    has files up to a number of bytes."""
    from eventlake.streaming.ingest import file_source_by_bytes
    from eventlake.streaming.recent import drop_recent

    lake = _lake(spark, "recent")
    lines = file_source_by_bytes(spark, recent_landing(spark, sf), RECENT_BYTES_PER_TRIGGER)
    parsed = to_bronze(lines, F.unix_micros("_metadata.file_modification_time"), INGEST_TS).withColumnRenamed("source_file", "poll")
    new = drop_recent(parsed.select("event_id", "event_type", "repo_id", "poll"), poll="poll").drop("poll")
    out = lake.path("recent")
    done = new.writeStream.format("parquet").option("path", out).option("checkpointLocation", lake.path("_checkpoints/recent")).trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.parquet(out)


OFFSETS_PER_TRIGGER = 2000
TOPIC_PARTITIONS = 2


def q_stream_offsets(spark, sf):
    """A topic of two partitions read by offsets, 2000 messages a trigger,
    stopped half-way and gone on with from the checkpoint (S4)."""
    from eventlake.plans.jobs import read_silver
    from eventlake.session import scratch_dir
    from eventlake.sources.message_log import message_log
    from eventlake.streaming.ingest import start_ingestion

    lake, topic = _lake(spark, "offsets"), scratch_dir(spark, "topic")
    lines = fixtures.raw_event_lines(spark, sf).withColumn("p", F.pmod(F.xxhash64("value"), F.lit(TOPIC_PARTITIONS)))
    lines.write.partitionBy("p").text(topic)
    checkpoint = lake.path("_checkpoints/ingest")
    source = message_log(spark, topic, checkpoint, OFFSETS_PER_TRIGGER)
    start_ingestion(spark, source, lake, checkpoint, most_rows=OFFSETS_PER_TRIGGER).awaitTermination()  # an available-now run is one trigger
    again = start_ingestion(spark, message_log(spark, topic, checkpoint, OFFSETS_PER_TRIGGER), lake, checkpoint, available_now=False, processing_time="0 seconds", most_rows=OFFSETS_PER_TRIGGER)
    try:
        again.processAllAvailable()
    finally:
        again.stop()
    return _silver_out(read_silver(spark, lake))


def q_stream_dedup_watermark(spark, sf):
    """Producer-side dedup: ids remembered for an hour of arrival time (ST6)."""
    from eventlake.operators.bronze import BRONZE_COLUMNS
    from eventlake.streaming.ingest import STREAM_SOURCE_FILE, dedup_within_watermark, file_source

    apply_job_conf(spark)
    glob = stream_landing(spark, sf)
    lake = _lake(spark, "stream-dedup")
    parsed = to_bronze(file_source(spark, glob, STREAM_FILES_PER_TRIGGER), STREAM_SOURCE_FILE, INGEST_TS)
    deduped = dedup_within_watermark(parsed.select(*BRONZE_COLUMNS), "1 hour")
    out = lake.path("bronze/deduped")
    q = (
        deduped.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", lake.path("_checkpoints/dedup"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    res = spark.read.parquet(out).drop("ingestion_timestamp", "received_at", "event_date")
    return ts_text(res, "event_timestamp")


# ---- end-to-end batch job ------------------------------------------------------

def batch_windows(spark, sf) -> list[tuple[str, str]]:
    """Two backfill windows that cover every hour of the event table."""
    hour = lambda c: F.date_trunc("hour", c.cast("timestamp"))
    ends = fixtures.read_driver(spark, sf, "events").agg(hour(F.min("ts")).alias("a"), hour(F.max("ts")).alias("b"))
    half = F.date_trunc("hour", F.timestamp_seconds((F.unix_timestamp("a") + F.unix_timestamp("b")) / 2))
    r = ends.select("a", half.alias("m"), "b").select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("a", "m")],
                                                      F.date_format(F.col("m") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss"),
                                                      F.date_format("b", "yyyy-MM-dd HH:mm:ss")).first()
    return [(r[0], r[1]), (r[2], r[3])]


def _batch_lake(spark, sf):
    """Landing hour folders (gzip) -> dimension refresh x2 -> backfill in two
    windows plus a rerun of the first.

    The second snapshot's new keys meet those of a ``part`` of more than a million
    rows: such a key has two records, and the contract keeps both as versions."""
    from eventlake.plans import jobs
    from eventlake.session import scratch_dir

    apply_job_conf(spark)
    landing = scratch_dir(spark, "landing")
    lines = fixtures.raw_event_lines(spark, sf, with_slot=True)
    parts = ["year", "month", "day", "hour"]
    lines.repartition(*parts).write.partitionBy(*parts).option("compression", "gzip").text(landing)
    lake = _lake(spark, "lake")
    for i in (1, 2):
        jobs.refresh_dimension(spark, lake, fixtures.repo_snapshot(spark, sf, i), SNAPSHOT_TS[i], several=True)
    first, second = batch_windows(spark, sf)
    jobs.backfill(spark, lake, landing, *first)
    jobs.backfill(spark, lake, landing, *second)
    jobs.backfill(spark, lake, landing, *first)
    return lake


def q_batch_job_gold(spark, sf):
    lake = _batch_lake(spark, sf)
    return spark.read.parquet(lake.gold("event_type_summary_hourly")).drop("gold_processed_at")


def q_batch_job_trends(spark, sf):
    lake = _batch_lake(spark, sf)
    return spark.read.parquet(lake.gold("language_trends_daily")).drop("gold_processed_at")


def q_batch_job_quarantine(spark, sf):
    """Quarantine after a window was ingested twice: every bad line of its files
    as often as it stands there."""
    lake = _batch_lake(spark, sf)
    return spark.read.parquet(lake.quarantine).select("event_id", "dq_reason", "raw_record")


def q_batch_job_dimension(spark, sf):
    """Dimension state as stored by the refresh job: keyed history plus the
    versioned open rows (W6)."""
    from eventlake.plans.jobs import read_dimension

    lake = _batch_lake(spark, sf)
    return _dim_out(read_dimension(spark, lake))


def _day_lake(spark, sf, until: str | None = None):
    """A lake after one batch run over the lines of the days up to ``until``."""
    from eventlake.plans import jobs

    apply_job_conf(spark)
    lines = fixtures.raw_event_lines(spark, sf, with_day=True)
    if until:
        lines = lines.filter(F.col("day") <= F.to_date(F.lit(until)))
    lake = _lake(spark, "day-lake")
    raw = lines.select("value", F.lit(fixtures.FIXTURE_SOURCE_FILE).alias("source_file"))
    return lake, jobs.batch_run(spark, lake, raw)


def moved_lines(lines: DataFrame) -> DataFrame:
    """The lines of every 50th event or so, dated one day later."""
    day = F.regexp_extract("value", r'"created_at":"(\d{4}-\d{2}-\d{2})T', 1)
    mine = lines.filter(F.substring(F.regexp_extract("value", r'"id":"(\d+)"', 1), -2, 2).isin("00", "50") & (day != ""))
    later = F.date_add(F.to_date(F.when(day != "", day)), 1).cast("string")
    return mine.withColumn("value", F.replace("value", F.concat(F.lit('"created_at":"'), day), F.concat(F.lit('"created_at":"'), later)))


def moved_lake(spark, sf):
    """Events come by the stream, gold is computed; then the batch brings some of
    them again under another date, which moves them between days of silver."""
    from eventlake.plans import jobs
    from eventlake.session import scratch_dir
    from eventlake.streaming.ingest import file_source

    lake, landing = _lake(spark, "moved-lake"), scratch_dir(spark, "moved-landing")
    lines = fixtures.raw_event_lines(spark, sf).select("value")
    lines.write.text(landing)
    drain(spark, file_source(spark, landing, 100), lake, lake.path("_checkpoints/ingest"))
    jobs.gold_job(spark, lake, None)
    raw = moved_lines(lines).withColumn("source_file", F.lit(fixtures.FIXTURE_SOURCE_FILE))
    report = jobs.batch_run(spark, lake, raw)
    return lake, report


def q_batch_job_moved_day(spark, sf):
    """Gold of the days that events moved to, and of those they left, after the
    batch run that moved them (W3, W4)."""
    lake, _ = moved_lake(spark, sf)
    return spark.read.parquet(lake.gold("event_type_summary_hourly")).drop("gold_processed_at")


HOT_HOUR = 12


def q_batch_job_hot_hour(spark, sf):
    """Gzip landing hours of which one holds a third of all lines."""
    from eventlake.plans import jobs
    from eventlake.session import scratch_dir

    lake, landing = _lake(spark, "hot-hour"), scratch_dir(spark, "hot-landing")
    lines = fixtures.raw_event_lines(spark, sf, with_slot=True)
    hot = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    place = {"year": "2024", "month": "01", "day": "01", "hour": f"{HOT_HOUR:02d}"}
    lines = lines.withColumns({c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in place.items()})
    lines.repartition(*place).write.partitionBy(*place).option("compression", "gzip").text(landing)
    (first, _), (_, last) = batch_windows(spark, sf)
    jobs.backfill(spark, lake, landing, first, last)
    return spark.read.parquet(lake.gold("event_type_summary_hourly")).drop("gold_processed_at")


def q_batch_job_metrics(spark, sf):
    """What a run reports of its tables: rows written and rows in all."""
    _, report = _day_lake(spark, sf)
    bronze, made = report.metrics["bronze"], report.metrics["gold"]
    rows = [("bronze/events_batch", bronze["valid"], bronze["table_total"])]
    rows += [(f"gold/{name}", m["written"], m["table_total"]) for name, m in made.items()]
    return spark.createDataFrame(rows, "name string, written long, table_total long")


def q_lake_trending_repos(spark, sf):
    """A serving view, in SQL, over the tables that a batch run wrote."""
    from eventlake.plans.jobs import register_lake_views

    lake, _ = _day_lake(spark, sf)
    register_lake_views(spark, lake)
    return spark.sql("SELECT * FROM vw_trending_repos")


def q_lake_batch_vs_stream(spark, sf):
    """Early days by the batch job, later days by the stream, one silver."""
    from eventlake.plans.jobs import register_lake_views
    from eventlake.session import scratch_dir
    from eventlake.streaming.ingest import file_source, start_ingestion

    lake, _ = _day_lake(spark, sf, BATCH_UNTIL)
    landing = scratch_dir(spark, "later-days")
    later = fixtures.raw_event_lines(spark, sf, with_day=True).filter(F.col("day") > F.to_date(F.lit(BATCH_UNTIL)))
    later.select("value").write.text(landing)
    source = file_source(spark, landing, STREAM_FILES_PER_TRIGGER)
    start_ingestion(spark, source, lake, lake.path("_checkpoints/ingest"), available_now=True).awaitTermination()
    register_lake_views(spark, lake)
    return spark.sql("SELECT * FROM vw_batch_vs_stream")


def _with_job_conf(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Apply the session settings the transforms assume (UTC, dynamic
    overwrite) whatever session the caller hands in."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        apply_job_conf(spark)
        return fn(spark, sf)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_valid": q_bronze_valid,
    "bronze_quarantine": q_bronze_quarantine,
    "quarantine_reasons": q_quarantine_reasons,
    "silver_events": q_silver_events,
    "event_type_summary_hourly": _gold_query("event_type_summary_hourly"),
    "hot_repos_hourly": _gold_query("hot_repos_hourly"),
    "contributor_activity_daily": _gold_query("contributor_activity_daily"),
    "language_trends_daily": _gold_query("language_trends_daily"),
    "topic_trends_daily": _gold_query("topic_trends_daily"),
    "scd2_initial": q_scd2_initial,
    "scd2_second_snapshot": q_scd2_second_snapshot,
    "scd2_version_stats": q_scd2_version_stats,
    "snapshot_normalise": q_snapshot_normalise,
    "enrichment_targets": q_enrichment_targets,
    "target_snapshot": q_target_snapshot,
    "vw_dq_health": q_dq_health,
    "vw_event_type_distribution": q_event_type_distribution,
    "vw_trending_repos": q_trending_repos,
    "vw_language_trends": q_language_trends,
    "vw_topic_trends": q_topic_trends,
    "vw_top_contributors": q_top_contributors,
    "vw_bot_vs_human": q_bot_vs_human,
    "vw_hourly_activity": q_hourly_activity,
    "vw_batch_vs_stream": q_batch_vs_stream,
    "vw_repo_versions": q_repo_versions,
    "kpi_totals": q_kpi_totals,
    "trending_top20": q_trending_top20,
    "languages_top15": q_languages_top15,
    "topics_top20": q_topics_top20,
    "contributors_top20": q_contributors_top20,
    "dq_bronze": q_dq_bronze,
    "dq_silver": q_dq_silver,
    "dq_gold": q_dq_gold,
    "dq_declarative": q_dq_declarative,
    "dq_health_ordered": q_dq_health_ordered,
    "event_types_ordered": q_event_types_ordered,
    "hours_ordered": q_hours_ordered,
    "hour_slots": q_hour_slots,
    "merge_insert_only": q_merge_insert_only,
    "merge_upsert": q_merge_upsert,
    "merge_insert_moved_day": q_merge_insert_moved_day,
    "merge_upsert_moved_day": q_merge_upsert_moved_day,
    "merge_insert_bloom_days": q_merge_insert_bloom_days,
    "upsert_two_writers": q_upsert_two_writers,
    "dq_unique_incremental": q_dq_unique_incremental,
    "gold_grouping_sets": q_gold_grouping_sets,
    "contributors_rollup": q_contributors_rollup,
    "replace_day": q_replace_day,
    "compact_day": q_compact_day,
    "compact_day_zorder": q_compact_day_zorder,
    "stream_available_now": q_stream_available_now,
    "stream_dedup_watermark": q_stream_dedup_watermark,
    "stream_bronze": q_stream_bronze,
    "stream_quarantine": q_stream_quarantine,
    "stream_replayed_batch": q_stream_replayed_batch,
    "stream_bad_first_batch": q_stream_bad_first_batch,
    "stream_recent_set": q_stream_recent_set,
    "stream_offsets": q_stream_offsets,
    "batch_job_moved_day": q_batch_job_moved_day,
    "batch_job_hot_hour": q_batch_job_hot_hour,
    "batch_job_gold": q_batch_job_gold,
    "batch_job_trends": q_batch_job_trends,
    "batch_job_quarantine": q_batch_job_quarantine,
    "batch_job_dimension": q_batch_job_dimension,
    "batch_job_metrics": q_batch_job_metrics,
    "lake_trending_repos": q_lake_trending_repos,
    "lake_batch_vs_stream": q_lake_batch_vs_stream,
}

QUERIES = {name: _with_job_conf(fn) for name, fn in QUERIES.items()}
