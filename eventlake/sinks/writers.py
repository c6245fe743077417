"""Idempotent table writers on plain Parquet.

No transaction log is assumed, so every writer is shaped to converge when it
is re-run after a failure:

- insert-only merge (W2) anti-joins the source against the target keys and
  appends only new keys; a rerun appends nothing;
- upsert merge (W3) appends the rows of other days, then rewrites the
  ``event_date`` partitions that hold a matching key with dynamic partition
  overwrite; a rerun converges, also after a failure in between;
- day replace (W4) overwrites one partition folder, an empty result empties it;
- versioned overwrite (W6) writes a new ``v=N`` folder and never deletes its
  own input;
- quarantine and result tables (W7/W8) are partitioned by delivery; a delivery
  written again adds nothing, and no row is lost.

A key is matched over the whole target, whatever day its row is in.  Sketches of
each day's keys (``key_sketch``) tell which days may hold a key of the source; the
keys of those days alone are read.  ``key_determines_partition=True`` narrows that
to the source's days and is right only if a key can never change its day.  The
set of days is brought to the driver, and of a small batch its keys, which are kept
as lists (W2): a stream's batches then read nothing of the table.

One writer at a time: a table must not be merged into by two jobs at once.
Writers that share a table append to ``row_log`` instead.
"""

from __future__ import annotations

import math
import re
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.clustering import z_value
from eventlake.sinks.files import delete_path, fs_path, list_children, path_bytes, path_exists, swap_folder
from eventlake.sinks.key_sketch import KeySketch, few

DATE_COL = "event_date"
DELIVERY = "delivery"


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table exists once it holds data; a write of no rows, or what a failed
    write left behind, does not make one."""
    return any(name.startswith((f"{DATE_COL}=", f"{DELIVERY}=", "part-")) for name in list_children(spark, path))


def partition_values(df: DataFrame, col: str = DATE_COL) -> list:
    """Distinct partition values of a batch (small: days in one batch)."""
    return sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)


def date_text(v) -> str:
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


class _Pinned:
    """Persist a batch for the duration of a merge unless the caller already did.

    A merge reads its source twice (the set of days, then the write); the
    batch is one landing window, so it is cheap to keep.  If an executor is
    lost the blocks are recomputed from lineage.
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self.owned = not df.storageLevel.useMemory and not df.storageLevel.useDisk

    def __enter__(self) -> DataFrame:
        if self.owned:
            self.df.persist(StorageLevel.MEMORY_AND_DISK)
        return self.df

    def __exit__(self, *exc) -> None:
        if self.owned:
            self.df.unpersist()


def balanced(df: DataFrame, partition_col: str | None) -> DataFrame:
    """Rebalance rows by the partition column before a partitioned write.

    AQE then packs each day into files of about the advisory partition size:
    a multi-day batch does not write one small file per (task, day), and a hot
    day is split over several tasks instead of one.
    """
    return df.hint("rebalance", partition_col) if partition_col else df


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# ---- W1 create -------------------------------------------------------------

def create_table(df: DataFrame, path: str, partition_col: str | None = DATE_COL) -> int:
    df, obs = _observed(balanced(df, partition_col), "create")
    w = df.write.mode("append")  # leftovers of a failed first write do no harm
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)
    return obs.get["rows"]


# ---- days that hold a key (W2, W3) -------------------------------------------

def key_sketch(spark: SparkSession, path: str, key: str = "event_id", partition_col: str = DATE_COL) -> KeySketch:
    """The table's sketches, made from its keys where a table has none yet."""
    sketch = KeySketch(spark, path, key, partition_col)
    if not sketch.exists() and table_exists(spark, path):
        sketch.add(spark.read.parquet(path).select(key, partition_col))
    return sketch


def doubt_keys(spark: SparkSession, path: str) -> None:
    """Rows are about to be taken out of the table: its lists of keys don't tell any more."""
    if path_exists(spark, f"{path.rstrip('/')}.keys"):
        KeySketch(spark, path, "", "").doubt()


def in_days(df: DataFrame, days: list, partition_col: str) -> DataFrame:
    return df.filter(F.col(partition_col).isin([F.lit(date_text(d)).cast("date") for d in days])) if days else df.filter(F.lit(False))


def days_of_keys(spark: SparkSession, keys: DataFrame, path: str, key: str = "event_id", partition_col: str = DATE_COL) -> dict:
    """``days`` of the table that hold one of the keys, and ``suspects``, the
    days whose keys were read for that (the others of them were false)."""
    suspects = key_sketch(spark, path, key, partition_col).suspect_days(keys)
    if not suspects:
        return {"days": [], "suspects": 0}
    scope = in_days(spark.read.parquet(path), suspects, partition_col).select(key, partition_col)
    return {"days": partition_values(scope.join(keys.select(key), key, "left_semi"), partition_col), "suspects": len(suspects)}


# ---- W2 insert-only merge --------------------------------------------------

def merge_insert_only(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    key: str = "event_id",
    partition_col: str | None = DATE_COL,
    key_determines_partition: bool = False,
    keys: list[tuple[str | None, str]] | None = None,
) -> dict:
    """Append source rows whose key is nowhere in the target (re-run = no-op).

    ``suspects`` in the result counts the days whose keys were read, ``false``
    those of them that held none of the source's; ``few`` tells a small source,
    ``rows`` how many it has.  ``keys``: the ``keys_of`` a source of few rows, by
    a caller that has them.
    """
    exists = table_exists(spark, path)
    if not exists and not partition_col:
        return {"created": True, "inserted": create_table(source, path, partition_col)}
    with _Pinned(source) as source:
        if not partition_col:
            new = source.join(spark.read.parquet(path).select(key), key, "left_anti")
            new, obs = _observed(new, "insert")
            new.write.mode("append").parquet(path)
            return {"created": False, "inserted": obs.get["rows"]}
        sketch = key_sketch(spark, path, key, partition_col)
        days = sketch.days_in(source) if keys is None else sketch.days_of(keys)
        within, rows = list(days) if key_determines_partition else None, sum(d.rows for d in days.values())
        if few(days):
            return {"created": not exists, **_insert_few(spark, source, path, sketch, keys_of(source, key, partition_col) if keys is None else keys, days, within), "few": True, "rows": rows}
        suspects = sketch.suspect_days(source, within, days) if exists else []
        if not suspects:  # all keys are new
            sketch.add(source, days)
            balanced(source, partition_col).write.mode("append").partitionBy(partition_col).parquet(path)
            return {"created": not exists, "inserted": rows, "suspects": 0, "false": 0, "few": False, "rows": rows}
        met = with_held_day(spark, source, path, key, partition_col, suspects).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            new = met.filter(F.col(HELD).isNull()).drop(HELD)
            inserted = sum(sketch.add(new.select(key, partition_col)).values())
            if inserted:
                balanced(new, partition_col).write.mode("append").partitionBy(partition_col).parquet(path)
            hits = len(partition_values(met, HELD))
            return {"created": False, "inserted": inserted, "suspects": len(suspects), "false": len(suspects) - hits, "few": False, "rows": rows}
        finally:
            met.unpersist()


def keys_of(source: DataFrame, key: str = "event_id", partition_col: str = DATE_COL) -> list[tuple[str | None, str]]:
    """(key, day) of each row of a small source."""
    return [(r[0], str(r[1])) for r in source.select(F.col(key).cast("string"), F.col(partition_col)).collect()]


#: Keys that are looked for one by one in a filter's set; more are joined.
KEYS_IN_FILTER = 256


def _insert_few(spark: SparkSession, source: DataFrame, path: str, sketch: KeySketch, mine: list, days: dict, within: list[str] | None) -> dict:
    """Insert of a small source, kept by the caller: its keys are matched on the
    driver with the lists of the small batches before, in one job with files of
    them, and with the table's rows only where neither is sure."""
    key, day = sketch.key, sketch.day
    prefix = f"{day}="
    there = {unquote(n[len(prefix):]) for n in list_children(spark, path) if n.startswith(prefix)}
    there = {"None" if d == "__HIVE_DEFAULT_PARTITION__" else d for d in there}
    keys = {k for k, _ in mine if k is not None}
    held, hits, suspects = set(), set(), set()
    if not there:
        sketch.doubt()  # lists of a table that is gone
    elif keys:
        held, suspects = sketch.held(source, keys, there, within)
        suspects |= set(sketch.suspect_days(source, within, days, lists=False))
    if suspects:
        scope = in_days(spark.read.parquet(path), sorted(suspects), day).select(F.col(key).cast("string").alias("k"), F.col(day).alias("day"))
        met = scope.join(F.broadcast(source.select(F.col(key).cast("string").alias("k"))), "k", "left_semi").distinct().collect()  # a small source's keys
        held, hits = held | {r["k"] for r in met}, {r["day"] for r in met}
    new_keys = [x for x in mine if x[0] not in held]
    if new_keys:
        new = _without(spark, source, key, held)
        listed = sketch.list_keys(new_keys)
        # a file for each day, by as many tasks as there are cores
        tasks = min(len({d for _, d in new_keys}), spark.sparkContext.defaultParallelism)
        new = new.repartition(tasks, day) if tasks > 1 else new.coalesce(1)
        new.write.mode("append").partitionBy(day).parquet(path)
        sketch.settle(listed)
    return {"inserted": len(new_keys), "suspects": len(suspects), "false": len(suspects) - len(hits)}


def _without(spark: SparkSession, source: DataFrame, key: str, held: set[str]) -> DataFrame:
    """The rows whose key is not ``held``; those without a key are not."""
    text = F.col(key).cast("string")
    if not held:
        return source
    if len(held) <= KEYS_IN_FILTER:
        return source.filter(~F.coalesce(text.isin(sorted(held)), F.lit(False)))
    gone = spark.createDataFrame([(k,) for k in sorted(held)], "_held string")
    return source.join(F.broadcast(gone), text == F.col("_held"), "left_anti")


HELD = "_held_on"


def with_held_day(spark: SparkSession, source: DataFrame, path: str, key: str, partition_col: str, suspects: list[str]) -> DataFrame:
    """``source`` with the day on which the target has its key, looked for on the
    suspect days only.  Without suspects no key of the target is read."""
    if not suspects:
        return source.withColumn(HELD, F.lit(None).cast("date"))
    target = in_days(spark.read.parquet(path), suspects, partition_col).select(F.col(key).alias("_held"), F.col(partition_col).alias(HELD))
    return source.join(target, source[key] == target["_held"], "left").drop("_held")


# ---- W3 upsert merge -------------------------------------------------------

def merge_upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    key: str = "event_id",
    partition_col: str = DATE_COL,
    key_determines_partition: bool = False,
) -> dict:
    """Update matching keys, insert new ones.

    Only days that hold a matching key are rewritten (dynamic partition
    overwrite of target-minus-matches plus the source rows of those days);
    source rows for every other day are new keys and are appended.  In steady
    state (no replays) an upsert is a look at the sketches plus an append.

    Matching keys are searched in the whole target (rows may move between
    days); a day left empty by a move is removed.  ``days`` in the result lists
    the days that were rewritten, so that what depends on them can be redone.

    Rows of days without a match are appended first: a run that ends in between
    leaves a moved row on both days, never on neither, and the rerun finds both.
    """
    with _Pinned(source) as source:
        if not table_exists(spark, path):
            KeySketch(spark, path, key, partition_col).add(source.select(key, partition_col))
            return {"created": True, "written": create_table(source, path, partition_col)}
        return _upsert(spark, source, path, key, partition_col, key_determines_partition)


def _upsert(spark, source, path, key, partition_col, key_determines_partition) -> dict:
    target = spark.read.parquet(path)
    cols = target.columns
    sketch = key_sketch(spark, path, key, partition_col)
    in_source = sketch.days_in(source)
    suspects = sketch.suspect_days(source, list(in_source) if key_determines_partition else None, in_source)
    hit_days = []
    if suspects:
        scope = in_days(target, suspects, partition_col).select(key, partition_col)
        hit_days = partition_values(scope.join(source.select(key), key, "left_semi"), partition_col)
    by_day = sketch.add(source, in_source)
    in_hit_days = F.col(partition_col).isin(hit_days) if hit_days else F.lit(False)
    appended, rewritten = sum(n for d, n in by_day.items() if d not in {date_text(h) for h in hit_days}), 0
    if appended:
        rest = balanced(source.filter(~in_hit_days).select(*cols), partition_col)
        rest.write.mode("append").partitionBy(partition_col).parquet(path)
    if hit_days:
        kept = target.filter(in_hit_days).join(source.select(key), key, "left_anti")
        out = balanced(kept.unionByName(source.filter(in_hit_days).select(*cols)), partition_col)
        obs = Observation("upsert_rewrite")
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(partition_col)).alias("days"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
        rewritten = obs.get["rows"]
        # A rewritten day that received no rows (every row moved away) is cleared.
        written = {date_text(v) for v in obs.get["days"]}
        for v in hit_days:
            if date_text(v) not in written:
                delete_path(spark, f"{path}/{partition_col}={date_text(v)}")
    return {"created": False, "rewritten": rewritten, "appended": appended, "partitions": len(hit_days), "days": hit_days, "suspects": len(suspects)}


# ---- W4 replace one partition, W5 full overwrite ----------------------------

def replace_partition(df: DataFrame, path: str, value, partition_col: str = DATE_COL) -> int:
    """Overwrite exactly ``partition_col=value``; an empty frame empties it.

    ``df`` must not read from that same partition folder.
    """
    df = df.filter(F.col(partition_col) == F.lit(value).cast(df.schema[partition_col].dataType)) \
        if partition_col in df.columns else df
    df, obs = _observed(df.drop(partition_col), "replace")
    doubt_keys(spark_of(df), path)
    df.write.mode("overwrite").parquet(f"{path}/{partition_col}={date_text(value)}")
    return obs.get["rows"]


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = DATE_COL, expected=None) -> int:
    """Replace every partition present in ``df`` (one job for many days).

    Days listed in ``expected`` that receive no rows are emptied, so a day
    whose recomputation is empty does not keep stale rows.
    """
    df = balanced(df, partition_col)
    obs = Observation("overwrite_partitions")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(partition_col)).alias("days"))
    doubt_keys(spark_of(df), path)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    written = {date_text(v) for v in obs.get["days"]}
    for v in expected or []:
        if date_text(v) not in written:
            delete_path(spark_of(df), f"{path}/{partition_col}={date_text(v)}")
    return obs.get["rows"]


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def overwrite_table(df: DataFrame, path: str, partition_col: str | None = DATE_COL) -> int:
    """Replace the whole table.

    The new rows are written to a folder of their own beside it and take the
    table's place when they are all there: a write that fails leaves the old
    table as it was, and ``df`` may read the table.
    """
    spark, aside = df.sparkSession, f"{path}.next-{uuid.uuid4().hex[:8]}"
    df, obs = _observed(balanced(df, partition_col), "overwrite")
    w = df.write.mode("errorifexists")
    if partition_col:
        w = w.partitionBy(partition_col)
    try:
        w.parquet(aside)
    except Exception:
        delete_path(spark, aside)
        raise
    rows = obs.get["rows"]
    doubt_keys(spark, path)
    swap_folder(spark, aside, path)
    spark.catalog.refreshByPath(path)
    return rows


# ---- W6 versioned overwrite -------------------------------------------------

def _versions(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name in list_children(spark, root):
        if name.startswith("v=") and path_exists(spark, f"{root}/{name}/_SUCCESS"):
            out.append(int(name[2:]))
    return sorted(out)


def current_version_path(spark: SparkSession, root: str) -> str | None:
    v = _versions(spark, root)
    return f"{root}/v={v[-1]}" if v else None


def read_versioned(spark: SparkSession, root: str) -> DataFrame | None:
    p = current_version_path(spark, root)
    return spark.read.parquet(p) if p else None


def write_version(spark: SparkSession, df: DataFrame, root: str, retain_hours: float = 168.0) -> dict:
    """Write ``df`` as the next version.

    Versions that were replaced more than ``retain_hours`` ago are removed, so
    a reader keeps its version that long.  ``df`` may read the current version:
    it is never overwritten in place.  The number is past every folder there
    is, also one that a failed write left behind.
    """
    versions = _versions(spark, root)
    taken = [int(name[2:]) for name in list_children(spark, root) if name.startswith("v=") and name[2:].isdigit()]
    n = max(taken, default=0) + 1
    df, obs = _observed(df, "version")
    df.write.mode("errorifexists").parquet(f"{root}/v={n}")
    fs, _ = fs_path(spark, root)
    for old, newer in zip(versions, versions[1:], strict=False):
        replaced = fs.getFileStatus(fs_path(spark, f"{root}/v={newer}/_SUCCESS")[1]).getModificationTime() / 1000
        if time.time() - replaced >= retain_hours * 3600:
            delete_path(spark, f"{root}/v={old}")
    return {"version": n, "rows": obs.get["rows"]}


# ---- W7 / W8 keyed append ---------------------------------------------------

def with_content_key(df: DataFrame, cols: Sequence[str], out: str = "record_key") -> DataFrame:
    return df.withColumn(out, F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), 256))


def append_quarantine(spark: SparkSession, quarantine: DataFrame, path: str, delivery: str = "") -> int:
    """Append bad rows (W7), each as often as it was delivered.

    The table is partitioned by delivery: a micro-batch, or the source file's landing
    day where no delivery is named.  Within one, a row's key is its file, its line and the
    number of its occurrence, so writing the same delivery again adds nothing, and
    only the deliveries at hand are looked at.  Equal lines are counted before they
    are numbered: a line that makes up much of a file is one row in the shuffle.
    """
    counted = quarantine.groupBy(*quarantine.columns).agg(F.count(F.lit(1)).alias("_n"))
    each = counted.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    keyed = with_content_key(each, ["source_file", "raw_record", "_i"]).drop("_n", "_i")
    if delivery:  # whole or not there
        folder = f"{path}/{DELIVERY}={delivery}"
        if path_exists(spark, f"{folder}/_SUCCESS"):
            return 0
        keyed, obs = _observed(keyed, "quarantine")
        keyed.write.mode("overwrite").parquet(folder)
        return _rows(obs)
    with _Pinned(keyed.withColumn(DELIVERY, landing_day(F.col("source_file")))) as keyed:
        new = keyed
        if table_exists(spark, path):
            held = spark.read.parquet(path).filter(F.col(DELIVERY).isin(partition_values(keyed, DELIVERY))).select("record_key", F.col(DELIVERY).cast("string"))
            new = keyed.join(held, ["record_key", DELIVERY], "left_anti").select(*keyed.columns)
        new, obs = _observed(balanced(new, DELIVERY), "quarantine")
        new.write.mode("append").partitionBy(DELIVERY).parquet(path)
        return _rows(obs)


def landing_day(source_file: Column) -> Column:
    """The landing day that a file stands under, else one of 64 groups of files."""
    day = F.regexp_replace(F.regexp_extract(source_file, r"year=\d+/month=\d+/day=\d+", 0), r"[a-z=]+", "")
    group = F.format_string("files-%02d", F.pmod(F.xxhash64(F.coalesce(source_file, F.lit(""))), F.lit(64)))
    return F.when(day != "", F.replace(day, F.lit("/"), F.lit("-"))).otherwise(group)


def _rows(obs: Observation) -> int:
    """Rows of a finished write; a plan found empty is cut off with its counter."""
    try:
        return obs.get["rows"]
    except Py4JJavaError:
        return 0


def append_results(df: DataFrame, path: str, run_id: str, part: str) -> None:
    """DQ result rows (W8) of one part of a run; the same run again replaces them."""
    name = re.sub(r"[^A-Za-z0-9_.-]", "-", f"{run_id}-{part}")
    df.write.mode("overwrite").parquet(f"{path}/{DELIVERY}={name}")


# ---- W10 compaction ----------------------------------------------------------

TARGET_FILE_BYTES = 256 * 1024 * 1024
CURVE = "_z"


def compact_partition(
    spark: SparkSession,
    path: str,
    value,
    cluster_by: Sequence[str],
    partition_col: str = DATE_COL,
    target_file_bytes: int = TARGET_FILE_BYTES,
    key: str = "event_id",
) -> int:
    """Rewrite one partition as range-clustered, sorted files of ~target size.

    Parquet min/max statistics on the clustering columns then let scans skip
    row groups, which is what the clustering is for.  Several columns are taken
    along a Z-order curve (``operators.clustering``), so that each of them alone
    skips.
    """
    nbytes = path_bytes(spark, f"{path}/{partition_col}={date_text(value)}")
    n = max(1, math.ceil(nbytes / target_file_bytes))
    day = spark.read.parquet(path).filter(F.col(partition_col) == F.lit(date_text(value)).cast("date"))
    # A key of its own as the last range column lets a hot value be split.
    split = [c for c in (key,) if c in day.columns and c not in cluster_by]
    order = list(cluster_by)
    if len(cluster_by) > 1 and split:
        day, order = day.withColumn(CURVE, z_value(day, cluster_by, key)), [CURVE, *cluster_by]
    # The partitioned writer sorts by the partition column; leading with it
    # keeps the clustering sort instead of having it replaced.
    out = day.repartitionByRange(n, *order, *split).sortWithinPartitions(partition_col, *order).drop(CURVE)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    return n


# Clustering columns of each table.  The dimension is clustered
# when a version is written, the day-partitioned tables by the daily job.
CLUSTERING = {
    "bronze/events_batch": ["repo_id"],
    "silver/events": ["repo_id", "event_type"],
    "silver/repos_scd2": ["repo_id"],
    "gold/hot_repos_hourly": ["repo_id"],
    "gold/event_type_summary_hourly": ["event_type"],
    "gold/contributor_activity_daily": ["actor_id"],
    "gold/language_trends_daily": ["primary_language"],
    "gold/topic_trends_daily": ["topic"],
}
