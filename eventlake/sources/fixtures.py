"""Inputs derived from the driver tables (see FIXTURES.md section 2).

``events`` becomes raw JSON event lines and ``part`` becomes repository
metadata records.  Everything is computed by Spark from the whole tables, so
the work grows with the scale factor.  The derivation rules are the fixed
fixture contract that the SQL oracles mirror.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.snapshots import normalize_repo_records

FIXTURE_SOURCE_FILE = "landing/events.jsonl"

# Driver event type -> public event type.
EVENT_TYPE_MAP = {
    "click": "PushEvent",
    "view": "WatchEvent",
    "signup": "ForkEvent",
    "purchase": "PullRequestEvent",
    "error": "IssuesEvent",
}

# Row-number moduli that inject each defect.
MISSING_ID_MOD = 97
UNKNOWN_TYPE_MOD = 101
MISSING_REPO_ID_MOD = 89
BAD_TIMESTAMP_MOD = 83
DUPLICATE_MOD = 71
NULL_LOGIN_MOD = 79
MISSING_TYPE_MOD = 103
MISSING_REPO_NAME_MOD = 107
BROKEN_LINE_MOD = 109
NEW_KEY_OFFSET = 1_000_000


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give the scan at least one partition per core.

    A driver table is one small file (one split); a landing zone holds many
    files.  Without this, generating and parsing every line would run in a
    single task.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def _event_type(n: Column) -> Column:
    mapped = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_MAP.items() for x in kv])[F.col("event_type")]
    known = F.when(n % UNKNOWN_TYPE_MOD == 0, F.lit("SponsorshipEvent")).otherwise(mapped)
    return F.when(n % MISSING_TYPE_MOD != 0, known)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``events`` -> one struct per event in the public event shape."""
    ev = spread(read_driver(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props"))
    n = F.col("event_id")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    etype = F.col("_type")
    login = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.when(F.col("user_id") % 10 == 0, "[bot]").otherwise(""))
    payload = F.struct(
        F.when(n % 3 == 0, "opened").when(n % 3 == 1, "closed").alias("action"),
        F.when(etype == "PushEvent", F.concat(F.lit("refs/heads/b"), (n % 4).cast("string"))).alias("ref"),
        F.when(etype == "PushEvent", F.when(n % 4 == 0, "tag").otherwise("branch")).alias("ref_type"),
        F.when(etype == "PushEvent", n % 5 + (n % 2) * 0.5).alias("size"),
        F.when(etype == "IssuesEvent", n % 1000).alias("number"),
        F.when(
            etype == "PullRequestEvent",
            F.struct((n % 1000).alias("number"), (n % 2 == 0).alias("merged")),
        ).alias("pull_request"),
    )
    created = F.when(n % BAD_TIMESTAMP_MOD == 0, F.lit("not-a-timestamp")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    rec = F.struct(
        F.when(n % MISSING_ID_MOD != 0, n.cast("string")).alias("id"),
        etype.alias("type"),
        F.struct(F.col("user_id").alias("id"), F.when(n % NULL_LOGIN_MOD != 0, login).alias("login")).alias("actor"),
        F.struct(
            F.when(n % MISSING_REPO_ID_MOD != 0, k).alias("id"),
            F.when(n % MISSING_REPO_NAME_MOD != 0, F.concat(F.lit("org"), (k % 10).cast("string"), F.lit("/repo"), k.cast("string"))).alias("name"),
        ).alias("repo"),
        payload.alias("payload"),
        created.alias("created_at"),
    )
    return ev.withColumn("_type", _event_type(n)).select(
        n.alias("n"), rec.alias("rec"), F.to_date("ts").alias("day"), F.col("ts").alias("_ts")
    )


def raw_event_lines(spark: SparkSession, sf_dir: str, with_day: bool = False, with_slot: bool = False) -> DataFrame:
    """Raw JSON lines (column ``value``); some events appear twice.

    ``with_day`` adds the event's calendar day (from the driver timestamp) for
    writing one landing file per day; ``with_slot`` adds the landing hour
    folder parts ``year``, ``month``, ``day``, ``hour`` (zero padded).
    """
    recs = event_records(spark, sf_dir)
    copies = F.when(F.col("n") % DUPLICATE_MOD == 0, 2).otherwise(1)
    broken = F.concat(F.lit("broken line "), F.col("n").cast("string"))
    line = F.when(F.col("n") % BROKEN_LINE_MOD == 0, broken).otherwise(F.to_json("rec"))
    cols = [line.alias("value")] + (["day"] if with_day else [])
    if with_slot:
        cols = [cols[0]] + [
            F.date_format("_ts", "yyyy").alias("year"),
            F.date_format("_ts", "MM").alias("month"),
            F.date_format("_ts", "dd").alias("day"),
            F.date_format("_ts", "HH").alias("hour"),
        ]
    return recs.select(F.explode(F.sequence(F.lit(1), copies)).alias("_copy"), *cols).drop("_copy")


def repo_records(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    """Driver ``part`` -> repository metadata records as the metadata API shapes them.

    Snapshot 1 holds every part; snapshot 2 holds even keys (stars +1 on keys
    divisible by 4, size +1 everywhere) plus five brand-new keys.
    """
    part = read_driver(spark, sf_dir, "part")
    p = F.col("p_partkey")
    base = part
    if snapshot == 2:
        base = part.filter(p % 2 == 0).withColumn("_id", p).unionByName(
            part.filter(p < 5).withColumn("_id", p + NEW_KEY_OFFSET)
        )
    else:
        base = part.withColumn("_id", p)
    stars = F.col("p_size")
    size = F.col("p_size") * 10
    if snapshot == 2:
        stars = F.when(p % 4 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))
        size = size + 1
    topics = F.when(p % 17 == 0, F.array().cast("array<string>")).otherwise(F.split(F.col("p_name"), " "))
    return base.select(
        F.col("_id").alias("id"),
        F.concat(F.lit("org"), (p % 10).cast("string"), F.lit("/repo"), p.cast("string")).alias("full_name"),
        F.when(p % 13 != 0, F.col("p_brand")).alias("language"),
        stars.cast("int").alias("stargazers_count"),
        (p % 50).cast("int").alias("forks_count"),
        (p % 7).cast("int").alias("open_issues_count"),
        topics.alias("topics"),
        F.col("p_type").alias("description"),
        (p % 9 == 0).alias("fork"),
        size.cast("int").alias("size"),
    )


def repo_snapshot(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    return normalize_repo_records(repo_records(spark, sf_dir, snapshot))
