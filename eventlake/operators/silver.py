"""Silver layer: bronze rows -> cleaned, enriched, deduplicated events."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions import is_bot_login, legacy_bool, legacy_int
from eventlake.operators.bronze import dedup_events


@lru_cache(maxsize=4)
def _parts(jvm) -> list[Column]:
    """Silver's columns but the last two, made once for a JVM as those of bronze."""
    return [
        F.col("event_id"),
        F.col("event_type"),
        F.col("_p.action").alias("event_action"),
        F.col("actor_id"),
        F.col("actor_login"),
        is_bot_login(F.col("actor_login")).alias("is_bot"),
        F.col("repo_id"),
        F.col("repo_name"),
        F.split(F.col("repo_name"), "/").getItem(0).alias("repo_owner"),
        F.col("_p.ref").alias("ref"),
        F.col("_p.ref_type").alias("ref_type"),
        legacy_int(F.col("_p.size")).alias("push_size"),
        legacy_int(F.coalesce(F.col("_p.number"), F.col("_p.pull_request.number"))).alias("pr_or_issue_number"),
        legacy_bool(F.col("_p.pull_request.merged")).alias("pr_merged"),
        F.col("payload"),
        F.col("event_timestamp"),
        F.col("event_date"),
        F.hour("event_timestamp").alias("event_hour"),
        F.col("ingestion_timestamp"),
        F.col("source_file"),
    ]


def to_silver_events(bronze: DataFrame, source: str = "batch", dedup: bool = True) -> DataFrame:
    """Promote payload fields and tag lineage.

    The payload text is parsed once (``from_json`` with every promoted leaf
    as STRING) instead of once per field; the JSON text itself is kept.
    """
    p = F.from_json(F.col("payload"), schemas.PAYLOAD_JSON)
    parts = _parts(bronze.sparkSession.sparkContext._jvm)
    df = bronze.withColumn("_p", p).select(*parts, F.lit(source).alias("source"), F.current_timestamp().alias("silver_processed_at"))
    if dedup:
        df = dedup_events(df, "event_id", tie_break=["event_timestamp", "payload", "ingestion_timestamp"])
    return df.select(*schemas.SILVER_COLUMNS)
