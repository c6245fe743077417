"""Enrichment target ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrichment_targets(silver: DataFrame, batch_size: int = 100, min_actors: int = 3) -> DataFrame:
    """Repositories most worth enriching: distinct human actors, then activity.

    Bots and NULL-flag actors are excluded.  A top-k (``TakeOrderedAndProject``)
    keeps only ``batch_size`` rows per task before the final merge.
    """
    return (
        silver.filter(~F.col("is_bot"))
        .groupBy("repo_id", "repo_name")
        .agg(F.count_distinct("actor_id").alias("actors"), F.count(F.lit(1)).alias("activity"))
        .filter(F.col("actors") >= min_actors)
        .orderBy(F.desc("actors"), F.desc("activity"), F.asc("repo_id"))
        .limit(batch_size)
    )
