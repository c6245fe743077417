"""Repository metadata snapshots.

Metadata records arrive as JSON files in the shape the metadata API returns;
they are read with an explicit schema and normalised into snapshot rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas


def read_repo_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPO_API_JSON).json(path)


def normalize_repo_records(records: DataFrame) -> DataFrame:
    """API record -> snapshot row: renamed fields, topics sorted and comma-joined
    (missing -> ''), fork flag defaulting to false."""
    topics = F.coalesce(F.col("topics"), F.array().cast("array<string>"))
    return records.select(
        F.col("id").cast("bigint").alias("repo_id"),
        F.col("full_name").alias("repo_name"),
        F.col("language").alias("primary_language"),
        F.col("stargazers_count").cast("int").alias("stargazers_count"),
        F.col("forks_count").cast("int").alias("forks_count"),
        F.col("open_issues_count").cast("int").alias("open_issues_count"),
        F.array_join(F.array_sort(topics), ",").alias("topics"),
        F.col("description").alias("description"),
        F.coalesce(F.col("fork"), F.lit(False)).alias("is_fork"),
        F.col("size").cast("int").alias("size_kb"),
    )


def target_snapshot(targets: DataFrame, records: DataFrame) -> DataFrame:
    """Snapshot rows of the ranked repositories (repo_id, repo_name).

    A record is found by the repository's name; the id and name of the events
    are kept.  Targets without a record have no row.
    """
    found = normalize_repo_records(records)
    return targets.select("repo_id", "repo_name").join(found.drop("repo_id"), "repo_name").select(*found.columns)
