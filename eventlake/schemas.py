"""Table schemas (explicit; nothing is inferred from data)."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload fields promoted into silver, parsed once from the payload text.
PAYLOAD_JSON = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("ref_type", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("number", T.StringType()),
        T.StructField(
            "pull_request",
            T.StructType([T.StructField("number", T.StringType()), T.StructField("merged", T.StringType())]),
        ),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("actor_id", T.LongType(), True),
        T.StructField("actor_login", T.StringType(), True),
        T.StructField("repo_id", T.LongType(), False),
        T.StructField("repo_name", T.StringType(), False),
        T.StructField("payload", T.StringType(), True),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("event_date", T.DateType(), True),
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
        T.StructField("source_file", T.StringType(), True),
    ]
)

SILVER_COLUMNS = [
    "event_id",
    "event_type",
    "event_action",
    "actor_id",
    "actor_login",
    "is_bot",
    "repo_id",
    "repo_name",
    "repo_owner",
    "ref",
    "ref_type",
    "push_size",
    "pr_or_issue_number",
    "pr_merged",
    "payload",
    "event_timestamp",
    "event_date",
    "event_hour",
    "ingestion_timestamp",
    "source_file",
    "source",
    "silver_processed_at",
]

# Raw repository record as a metadata API returns it (S6/S7 input).
REPO_API_JSON = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("stargazers_count", T.IntegerType()),
        T.StructField("forks_count", T.IntegerType()),
        T.StructField("open_issues_count", T.IntegerType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("fork", T.BooleanType()),
        T.StructField("size", T.IntegerType()),
    ]
)

# Columns whose change opens a new dimension version.  description and size_kb
# are carried along but deliberately not tracked.
REPO_TRACKED = [
    "repo_name",
    "primary_language",
    "stargazers_count",
    "forks_count",
    "open_issues_count",
    "topics",
    "is_fork",
]

DQ_RESULT = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("observed", T.StringType()),
        T.StructField("expected", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("checked_at", T.TimestampType()),
    ]
)
