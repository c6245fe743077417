"""Bronze layer: raw JSON lines -> typed rows + quarantine.

Each line is parsed once with ``json_tuple`` (values as text, objects as
compact JSON), then cast with ``try_*`` functions.  Rows missing a required field are not dropped:
they carry the first failing reason and go to the quarantine with the raw line.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions import first_failing, legacy_long, parse_timestamp

# Required fields in check order and the reason each one gives.
REQUIRED_REASONS = [
    ("event_id", "missing_event_id"),
    ("event_type", "missing_event_type"),
    ("repo_id", "missing_repo_id"),
    ("repo_name", "missing_repo_name"),
    ("event_timestamp", "invalid_event_timestamp"),
]

BRONZE_COLUMNS = [f.name for f in schemas.BRONZE.fields]

# Top-level fields of a raw event line.
TOP_FIELDS = ["id", "type", "actor", "repo", "payload", "created_at"]


def dq_reason() -> Column:
    """First failing required-field check, else NULL (valid row)."""
    return first_failing([(F.col(c).isNull(), label) for c, label in REQUIRED_REASONS])


def _as_column(value, default_col: str | None = None) -> Column:
    if isinstance(value, Column):
        return value
    if value is None and default_col is not None:
        return F.col(default_col)
    return F.lit(value)


@lru_cache(maxsize=4)
def _parts(jvm) -> dict[str, Column]:
    """The columns of the parse, by name.  They are the same for all lines and made
    once for a JVM: that takes hundreds of calls, as long as a stream's small batch."""
    happened = parse_timestamp(F.col("_created_at"))
    return {
        "_raw": F.col("value").alias("_raw"),
        # json_tuple parses each line once and returns top-level values as text
        # (objects as compact JSON).  Being a generator, it is also a boundary
        # that filters on derived columns (the quarantine split) are not pushed
        # through, so the parse is never repeated inside a pushed-down predicate.
        "top": F.json_tuple(F.col("value"), *TOP_FIELDS).alias(*[f"_{f}" for f in TOP_FIELDS]),
        "actor": F.json_tuple(F.col("_actor"), "id", "login").alias("_actor_id", "_actor_login"),
        "repo": F.json_tuple(F.col("_repo"), "id", "name").alias("_repo_id", "_repo_name"),
        "event_id": F.col("_id"),
        "event_type": F.col("_type"),
        "actor_id": legacy_long(F.col("_actor_id")),
        "actor_login": F.col("_actor_login"),
        "repo_id": legacy_long(F.col("_repo_id")),
        "repo_name": F.col("_repo_name"),
        "payload": F.col("_payload"),
        "event_timestamp": happened,
        "event_date": F.to_date(happened),
        "source_file": F.col("source_file"),
        "reason": dq_reason().alias("_dq_reason"),
    }


def to_bronze(
    raw_lines: DataFrame,
    source_file: str | Column | None = None,
    ingestion_ts: str | None = None,
) -> DataFrame:
    """Map raw lines (column ``value``) to bronze rows plus ``_dq_reason``, ``_raw``.

    ``source_file`` is a lineage tag: a literal, a Column, or None to keep an
    existing ``source_file`` column of ``raw_lines`` (e.g. the scanned file path).
    ``ingestion_ts`` pins the ingestion time (tests); default is now.
    """
    src = _as_column(source_file, "source_file" if "source_file" in raw_lines.columns else None)
    arrived = F.current_timestamp() if ingestion_ts is None else F.to_timestamp(F.lit(ingestion_ts))
    parts = _parts(raw_lines.sparkSession.sparkContext._jvm)
    nested = raw_lines.select(parts["_raw"], src.alias("source_file"), parts["top"]).select("*", parts["actor"]).select("*", parts["repo"])
    typed = {name: arrived if name == "ingestion_timestamp" else parts[name] for name in BRONZE_COLUMNS}
    return nested.select(*[c.alias(name) for name, c in typed.items()], "_raw").select("*", parts["reason"])


def dedup_events(df: DataFrame, key: str = "event_id", tie_break: list[str] | None = None) -> DataFrame:
    """One row per key with a deterministic survivor.

    The survivor is the row with the greatest ``tie_break`` tuple (default: all
    columns in order), so reruns pick the same row.  Runs as a partial + final
    aggregate: copies of a hot key collapse map-side before the shuffle.
    """
    packed, unpacked = _dedup_parts(df.sparkSession.sparkContext._jvm, key, tuple(df.columns), tuple(tie_break or ()), tuple(df.columns))
    return df.groupBy(key).agg(packed).select(*unpacked)


@lru_cache(maxsize=64)
def _dedup_parts(jvm, key: str, columns: tuple[str, ...], order: tuple[str, ...], out: tuple[str, ...]) -> tuple[Column, list[Column]]:
    """The greatest row of a key, and the columns ``out`` of it."""
    others = [c for c in columns if c != key]
    first = list(order) or others
    packed = F.struct(*[F.col(c) for c in [*first, *[c for c in others if c not in first]]])
    return F.max(packed).alias("_row"), [F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in out]


def valid_rows(bronze: DataFrame) -> DataFrame:
    """Valid rows in bronze column order, deduplicated on ``event_id``."""
    # The tie-break carries a 64-bit hash of the line, not the line itself, so
    # the dedup shuffle does not ship every event twice.
    valid = bronze.filter("_dq_reason is null").select(F.xxhash64("_raw").alias("_h"), *BRONZE_COLUMNS)
    packed, unpacked = _dedup_parts(bronze.sparkSession.sparkContext._jvm, "event_id", tuple(valid.columns), ("event_timestamp", "_h"), tuple(BRONZE_COLUMNS))
    return valid.groupBy("event_id").agg(packed).select(*unpacked)


# The quarantine table's columns, and what they are called here.
QUARANTINE_COLUMNS = {
    "event_id": "event_id",
    "source_file": "source_file",
    "ingestion_timestamp": "ingestion_timestamp",
    "dq_reason": "_dq_reason",
    "raw_record": "_raw",
}


def quarantine_rows(bronze: DataFrame) -> DataFrame:
    bad = bronze.where("_dq_reason is not null")
    return bad.select(*[F.col(mine).alias(name) for name, mine in QUARANTINE_COLUMNS.items()])


def split_valid_quarantine(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid bronze rows, quarantine rows) over one parsed plan."""
    return valid_rows(bronze), quarantine_rows(bronze)
