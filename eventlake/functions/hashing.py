"""Row fingerprint used to detect dimension changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must stay identical for hash compatibility with existing
# dimension rows): NULL marker and field separator.
NULL_MARKER = "∅"
SEPARATOR = "||"


def record_hash(cols: Sequence[str]) -> Column:
    """SHA-256 hex over the columns as text, NULL written as the marker."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
