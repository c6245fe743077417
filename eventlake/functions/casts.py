"""Casts from raw JSON text that never fail the job (Spark 4 runs ANSI).

Text such as ``"3.7"`` is truncated to ``3`` like the non-ANSI cast did: the
value goes through a wide decimal first, then to the integral type.  Anything
unparsable becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE_DECIMAL = "decimal(38,6)"


def legacy_int(c: Column) -> Column:
    return c.try_cast(_WIDE_DECIMAL).try_cast("int")


def legacy_long(c: Column) -> Column:
    return c.try_cast(_WIDE_DECIMAL).try_cast("bigint")


def legacy_bool(c: Column) -> Column:
    return c.try_cast("boolean")


def parse_timestamp(c: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP in the session time zone; bad text -> NULL."""
    return F.try_to_timestamp(c)
