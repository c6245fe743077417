"""Column-expression helpers shared by the operators."""

from eventlake.functions.casts import legacy_bool, legacy_int, legacy_long, parse_timestamp
from eventlake.functions.conditions import count_when, first_failing, is_bot_login
from eventlake.functions.hashing import record_hash

__all__ = [
    "count_when",
    "first_failing",
    "is_bot_login",
    "legacy_bool",
    "legacy_int",
    "legacy_long",
    "parse_timestamp",
    "record_hash",
]
