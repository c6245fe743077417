"""Predicates and conditional aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_when(condition: Column) -> Column:
    """Rows where ``condition`` is true; NULL conditions count as 0 (bigint)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def first_failing(checks: Sequence[tuple[Column, str]]) -> Column:
    """Label of the first check whose predicate holds, else NULL."""
    return F.coalesce(*[F.when(pred, F.lit(label)) for pred, label in checks], F.lit(None).cast("string"))


# Fixed value: bot accounts are logins matching this pattern.
BOT_LOGIN_PATTERN = r"\[bot\]$"


def is_bot_login(login: Column) -> Column:
    """Bot accounts end in ``[bot]``; a NULL login gives a NULL flag."""
    return login.rlike(BOT_LOGIN_PATTERN)
