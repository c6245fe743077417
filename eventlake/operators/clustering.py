"""Ordering rows along a space-filling curve.

Sorted by several columns in turn, a table can be skipped by the first of them
only.  On a Z-order curve every column takes part: each value becomes its rank
among quantiles of a sample, and the ranks' bits are interleaved.  Files and row
groups then cover a small range of every column, so that a filter on any one of
them skips most.

The sample is bounded and chosen by a hash of the rows' key, over the whole input;
it decides where ranks begin, and so how well files are skipped, never what they
hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 10_000
BITS = 8


def quantiles(df: DataFrame, cols: Sequence[str], key: str, bits: int = BITS, rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Of each column up to ``2 ** bits - 1`` rising values that cut it into
    parts of about equal size; a frequent value cuts once."""
    order = F.xxhash64(F.lit(11), F.col(key), *cols)
    sample = df.select(*cols).orderBy(order).limit(rows).collect()
    out = {}
    for c in cols:
        values = sorted(r[c] for r in sample if r[c] is not None)
        at = [len(values) * i // (1 << bits) for i in range(1, 1 << bits)] if values else []
        out[c] = sorted({values[i] for i in at if values[i] > values[0]})
    return out


def rank_among(value: Column, bounds: list, low: int = 0, high: int | None = None) -> Column:
    """How many bounds are not above the value, by halving; null: 0."""
    high = len(bounds) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value >= F.lit(bounds[middle]), rank_among(value, bounds, middle + 1, high)).otherwise(rank_among(value, bounds, low, middle))


def z_value(df: DataFrame, cols: Sequence[str], key: str, bits: int = BITS) -> Column:
    """A row's place on the curve.  Ranks are stretched over all bits, so that a
    column of few values weighs as much as one of many."""
    parts = []
    for j, (c, bounds) in enumerate(quantiles(df, cols, key, bits).items()):
        rank = F.floor(rank_among(F.col(c), bounds) * F.lit(((1 << bits) - 1) / max(1, len(bounds)))).cast("long")
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("long"))
            parts.append(F.shiftleft(bit, i * len(cols) + len(cols) - 1 - j))
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out
