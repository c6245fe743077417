"""Rows dealt once into shards, and queries sent to every shard.

A shard is a bounded number of rows that one task holds; queries, the smaller
side, come to it as a stream of batches after its rows.  Rows are shuffled once
whatever the number of queries, and none is there twice.  Which shard a row is
in has nothing to do with its values, so equal rows spread evenly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def ask_shards(rows: DataFrame, asked: DataFrame, shard: int, order: list[str], prepare: Callable, answer: Callable, schema: str) -> DataFrame:
    """``answer(prepare(rows of a shard), batch of asked)`` of all shards.

    ``rows`` and ``asked`` may have different columns.  ``prepare`` gets a
    shard's rows as one frame of about ``shard`` rows in the order of ``order``
    (columns of ``rows``); a batch of ``asked`` is what one Arrow batch brings.
    """
    n = max(1, -(-rows.count() // shard))
    mine = [f"r_{c}" for c in rows.columns]
    theirs = [f"q_{c}" for c in asked.columns]
    dealt = rows.toDF(*mine).withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int"))
    sent = asked.toDF(*theirs).withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    both = dealt.withColumn("_asks", F.lit(False)).unionByName(sent.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
    held = both.repartition(n, "_shard").sortWithinPartitions("_shard", "_asks", *[f"r_{c}" for c in order])

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    columns, names = list(rows.columns), list(asked.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, ready = None, [], None
        for batch in batches:
            number, asks = batch["_shard"].to_numpy(), batch["_asks"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(number)], strict=True):
                if a == b:
                    continue
                if number[a] != now:
                    now, parts, ready = number[a], [], None
                if not asks[a]:
                    parts.append(batch.slice(a, b - a).select(mine).to_pandas().set_axis(columns, axis=1))
                elif parts or ready is not None:
                    if ready is None:
                        ready, parts = prepare(pd.concat(parts, ignore_index=True)), []
                    for found in answer(ready, batch.slice(a, b - a).select(theirs).to_pandas().set_axis(names, axis=1)):
                        yield pa.RecordBatch.from_pandas(found, kinds, preserve_index=False)

    return held.mapInArrow(run, schema)
