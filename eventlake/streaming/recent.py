"""Dropping ids seen lately, remembered by number (ST6).

``drop_recent`` lets an event through if its id is not among the ids remembered.
The memory is bounded by count: beyond ``most`` ids it is cut to the latest
``keep``.  It is keyed state of the stream, dealt over ``buckets`` by a hash of the
id, each with its share of the bounds; one bucket remembers exactly what a single
poller would.  A batch reads and writes a bucket's memory once; it may hold several polls,
which are taken in their order, so that what goes through does not depend on how
many come in one batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Shipped to workers by value: they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The memory is cut to KEEP when it holds more than MOST ids.
MOST, KEEP = 5000, 2000
BUCKET = "_bucket"


class RecentIds(StatefulProcessor):
    """A bucket's remembered ids, oldest first."""

    def __init__(self, key: str, most: int, keep: int, poll: str | None = None):
        self.key, self.most, self.keep, self.poll = key, most, keep, poll

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("recent", "ids array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ids = list(self.memory.get()[0]) if self.memory.exists() else []
        if self.poll is None:
            polls = [rows]
        else:
            held = pd.concat(list(rows), ignore_index=True)
            polls = ([poll] for _, poll in held.groupby(self.poll))  # by rising number
        for poll in polls:
            seen = set(ids)
            for batch in poll:
                new = []
                for i in batch[self.key]:
                    new.append(i not in seen)
                    if new[-1]:
                        seen.add(i)
                        ids.append(i)
                yield batch[new]
            ids = ids[-self.keep :] if len(ids) > self.most else ids
        self.memory.update((ids,))

    def close(self) -> None:
        pass


def drop_recent(events: DataFrame, key: str = "event_id", most: int = MOST, keep: int = KEEP, buckets: int = 8, poll: str | None = None) -> DataFrame:
    """The stream's events whose id is not remembered; events without an id go.

    ``poll`` names a column of numbers without nulls that rise from poll to poll;
    without it a batch is one poll.  A task holds a bucket's part of a batch of polls,
    so bound the batch by bytes.

    Keyed state of this kind needs the RocksDB state store, which is set for the
    session.  Within a batch, which of several copies of an id goes on is open.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    dealt = events.where(F.col(key).isNotNull()).withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    state = RecentIds(key, max(1, most // buckets), max(1, keep // buckets), poll)
    return dealt.groupBy(BUCKET).transformWithStateInPandas(state, events.schema, outputMode="Append", timeMode="None")
