"""Upserts as appended commits, resolved when read (W3, ST5).

Several writers may upsert into one table at a time, as a batch job and a stream
do.  None of them looks at the table: each appends its rows as a commit, a
folder of its own beside the table named by time, writer and batch.  A reader
takes, for every key, the row of the last commit that has it, and the table's
row where none has.  No day is rewritten by a writer, and none can undo what
another one wrote.

``fold`` merges the finished commits into the table and removes them.  It is the
only thing that rewrites days and belongs to one daily job.  It stops at the
oldest commit that is still being written, so that an older row never comes to
lie over a newer one.

A commit counts once it is complete (``_SUCCESS``).  A batch that is written again
finds its complete commit and leaves it, or replaces its unfinished one.  Stamps
come from the writers' clocks, but are always past those there are.

A commit has a folder for each day; that of a small batch is one file with the day
as a column, as a stream's few rows of many days would be a file for each.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sinks import files, writers

COMMIT = "commit"


@dataclass(frozen=True, order=True)
class Commit:
    stamp: int
    writer: str
    batch: str
    complete: bool = True
    flat: bool = field(default=False, compare=False)  # the day is a column, not a folder

    @property
    def name(self) -> str:
        return f"{self.stamp:015d}.{self.writer}.{self.batch}"


def _plain(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_-]", "-", str(name))


class RowLog:
    """The table at ``path`` with the commits beside it."""

    def __init__(self, spark: SparkSession, path: str, key: str = "event_id", day: str = writers.DATE_COL):
        self.spark, self.path, self.key, self.day = spark, path, key, day
        self.root = f"{path.rstrip('/')}.log"

    def _folder(self, commit: Commit) -> str:
        return f"{self.root}/{COMMIT}={commit.name}"

    def _named(self) -> list[Commit]:
        """All commits by their names, not looked into."""
        names = [name[len(COMMIT) + 1 :].split(".") for name in files.list_children(self.spark, self.root) if name.startswith(f"{COMMIT}=")]
        return [Commit(int(stamp), writer, batch) for stamp, writer, batch in names]

    def _looked_into(self, commit: Commit) -> Commit:
        return replace(commit, complete=files.path_exists(self.spark, f"{self._folder(commit)}/_SUCCESS"))

    def commits(self) -> list[Commit]:
        """All commits, oldest first, complete or not."""
        return sorted(self._looked_into(c) for c in self._named())

    def append(self, rows: DataFrame, writer: str, batch: str, small: bool = False) -> bool:
        """Commit the rows of a batch, one for each key; false if they are there.
        ``small``: few rows, one at least, kept by the caller; they become one file."""
        writer, batch, known = _plain(writer), _plain(batch), self._named()
        for c in known:
            if (c.writer, c.batch) == (writer, batch):
                if self._looked_into(c).complete:
                    return False
                files.delete_path(self.spark, self._folder(c))
        stamp = max(int(time.time() * 1000), *[c.stamp + 1 for c in known], 0)
        commit = Commit(stamp, writer, batch)
        # the folder is there before the rows, so that a fold waits for them
        files.make_folder(self.spark, self._folder(commit))
        if small:
            rows.coalesce(1).write.mode("append").parquet(self._folder(commit))
        else:
            writers.balanced(rows, self.day).write.mode("append").partitionBy(self.day).parquet(self._folder(commit))
        return True

    def _filled(self, commits: list[Commit]) -> list[Commit]:
        """Complete commits that hold rows."""
        found = []
        for c in commits:
            names = files.list_children(self.spark, self._folder(c)) if c.complete else []
            flat = any(n.startswith("part-") for n in names)
            if flat or any(n.startswith(f"{self.day}=") for n in names):
                found.append(replace(c, flat=flat))
        return found

    def _logged(self, commits: list[Commit]) -> DataFrame:
        """The rows of filled commits, with the commit's name."""
        parts = []
        for flat in (False, True):
            if folders := [self._folder(c) for c in commits if c.flat == flat]:
                rows = self.spark.read.option("basePath", self.root).parquet(*folders)
                parts.append(rows.select(*[c for c in rows.columns if c not in (COMMIT, self.day)], COMMIT, self.day))
        return reduce(DataFrame.unionByName, parts)

    def _last(self, commits: list[Commit], scope=lambda df: df) -> DataFrame:
        """The last committed row of every key, of the rows in ``scope``.

        A row is left out if a later commit has its key: only keys are compared, and
        rows of one commit with none of it.
        """
        logged = self._logged(commits)
        rows = scope(logged)
        if len(commits) > 1:
            later = self._numbered(logged, commits).groupBy(F.col(self.key).alias("_k")).agg(F.max("_number").alias("_last"))
            numbered = self._numbered(rows, commits)
            rows = numbered.join(later, (F.col(self.key) == F.col("_k")) & (F.col("_last") > F.col("_number")), "left_anti").drop("_number")
        return rows.drop(COMMIT)

    def _numbered(self, rows: DataFrame, commits: list[Commit]) -> DataFrame:
        """Rows with their commit's place in the order of all (``_number``)."""
        places = self.spark.createDataFrame([(c.name, i) for i, c in enumerate(commits)], f"{COMMIT} string, _number int")
        return rows.join(F.broadcast(places), COMMIT).select(*rows.columns, "_number")

    def exists(self) -> bool:
        return writers.table_exists(self.spark, self.path) or bool(self._filled(self.commits()))

    def read(self, days: list | None = None) -> DataFrame:
        """The table as it stands after all complete commits, or some days of it."""
        commits = self._filled(self.commits())
        scope = (lambda df: df) if days is None else (lambda df: writers.in_days(df, days, self.day))
        if not commits:
            return scope(self.spark.read.parquet(self.path))
        last = self._last(commits, scope)
        if not writers.table_exists(self.spark, self.path):
            return last
        table = scope(self.spark.read.parquet(self.path))
        kept = table.join(self._logged(commits).select(self.key).distinct(), self.key, "left_anti")
        return kept.select(*table.columns).unionByName(last)

    def days_of_keys(self, keys: DataFrame) -> list:
        """Days that hold a row of one of the keys now; of the table, only days
        that the key sketches name are looked at."""
        days = set()
        if writers.table_exists(self.spark, self.path):
            days |= set(writers.days_of_keys(self.spark, keys, self.path, self.key, self.day)["days"])
        if commits := self._filled(self.commits()):
            logged = self._logged(commits).select(self.key, self.day).join(keys.select(self.key), self.key, "left_semi")
            days |= set(writers.partition_values(logged, self.day))
        return sorted(days)

    def fold(self, given_up_hours: float = 24.0) -> dict:
        """Merge the commits before the oldest unfinished one into the table.

        A commit still unfinished after ``given_up_hours`` is taken to be that of
        a writer that died, and removed: its batch is not acknowledged and comes
        again.
        """
        for c in self.commits():
            if not c.complete and time.time() - c.stamp / 1000 >= given_up_hours * 3600:
                files.delete_path(self.spark, self._folder(c))
        known = self.commits()
        open_at = min((i for i, c in enumerate(known) if not c.complete), default=len(known))
        ready = known[:open_at]
        out = {"commits": len(ready), "waiting": len(known) - len(ready), "days": []}
        if filled := self._filled(ready):
            out |= writers.merge_upsert(self.spark, self._last(filled), self.path, self.key, self.day)
        for c in ready:  # oldest first: what is left always is the newer one
            files.delete_path(self.spark, self._folder(c))
        return out
