"""Rows of day-partitioned tables, kept by day from run to run.

A run counts the days that it wrote, in the footers of their files, and takes
every other day's number from the run before, so a total costs what was
written and not what the table has become.  A table that is met for the first
time, or written as a whole, is counted as a whole.

Counts are taken after the write: a run that fails in between leaves old
numbers for its days, and its rerun, which writes the same days, counts them
again.  Compaction changes no count.  One run at a time, like all batch jobs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import writers

SCHEMA = "name string, day date, rows long"


class DayCounts:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """name, day and rows, a line for each day of each table."""
        held = writers.read_versioned(self.spark, self.path)
        return self.spark.createDataFrame([], SCHEMA) if held is None else held

    def record(self, tables: dict[str, str], days: list | None, partition_col: str = writers.DATE_COL) -> dict[str, int]:
        """Total rows of each of ``tables`` (name: path) after ``days`` of them
        were written (None: all days)."""
        held = self.read()
        known = {r["name"] for r in held.select("name").distinct().collect()}  # a line for each table
        there = {name: path for name, path in tables.items() if writers.table_exists(self.spark, path)}
        counts = []
        for name, path in there.items():
            rows = self.spark.read.parquet(path)
            if days is not None and name in known:
                rows = rows.where(F.col(partition_col).isin(days))
            counted = rows.groupBy(F.col(partition_col).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
            counts.append(counted.select(F.lit(name).alias("name"), "day", "rows"))
        whole = [n for n in tables if n not in known or days is None]
        again = F.col("name").isin(whole)
        if days is not None:
            again = again | F.col("name").isin(list(tables)) & F.col("day").isin(days)
        state = reduce(DataFrame.unionByName, counts, held.where(~again))
        # a line for each table and day: one file
        writers.write_version(self.spark, state.coalesce(1), self.path, retain_hours=1)
        totals = {r["name"]: r["n"] for r in self.read().groupBy("name").agg(F.sum("rows").alias("n")).collect()}
        return {name: totals.get(name, 0) for name in tables}
