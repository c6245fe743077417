"""Bloom sketches of a table's keys, day by day (W2, W3, ST5).

A merge must know whether a key is in the table already, on whatever day.  The
sketches answer that for nearly all keys without reading any: every write adds
a sketch of its keys for each day it writes to, and a merge probes the sketches
of all days, then reads the keys of the days that may hold one of its own.

A sketch is rows of a table: 256 bits each, in four numbers, made by a grouped
``bit_or`` (combined before the shuffle) and probed by an equi-join, all in
built-in functions.  A key sets eight bits of one row.  Beside the bits a small
file names each sketch with its day, number of rows, and smallest and largest
key: a key outside these is not even probed, which leaves most days out where
ids grow with time.

A sketch is stored before the rows it stands for.  A write that fails in between
leaves bits of keys that are not there, which costs a look at the day's keys and
never a wrong answer; the other way round could insert a key twice.

A small write to be followed by many others, as a stream's are, leaves a list of its
keys by day in place of bits.  The list is open until the rows are there, then
settled by a change of its name.  A key in a settled list is in the table, which
need not be looked at for it; one in an open list may be.  Lists are kept in memory
by the writing process; when there are ``LISTS`` of them they are put together as
a file of keys, and ``FILES`` files as a larger one, so that a table written by many
small batches has few files to look into.  Whatever takes rows out of the table
opens all lists again (``doubt``).
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sinks import files

BITS_PER_KEY = 24
ROW_BITS = 256
WORDS = ["b0", "b1", "b2", "b3"]

#: Rows, and days of them, that one task writes as fast as many would.
FEW_ROWS, FEW_DAYS = 1 << 15, 64

#: Lists of keys, and files of a size, that are put together; so are lists of more keys, or more characters, than that.
LISTS, LISTED_KEYS, LISTED_CHARS, FILES = 128, 1 << 18, 1 << 24, 16

OPEN, SETTLED = ".open.json", ".json"

#: The index's files as they were read, by folder: none of them changes.
_READ: dict[str, dict[str, dict]] = {}


@dataclass(frozen=True)
class DayKeys:
    """What a batch has for a day."""

    rows: int
    least: str | None
    most: str | None


@dataclass(frozen=True)
class Sketch:
    """One write's sketch of one day; without rows of bits, a list of its keys."""

    day: str
    name: str
    rows: int
    keys: int
    least: str
    most: str
    made: float


def few(days: dict[str, DayKeys]) -> bool:
    """Whether a batch is so small that dealing its rows out costs more than it saves."""
    return len(days) <= FEW_DAYS and sum(d.rows for d in days.values()) <= FEW_ROWS


def rows_for(keys: int) -> int:
    """A power of two that gives each key ``BITS_PER_KEY`` bits or more."""
    return 1 << max(0, math.ceil(math.log2(max(1, keys) * BITS_PER_KEY / ROW_BITS)))


def key_words(key: Column) -> list[Column]:
    """The eight bits of a key, two in each of four numbers."""
    spread = F.xxhash64(F.lit(7), key)
    one = F.lit(1).cast("long")
    bit = [F.call_function("shiftleft", one, F.shiftright(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(8)]
    return [bit[2 * j].bitwiseOR(bit[2 * j + 1]) for j in range(4)]


class KeySketch:
    """The sketches of the table at ``path``, in a folder beside it."""

    def __init__(self, spark: SparkSession, path: str, key: str, day: str):
        self.spark, self.key, self.day = spark, key, day
        self.root = f"{path.rstrip('/')}.keys"

    def _key(self) -> Column:
        return F.col(self.key).cast("string")

    def _entries(self) -> dict[str, dict]:
        """The index's files by name."""
        folder = f"{self.root}/index"
        names = [n for n in files.list_children(self.spark, folder) if n.endswith(SETTLED)]
        if folder not in _READ and len(_READ) >= 64:
            _READ.clear()
        known = _READ.get(folder, {})
        _READ[folder] = {n: known.get(n) or self._entry(f"{folder}/{n}") for n in names}
        return _READ[folder]

    def _entry(self, path: str) -> dict:
        entry = json.loads(files.read_text(self.spark, path))
        entry["listed"] = {day: frozenset(keys) for day, keys in entry.get("listed", {}).items()}
        entry["chars"] = sum(len(k) for keys in entry["listed"].values() for k in keys)
        return entry

    def sketches(self) -> list[Sketch]:
        """All live sketches: a few short lines for each write and day."""
        entries = self._entries()
        gone = {tuple(x) for e in entries.values() for x in e.get("replaces", [])}
        return [Sketch(**s) for e in entries.values() for s in e["sketches"] if (s["day"], s["name"]) not in gone]

    def exists(self) -> bool:
        return files.path_exists(self.spark, f"{self.root}/index")

    def days_in(self, rows: DataFrame) -> dict[str, DayKeys]:
        """Rows, smallest and largest key of each day of a batch."""
        found = rows.groupBy(self.day).agg(F.count(F.lit(1)).alias("n"), F.min(self._key()).alias("lo"), F.max(self._key()).alias("hi"))
        return {str(r[self.day]): DayKeys(r["n"], r["lo"], r["hi"]) for r in found.collect()}  # a row for each day

    @staticmethod
    def days_of(keys: list[tuple[str | None, str]]) -> dict[str, DayKeys]:
        """``days_in`` of a small batch's (key, day)."""
        by_day: dict[str, list] = {}
        for k, day in keys:
            by_day.setdefault(day, []).append(k)
        known = {day: [k for k in its if k is not None] for day, its in by_day.items()}
        return {day: DayKeys(len(its), min(known[day], default=None), max(known[day], default=None)) for day, its in by_day.items()}

    def add(self, rows: DataFrame, days: dict[str, DayKeys] | None = None, replaces: list[Sketch] | None = None) -> dict[str, int]:
        """Sketch the keys of ``rows`` under each of their days; rows of each day.

        ``days``: what ``days_in`` gave of these rows or of more.  ``rows`` is read
        again; the caller keeps it.  Nothing is stored for no rows.
        """
        days = self.days_in(rows) if days is None else days
        name, now = uuid.uuid4().hex, time.time()
        made = [Sketch(day, name, rows_for(d.rows), d.rows, d.least, d.most, now) for day, d in days.items() if d.least is not None]
        if made:
            size = F.create_map(*[x for s in made for x in (F.lit(s.day), F.lit(s.rows))])
            keyed = (rows.coalesce(1) if few(days) else rows).where(self._key().isNotNull()).select(F.col(self.day).cast("string").alias("day"), self._key().alias("k"))
            placed = keyed.select("day", F.pmod(F.xxhash64("k"), size[F.col("day")].cast("long")).cast("int").alias("row"), *[w.alias(n) for w, n in zip(key_words(F.col("k")), WORDS, strict=True)])
            bits = placed.groupBy("day", "row").agg(*[F.bit_or(w).alias(w) for w in WORDS])
            (bits if few(days) else bits.hint("rebalance", "day")).write.parquet(f"{self.root}/bits/name={name}")
        if made or replaces:
            entry = {"sketches": [vars(s) for s in made], "replaces": [[s.day, s.name] for s in replaces or []]}
            files.write_text(self.spark, f"{self.root}/index/{name}.json", json.dumps(entry))
        return {day: d.rows for day, d in days.items()}

    def suspects(self, rows: DataFrame) -> DataFrame:
        """(key, day) for every day that may hold a key of ``rows``; no key
        column of the table is read."""
        live = self.sketches()
        found = self._probe(rows, live).select(F.col("k").alias("key"), "day")
        if listed := [s for s in live if not s.rows]:
            found = found.unionByName(rows.select(self._key().alias("key")).join(self._keys(listed).withColumnRenamed("k", "key"), "key"))
        return found.distinct()

    def _probe(self, rows: DataFrame, live: list[Sketch], small: bool = False) -> DataFrame:
        """Keys of ``rows`` (k) beside the days that may hold them; those of a
        ``small`` batch are sent to the sketches, which are not shuffled then.
        Lists are not looked at."""
        live = [s for s in live if s.rows]
        keys = rows.select(self._key().alias("k")).where("k is not null")
        if not live:
            return keys.select("k", F.lit(None).cast("string").alias("day")).where("false")
        sizes = F.array(*[F.lit(n) for n in sorted({s.rows for s in live})])
        asked = keys.select("k", *[w.alias(f"k_{n}") for w, n in zip(key_words(F.col("k")), WORDS, strict=True)], F.explode(sizes).alias("rows"))
        asked = asked.withColumn("row", F.pmod(F.xxhash64("k"), F.col("rows").cast("long")).cast("int"))
        stored = self.spark.read.schema("day string, row int, " + ", ".join(f"{w} bigint" for w in WORDS) + ", name string").parquet(f"{self.root}/bits")
        stored = stored.where(F.col("name").isin(sorted({s.name for s in live})) & F.col("day").isin(sorted({s.day for s in live})))
        # a line for each sketch: a batch's keys are dealt once for each size of a
        # sketch, not once for each day
        known = self.spark.createDataFrame([(s.day, s.name, s.rows, s.least, s.most) for s in live], "day string, name string, rows int, lo string, hi string")
        stored = stored.join(F.broadcast(known), ["day", "name"])
        met = (F.broadcast(asked) if small else asked).join(stored, ["rows", "row"]).where("k >= lo and k <= hi")
        held = [F.col(f"k_{n}").bitwiseAND(F.col(n)) == F.col(f"k_{n}") for n in WORDS]
        return met.where(held[0] & held[1] & held[2] & held[3])

    def suspect_days(self, rows: DataFrame, within: list[str] | None = None, days: dict[str, DayKeys] | None = None, lists: bool = True) -> list[str]:
        """Days that may hold a key of ``rows``, oldest first.  ``days``: what
        ``days_in`` gave of the rows, which leaves out sketches beyond their keys.
        Without ``lists``, days that only a list has are left out."""
        live = [s for s in self.sketches() if lists or s.rows]
        if within is not None:
            live = [s for s in live if s.day in within]
        if live:
            known = list(days.values()) if days is not None else [DayKeys(1, *rows.agg(F.min(self._key()), F.max(self._key())).first())]
            known = [d for d in known if d.least is not None]
            live = [s for s in live if any(s.least <= d.most and s.most >= d.least for d in known)]
        found = set()
        if any(s.rows for s in live):
            found |= {r[0] for r in self._probe(rows, live, days is not None and few(days)).select("day").distinct().collect()}
        if listed := [s for s in live if not s.rows]:
            found |= {r[0] for r in self._keys(listed).join(rows.select(self._key().alias("k")), "k", "left_semi").select("day").distinct().collect()}
        return sorted(found)

    # ---- lists of keys -----------------------------------------------------------

    def _filed(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema("k string, day string, name string").option("basePath", f"{self.root}/listed").parquet(*[f"{self.root}/listed/name={n}" for n in names])

    def _keys(self, listed: list[Sketch]) -> DataFrame:
        """Keys (k) and days of lists and of files of them."""
        wanted, entries = {(s.day, s.name) for s in listed}, self._entries()
        held = [(k, s["day"]) for e in entries.values() if e["listed"] for s in e["sketches"] if (s["day"], s["name"]) in wanted for k in e["listed"][s["day"]]]
        keys = self.spark.createDataFrame(held, "k string, day string")
        if names := sorted({e["name"] for e in entries.values() if "level" in e} & {name for _, name in wanted}):
            keep = self.spark.createDataFrame(sorted(x for x in wanted if x[1] in names), "day string, name string")
            keys = keys.unionByName(self._filed(names).join(F.broadcast(keep), ["day", "name"], "left_semi").select("k", "day"))
        return keys

    def held(self, rows: DataFrame, keys: set[str], there: set[str], within: list[str] | None = None) -> tuple[set[str], set[str]]:
        """Of a small batch's ``keys``, those that settled lists have, and days that
        open lists name for others.  ``there``: days the table has."""
        entries = self._entries()
        live = {(s.day, s.name) for s in self.sketches() if not s.rows and (within is None or s.day in within)}
        if any(day not in there for n, e in entries.items() if not n.endswith(OPEN) for day in {s["day"] for s in e["sketches"] if not s["rows"]}):
            self.doubt()  # a day was taken away
            entries = self._entries()
        met, files_of = [], {}
        for file, e in entries.items():
            if e["listed"]:
                name = e["sketches"][0]["name"]
                met += [(k, day, name, file) for day, its in e["listed"].items() if (day, name) in live for k in keys & its]
            elif "level" in e and any((s["day"], s["name"]) in live for s in e["sketches"]):
                files_of[e["name"]] = file
        if files_of:
            mine = rows.select(self._key().alias("k"))
            found = self._filed(sorted(files_of)).join(F.broadcast(mine), "k", "left_semi").collect()  # at most the batch's keys
            met += [(r["k"], r["day"], r["name"], files_of[r["name"]]) for r in found if (r["day"], r["name"]) in live]
        sure = {k for k, _, _, file in met if not file.endswith(OPEN)}
        return sure, {day for k, day, _, file in met if file.endswith(OPEN) and k not in sure}

    def list_keys(self, keys: list[tuple[str | None, str]]) -> str:
        """An open list of a small write's keys (key, day); its name, to settle it by."""
        listed: dict[str, list[str]] = {}
        for k, day in keys:
            if k is not None:
                listed.setdefault(str(day), []).append(k)
        name, now = uuid.uuid4().hex, time.time()
        made = [vars(Sketch(day, name, 0, len(its), min(its), max(its), now)) for day, its in listed.items()]
        if made:
            files.write_text(self.spark, f"{self.root}/index/{name}{OPEN}", json.dumps({"sketches": made, "listed": listed}))
        return name if made else ""

    def settle(self, name: str) -> None:
        """The rows of an open list are in the table."""
        if not name:
            return
        index = f"{self.root}/index/{name}"
        files.rename_file(self.spark, index + OPEN, index + SETTLED)
        entries = self._entries()
        lists = {n: e for n, e in entries.items() if e["listed"] and not n.endswith(OPEN)}
        many = sum(s["keys"] for e in lists.values() for s in e["sketches"]) >= LISTED_KEYS
        if many or len(lists) >= LISTS or sum(e["chars"] for e in lists.values()) >= LISTED_CHARS:
            keys = [(k, day) for e in lists.values() for day, its in e["listed"].items() for k in its]
            self._file(self.spark.createDataFrame(keys, "k string, day string").coalesce(1), lists, 1)
            level = 1
            while len(filed := {n: e for n, e in self._entries().items() if e.get("level") == level and not n.endswith(OPEN)}) >= FILES:
                self._file(self._filed(sorted(e["name"] for e in filed.values())).select("k", "day"), filed, level + 1)
                level += 1

    def _file(self, keys: DataFrame, of: dict[str, dict], level: int) -> None:
        """A file of keys in the place of settled lists or files."""
        name, now, by_day = uuid.uuid4().hex, time.time(), {}
        keys.write.parquet(f"{self.root}/listed/name={name}")
        old = [s for e in of.values() for s in e["sketches"]]
        for s in old:
            by_day.setdefault(s["day"], []).append(s)
        made = [vars(Sketch(day, name, 0, sum(s["keys"] for s in its), min(s["least"] for s in its), max(s["most"] for s in its), now)) for day, its in by_day.items()]
        entry = {"sketches": made, "level": level, "name": name, "replaces": [[s["day"], s["name"]] for s in old]}
        files.write_text(self.spark, f"{self.root}/index/{name}{SETTLED}", json.dumps(entry))
        for file, e in of.items():
            files.delete_path(self.spark, f"{self.root}/index/{file}")
            if "level" in e:
                files.delete_path(self.spark, f"{self.root}/listed/name={e['name']}")

    def doubt(self) -> None:
        """Rows were taken out of the table: what the lists have may not be there."""
        for file, e in self._entries().items():
            if (e["listed"] or "level" in e) and not file.endswith(OPEN):
                at = f"{self.root}/index/{file}"
                files.rename_file(self.spark, at, at.removesuffix(SETTLED) + OPEN)

    def rebuild(self, table: DataFrame, day: str, settled_hours: float = 24.0) -> None:
        """One sketch for a day in place of those made over ``settled_hours`` ago,
        from the day's keys; younger ones may stand for rows not yet visible."""
        old = [s for s in self.sketches() if s.day == day and time.time() - s.made >= settled_hours * 3600]
        if len(old) > 1:
            self.add(table.where(F.col(self.day) == F.lit(day).cast("date")).select(self.key, self.day), replaces=old)
