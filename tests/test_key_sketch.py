"""Key sketches: never a key missed, few days looked at in vain, no key read for new ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SMOKE_SF
from eventlake import queries
from eventlake.sinks import writers as w
from eventlake.sinks.key_sketch import BITS_PER_KEY, ROW_BITS, KeySketch, rows_for


def keyed(spark, first, last, day):
    return spark.range(first, last).select(F.col("id").cast("string").alias("event_id"), F.lit(dt.date.fromisoformat(day)).alias("event_date"))


def test_no_key_is_missed_and_few_are_suspected_falsely(spark, tmp_root):
    sketch = KeySketch(spark, f"{tmp_root}/t", "event_id", "event_date")
    known = keyed(spark, 0, 20000, "2024-01-01").unionByName(keyed(spark, 20000, 30000, "2024-01-02"))
    assert sketch.add(known) == {"2024-01-01": 20000, "2024-01-02": 10000}
    found = sketch.suspects(known).collect()
    assert {(r["key"], r["day"]) for r in found} >= {(str(i), "2024-01-01" if i < 20000 else "2024-01-02") for i in range(30000)}
    # ids among the known ones' range in text order, none of them known
    other = spark.range(100000, 200000).select(F.concat(F.lit("1"), F.col("id").cast("string"), F.lit("x")).alias("event_id"))
    false = sketch.suspects(other).count()
    assert false < 2 * 100000 * 0.002, false


def test_size_of_a_sketch():
    for n in (1, 10, 1000, 12345):
        bits = rows_for(n) * ROW_BITS
        assert n * BITS_PER_KEY <= max(bits, ROW_BITS) and bits <= max(2 * n * BITS_PER_KEY, 2 * ROW_BITS)


def test_keys_beyond_a_days_range_are_not_probed(spark, tmp_root):
    sketch = KeySketch(spark, f"{tmp_root}/t", "event_id", "event_date")
    sketch.add(keyed(spark, 1000, 2000, "2024-01-01"))
    sketch.add(keyed(spark, 2000, 3000, "2024-01-02"))
    assert sketch.suspect_days(keyed(spark, 3000, 4000, "2024-01-03")) == []
    assert sketch.suspect_days(keyed(spark, 2500, 2501, "2024-01-09")) == ["2024-01-02"]
    assert sketch.suspect_days(keyed(spark, 0, 0, "2024-01-03")) == []
    assert sketch.suspect_days(spark.createDataFrame([(None,)], "event_id string")) == []


def test_a_fresh_batch_reads_no_key_of_other_days(spark, tmp_root):
    """The plan of the rows to insert has no scan of the target at all."""
    path = f"{tmp_root}/bronze"
    w.merge_insert_only(spark, keyed(spark, 1000, 2000, "2024-01-01"), path)
    fresh = keyed(spark, 5000, 6000, "2024-01-02")
    suspects = w.key_sketch(spark, path).suspect_days(fresh)
    plan = w.with_held_day(spark, fresh, path, "event_id", "event_date", suspects)._jdf.queryExecution().executedPlan().toString()
    assert suspects == [] and "FileScan" not in plan and "Join" not in plan
    again = keyed(spark, 1500, 2500, "2024-01-05")
    plan = w.with_held_day(spark, again, path, "event_id", "event_date", w.key_sketch(spark, path).suspect_days(again))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(event_date" in plan and "ReadSchema: struct<event_id:string>" in plan


def test_false_days_are_counted(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    w.merge_insert_only(spark, keyed(spark, 0, 3000, "2024-01-01"), path)
    w.merge_insert_only(spark, keyed(spark, 3000, 4000, "2024-01-02"), path)
    w.key_sketch(spark, path).add(keyed(spark, 7000, 7100, "2024-01-02"))  # a write that failed after its sketch
    done = w.merge_insert_only(spark, keyed(spark, 7050, 7150, "2024-01-03"), path)
    assert (done["inserted"], done["suspects"], done["false"]) == (100, 1, 1)
    done = w.merge_insert_only(spark, keyed(spark, 0, 10, "2024-01-03"), path)
    assert (done["inserted"], done["false"]) == (0, 0)
    assert spark.read.parquet(path).count() == 4100


def test_a_table_without_sketches_gets_them(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    w.create_table(keyed(spark, 0, 100, "2024-01-01"), path)
    assert w.merge_insert_only(spark, keyed(spark, 50, 150, "2024-01-02"), path)["inserted"] == 50
    assert w.key_sketch(spark, path).exists()


def test_sketches_of_a_day_are_put_together(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    for i in range(3):
        w.merge_insert_only(spark, keyed(spark, 100 * i, 100 * i + 100, "2024-01-01"), path)
    sketch = w.key_sketch(spark, path)
    assert len(sketch.sketches()) == 3
    sketch.rebuild(spark.read.parquet(path), "2024-01-01")  # all younger than a day: they stay
    assert len(sketch.sketches()) == 3
    sketch.rebuild(spark.read.parquet(path), "2024-01-01", settled_hours=0)
    assert [s.keys for s in sketch.sketches()] == [300]
    assert w.merge_insert_only(spark, keyed(spark, 0, 310, "2024-01-02"), path)["inserted"] == 10


def test_history_is_not_read_by_a_batch_of_the_fixture(spark, tmp_root):
    path = f"{tmp_root}/bronze"
    valid = queries.bronze_valid_df(spark, SMOKE_SF)
    late = F.col("event_date") > F.to_date(F.lit(queries.BATCH_UNTIL))
    w.merge_insert_only(spark, valid.filter(~late), path)
    done = w.merge_insert_only(spark, valid.filter(late), path)
    assert done["inserted"] == valid.filter(late).count() and done["suspects"] == done["false"] <= 2


def test_a_small_batch_is_probed_and_written_without_a_shuffle_of_sketches(spark, tmp_root):
    from eventlake.sinks.key_sketch import FEW_DAYS, FEW_ROWS, DayKeys, few

    assert few({"2024-01-01": DayKeys(FEW_ROWS, "a", "b")}) and few({})
    assert not few({"2024-01-01": DayKeys(FEW_ROWS, "a", "b"), "2024-01-02": DayKeys(1, "c", "c")})
    assert not few({str(i): DayKeys(1, "a", "a") for i in range(FEW_DAYS + 1)})
    path = f"{tmp_root}/t"
    assert w.merge_insert_only(spark, keyed(spark, 0, 40000, "2024-01-01"), path)["few"] is False
    done = w.merge_insert_only(spark, keyed(spark, 39990, 40010, "2024-01-02"), path)
    assert (done["few"], done["inserted"], done["suspects"]) == (True, 10, 1)
    sketch = w.key_sketch(spark, path)
    plans = [sketch._probe(keyed(spark, 5, 9, "2024-01-03"), sketch.sketches(), small)._jdf.queryExecution().analyzed().toString() for small in (False, True)]
    assert [p.count("strategy=broadcast") for p in plans] == [1, 2]  # the index's lines; the batch's keys too
    assert sketch.suspect_days(keyed(spark, 5, 9, "2024-01-03"), days=sketch.days_in(keyed(spark, 5, 9, "2024-01-03"))) == ["2024-01-01"]
    assert spark.read.parquet(path).count() == spark.read.parquet(path).select("event_id").distinct().count() == 40010
