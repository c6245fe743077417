"""SimHash near-duplicates by multi-index hashing.

Fingerprints: words between ASCII blanks, lower-cased (A-Z), hashed as
shingles with repeats; a bit is set if it is set in over half of the hashes.

Links: equal fingerprints become one node.  A fingerprint is cut into halves;
two that differ in at most ``max_bits`` <= 3 bits differ in at most one bit of
a half.  Each half is stored in a table by its value; a probe goes out for the
half itself and for every value that one bit less makes (a Hamming ball of
radius one, each pair met from the side that has the bit).  Matches are kept if
the complete distance is small enough.  Nodes linked to each other, by any
chain, form a group.

Defined results: null and empty texts have fingerprint 0 and are linked like
others; ``component_id`` is the smallest non-null doc_id of the group (null if
all are null); repeated rows each get a row; an empty table gives no rows;
other columns of the documents pass through ``one_of_each`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, small_batches, spare, table
from .components import components

SHINGLE = 3
MAX_BITS = 2


def fingerprint(text: str | None, words: int = SHINGLE, piece: int = 1 << 18) -> int:
    """The 64-bit fingerprint as a signed number."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, piece):
        here = parts[a : min(a + piece, n) + words - 1]
        shingles = map(b" ".join, zip(*[here[i:] for i in range(words)], strict=False)) if len(here) >= words else [b" ".join(here)]
        hashes = np.array([xxh64_intdigest(s, 42) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp`` (bigint)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], texts.index, "int64")

    return docs.withColumn("fp", run(F.col(f"`{text}`")))


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints in ``nodes.fp`` that differ in at
    most ``max_bits`` bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("halves with a ball of radius one cover up to 3 bits")
    half = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))]
    values = nodes.select("fp", F.posexplode(F.array(*half)).alias("seg", "value"))
    below = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.col("value").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i))), lambda bit: bit != 0)
    balls = values.select(F.col("fp").alias("a"), "seg", F.explode(F.concat(F.array("value"), F.transform(below, lambda bit: F.col("value").bitwiseXOR(bit)))).alias("probe"), F.col("value").alias("own"))
    met = balls.join(values.withColumnRenamed("fp", "b").withColumnRenamed("value", "probe"), ["seg", "probe"])
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # an equal half is met from both sides, a smaller one from one side only
    return met.where((F.col("a") != F.col("b")) & (apart <= max_bits) & ((F.col("probe") != F.col("own")) | (F.col("a") < F.col("b")))).select("a", "b").distinct()


def groups(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) for each fingerprint of ``rows`` (doc_id, fp)."""
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return cut(rooted.join(least, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, words: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row of ``docs``."""
    rows = cut(fingerprints(docs.select("doc_id", "text"), words=words).select("doc_id", "fp"))
    return rows.join(groups(rows, max_bits), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS, words: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with
    the smallest doc_id (null last), ties to the smaller text hash."""
    hashed = docs.select("doc_id", "text").withColumn("_th", F.xxhash64("text"))
    rows = cut(fingerprints(hashed, words=words).select("doc_id", "_th", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th")).alias("first")
    kept = rows.join(groups(rows, max_bits).select("fp", "root"), "fp").groupBy("root").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first._th").alias("_kth"))
    th = spare(docs, "_th")
    mine = docs.withColumn(th, F.xxhash64("text"))
    found = mine.join(kept, mine["doc_id"].eqNullSafe(kept["_id"]) & (mine[th] == kept["_kth"]), "left_semi")
    return found.dropDuplicates(["doc_id", th]).drop(th)


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
