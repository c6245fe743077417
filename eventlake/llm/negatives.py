"""Hard negatives by a secondary-sort shuffle.

An anchor's positives are its best scored rows of the same label; a hard
negative of a positive is a row of another label whose score lies in a window
below the positive's.  Scores are inner products of vectors of whole numbers.

Every pair's score is computed where its row is (``shards``), and what can
matter goes on: of a shard the best positives of an anchor, and, once the
positives are known, the first negatives of each positive's window.  No pair
that a shard holds back can be in the result, as the shard has as many before
it.  The pairs are packed into keys of bytes, (anchor, falling score, id), and
shuffled with ``repartitionAndSortWithinPartitions``; an iterator runs over the
sorted keys, opens a window when a positive comes by and gives out the negatives
that follow until the window is full.  It holds the open windows of one anchor
only, never an anchor's pairs.

Defined results: rows with a null id, label or vector, or with a component that
is null or not finite, take no part; vectors are filled up with zeros to the
longest; a repeated id's rows are all candidates (never of their own id), its
anchor is the smallest by label and vector; equal scores go by the smaller id;
scores beyond 2^55 count as 2^55; without anchors, positives or negatives there
are no rows; other columns take no part.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table
from .shards import ask_shards

MOST = 1 << 55
KEY = ">QQBQ"
FLIP = 1 << 63  # makes signed numbers sort as unsigned ones


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 10
    low: int = 30  # the window, in hundredths of the positive's score
    high: int = 90
    shard: int = 16384  # rows of a shard, about
    scale: int = 256


def pack(anchor: int, score: int, negative: bool, other: int) -> bytes:
    """A key: anchors apart, higher scores first, positives before negatives of
    their score (a window may begin there), smaller ids first."""
    return struct.pack(KEY, anchor + FLIP, FLIP - 1 - score, negative, other + FLIP)


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, other = struct.unpack(KEY, key)
    return anchor - FLIP, FLIP - 1 - score, bool(negative), other - FLIP


def mine_windows(keys: Iterable[bytes], mining: Mining) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive's score, negative's score)
    from sorted keys."""
    at, windows = None, []
    for key in keys:
        anchor, score, negative, other = unpack(key)
        if anchor != at:
            at, windows = anchor, []
        if not negative:
            windows.append([other, score, 0])
            continue
        for w in windows:
            if mining.low * w[1] <= 100 * score <= mining.high * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], other, w[1], score
        windows = [w for w in windows if w[2] < mining.negatives and mining.low * w[1] <= 100 * score]


def usable(rows: DataFrame, vec: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(id, label, vec) of the rows that take part; labels as the mining has them."""
    v = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vec}`").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)))


def whole(vectors: pd.Series, scale: int) -> np.ndarray:
    """The vectors' whole numbers, as doubles, filled up to one length."""
    width = max([len(v) for v in vectors], default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(scale * out)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held at ``MOST``."""
    width = min(a.shape[1], b.shape[1])  # what the other lacks is zero
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * width < 2.0**53:
        return (a @ b.T).astype(np.int64)
    number = np.vectorize(int, otypes=[object])
    return np.clip(number(a) @ number(b).T, -MOST, MOST).astype(np.int64)


def first(scores: np.ndarray, among: np.ndarray, most: int) -> np.ndarray:
    """The places ``among`` (ascending) with the highest scores, ties to the first."""
    if len(among) > most:
        least = np.partition(scores[among], len(among) - most)[len(among) - most]
        above, same = among[scores[among] > least], among[scores[among] == least]
        among = np.concatenate([above, same[: most - len(above)]])
    return among


def _prepare(mining: Mining):
    def run(rows: pd.DataFrame):
        return rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), whole(rows["vec"], mining.scale)

    return run


def positives_of(rows: DataFrame, anchors: DataFrame, mining: Mining) -> DataFrame:
    """anchor, score, id of every anchor's positives."""

    def run(shard, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        ids, labels, vectors = shard
        for a in range(0, len(asked), 256):
            part = asked.iloc[a : a + 256]
            scores = inner(whole(part["vec"], mining.scale), vectors)
            for j, (own, label) in enumerate(zip(part["id"], part["label"], strict=True)):
                best = first(scores[j], np.flatnonzero((labels == label) & (ids != own)), mining.positives)
                yield pd.DataFrame({"anchor": own, "score": scores[j][best], "id": ids[best]})

    found = ask_shards(rows, anchors, mining.shard, ["id"], _prepare(mining), run, "anchor long, score long, id long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= mining.positives).drop("n")


def keys_of_negatives(rows: DataFrame, anchors: DataFrame, mining: Mining) -> DataFrame:
    """Keys of all pairs that may be in a window; ``anchors`` have ``scores``,
    their positives'."""

    def run(shard, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        ids, labels, vectors = shard
        for a in range(0, len(asked), 256):
            part, keys = asked.iloc[a : a + 256], []
            scores = inner(whole(part["vec"], mining.scale), vectors)
            for j, (own, label, windows) in enumerate(zip(part["id"], part["label"], part["scores"], strict=True)):
                mine, picked = scores[j], set()
                other = (labels != label) & (ids != own)
                for s in {int(s) for s in windows}:
                    inside = np.flatnonzero(other & (100 * mine >= mining.low * s) & (100 * mine <= mining.high * s))
                    picked.update(first(mine, inside, mining.negatives).tolist())
                keys += [pack(int(own), int(mine[i]), True, int(ids[i])) for i in picked]
            yield pd.DataFrame({"key": keys})

    return ask_shards(rows, anchors, mining.shard, ["id"], _prepare(mining), run, "key binary")


def hard_negatives(rows: DataFrame, anchor: Column | str, mining: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score; ``rows`` as ``usable`` gives them, ``anchor``: a condition
    on ``id``."""
    spark = rows.sparkSession
    rows = cut(rows)
    chosen = rows.where(anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")
    positives = cut(positives_of(rows, chosen, mining))
    windows = positives.groupBy("anchor").agg(F.collect_list("score").alias("scores"))  # a few of each anchor
    asked = chosen.join(windows, chosen["id"] == windows["anchor"]).select("id", "label", "vec", "scores")
    negatives = keys_of_negatives(rows, asked, mining).rdd.map(lambda r: (bytes(r[0]), None))
    known = positives.rdd.map(lambda r: (pack(r["anchor"], r["score"], False, r["id"]), None))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # crc32 of the packed anchor: the same on every worker
    ordered = negatives.union(known).repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    mined = ordered.mapPartitions(lambda pairs: mine_windows((key for key, _ in pairs), mining))
    return spark.createDataFrame(mined, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", verifySchema=False)


def q_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


SQL_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 10
"""
