"""Two vector searches: queries sent to shards of rows.

Rows are dealt once into shards of a bounded size, whatever the number of
queries; queries, the smaller side, come to every shard as a stream of batches
(``shards``).  A shard's index is built once, and each query gets the best
``k`` of the shard; a last step keeps the best ``k`` of all shards.  Which shard
a row is in does not depend on its values, so equal vectors spread evenly, and
a lost task is done again from the checkpointed rows.

``nearest`` (approximate, Euclidean): rotated one-bit codes.  Vectors are
centred, filled up with zeros to ``pad`` times their length, rotated at random
and kept as their signs, with two numbers each: the length and the inner
product of the unit vector with its code.  The longer the code, the closer its
estimate.  A query's inner products with all codes give estimates of its
distances and, with the confidence ``epsilon``, bounds of their errors.  The
``k`` best estimates are measured on the original vectors; the others follow by
rising lower bound, and as the k-th measured distance shrinks, the search ends
at the first bound beyond it.

``hamming_nearest`` (exact, binary codes): incremental multi-index hashing.
Codes travel packed.  They are cut into segments, each with a table of the
shard's rows by value.  Search radii of the segments grow one segment at a
time; all rows not yet seen differ by more than the radius in every segment, so
once the k-th verified distance is no larger than the sum that this proves, the
search ends.

Defined results: rows that are null, empty, of zeros only, or with null or
non-finite components take no part, nor do null ids; a query is compared with
the rows of its own length only (others have no distance to it); ties go to the
smaller id; of repeated ids each row is a candidate, and the query is the
smallest of its vectors; fewer than ``k`` candidates: all; an empty table gives
no rows; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table
from .shards import ask_shards


@dataclass(frozen=True)
class Search:
    k: int = 10
    shard: int = 16384  # rows of a shard, about
    sample: int = 10000  # rows that the centres are fitted on
    pad: int = 4  # bits of a code for each component
    step: int = 64  # rows measured between two looks at the threshold
    epsilon: float = 2.5  # error bound, in standard deviations
    seed: int = 4


def usable(rows: DataFrame, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    v = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vec}`").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))


def queries_of(rows: DataFrame, query: Column | str) -> DataFrame:
    """One row for each id for which ``query`` holds: its smallest vector."""
    return rows.where(query).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rotation(dims: int, seed: int, pad: int = 1) -> np.ndarray:
    """What a random rotation in ``pad * dims`` dimensions does to vectors
    filled up with zeros: (dims, pad * dims), rows of length 1 at right angles."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims * pad, dims)))
    return (q * np.sign(np.diag(r))).T


@dataclass
class Codes:
    """One-bit codes of a shard."""

    bits: np.ndarray  # (n, code length / 8) packed signs
    length: np.ndarray  # of the centred vectors
    inner: np.ndarray  # of unit vectors and their codes


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> Codes:
    moved = vectors - centre
    length = np.sqrt((moved**2).sum(1))
    unit = moved / np.where(length > 0, length, 1)[:, None] @ turn
    return Codes(np.packbits(unit > 0, axis=1), length, np.where(length > 0, np.abs(unit).sum(1) / np.sqrt(unit.shape[1]), 1.0))


def bounds(codes: Codes, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, epsilon: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the estimated squared distances and their lower bounds."""
    dims = turn.shape[1]
    moved = queries - centre
    sizes = np.sqrt((moved**2).sum(1))
    units = (moved / np.where(sizes > 0, sizes, 1)[:, None] @ turn).astype(np.float32)
    signs = np.unpackbits(codes.bits, axis=1, count=dims).astype(np.float32) * 2 - 1
    error = np.sqrt(np.maximum(1 - codes.inner**2, 0)) / codes.inner * epsilon / np.sqrt(max(dims - 1, 1))
    for met, size in zip(units @ signs.T / np.sqrt(dims), sizes, strict=True):
        cosine = met / codes.inner
        base, cross = codes.length**2 + size**2, 2 * codes.length * size
        yield base - cross * cosine, base - cross * (cosine + error)


def measure(vectors: np.ndarray, query: np.ndarray, estimate: np.ndarray, low: np.ndarray, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, distances) of all rows that were measured, in the order of rows.
    Infinite estimates: rows that are no candidates."""
    n = min(k, int(np.isfinite(estimate).sum()))
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0)

    def far(at: np.ndarray) -> np.ndarray:
        return np.sqrt(((vectors[at] - query) ** 2).sum(1))

    rows = np.argpartition(estimate, n - 1)[:n]
    dists = far(rows)
    limit = lambda: np.partition(dists, n - 1)[n - 1] ** 2 * (1 + 1e-9)
    left = np.flatnonzero(low <= limit())
    left = np.setdiff1d(left, rows)
    left = left[np.argsort(low[left], kind="stable")]
    for a in range(0, len(left), step):
        part = left[a : a + step]
        part = part[low[part] <= limit()]
        if not len(part):
            break
        rows, dists = np.concatenate([rows, part]), np.concatenate([dists, far(part)])
    order = np.argsort(rows)
    return rows[order], dists[order]


def by_length(vectors: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
    """Each length of the vectors, and the places of those that have it."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    for n in np.unique(sizes):
        yield int(n), np.flatnonzero(sizes == n)


def nearest(rows: DataFrame, query: Column | str, search: Search = Search(), vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of every row for which
    ``query`` (a condition on ``vec_id``) holds, itself left out."""
    good = cut(usable(rows, vec, key))
    sample = pd.Series([r["vec"] for r in good.orderBy(F.xxhash64(F.lit(search.seed), "vec_id"), "vec_id").limit(search.sample).collect()], dtype=object)
    # a length that the sample lacks has its centre at zero: bounds stay right, only wider
    centres = {n: np.stack(sample.iloc[at].to_numpy()).astype(np.float64).mean(0) for n, at in by_length(sample)}
    fitted = good.sparkSession.sparkContext.broadcast(centres)

    def prepare(shard: pd.DataFrame):
        index = {}
        for n, at in by_length(shard["vec"]):
            vectors = np.stack(shard["vec"].iloc[at].to_numpy()).astype(np.float64)
            centre, turn = fitted.value.get(n, np.zeros(n)), rotation(n, search.seed, search.pad)
            index[n] = shard["vec_id"].to_numpy(np.int64)[at], vectors, centre, turn, encode(vectors, centre, turn)
        return index

    def answer(index, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for n, at in by_length(asked["vec"]):
            if n not in index:
                continue
            ids, vectors, centre, turn, codes = index[n]
            for a in range(0, len(at), 256):
                part = asked.iloc[at[a : a + 256]]
                asks, out = np.stack(part["vec"].to_numpy()).astype(np.float64), []
                for own, ask, (estimate, low) in zip(part["vec_id"], asks, bounds(codes, asks, centre, turn, search.epsilon), strict=True):
                    seen, dists = measure(vectors, ask, np.where(ids == own, np.inf, estimate), np.where(ids == own, np.inf, low), search.k, search.step)
                    top = np.argsort(dists, kind="stable")[: search.k]  # rows are in the order of ids
                    out.append(pd.DataFrame({"query_id": own, "vec_id": ids[seen[top]], "score": dists[top], "measured": len(seen)}))
                yield pd.concat(out)

    found = ask_shards(good, queries_of(good, query), search.shard, ["vec_id"], prepare, answer, "query_id long, vec_id long, score double, measured long")
    return best(found, search.k).select("query_id", "rank", "vec_id", "score", "measured")


# Exact search of binary codes


def sign_codes(rows: DataFrame, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, vec): the vectors' signs as binary codes, 1 for positive."""
    good = usable(rows, vec, key)
    return good.select("vec_id", F.transform("vec", lambda x: F.when(x > 0, 1).otherwise(0).cast("tinyint")).alias("vec"))


class SegmentTables:
    """Multi-index of packed codes: for each segment the rows by value."""

    def __init__(self, bits: np.ndarray):
        self.n, self.dims = bits.shape
        # segments of about log2(n) bits: a value then has about one row
        width = int(np.clip(round(np.log2(max(self.n, 2))), 4, 16))
        self.count = max(1, -(-self.dims // width))
        edges = np.linspace(0, self.dims, self.count + 1).round().astype(int)
        self.edges = list(zip(edges[:-1], edges[1:], strict=True))
        self.packed = np.packbits(bits, axis=1)
        self.order, self.starts = [], []
        for a, b in self.edges:
            values = self.value(bits, a, b)
            self.order.append(np.argsort(values, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << (b - a)))]))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def value(bits: np.ndarray, a: int, b: int) -> np.ndarray:
        return bits[..., a:b].astype(np.int64) @ (1 << np.arange(b - a))

    def ball(self, width: int, radius: int) -> np.ndarray:
        """All numbers of ``width`` bits with ``radius`` bits set."""
        if (width, radius) not in self.masks:
            every = np.arange(1 << width)
            self.masks[width, radius] = every[np.bitwise_count(every) == radius]
        return self.masks[width, radius]

    def search(self, query: np.ndarray, k: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, distances, rows verified): the nearest ``k`` rows not in
        ``skip``, nearest first, ties to the smaller row; all if fewer."""
        packed = np.packbits(query)
        seen = np.zeros(self.n, bool)
        seen[skip] = True
        left = self.n - int(seen.sum())
        k = min(k, left)
        rows, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        values = [int(self.value(query, a, b)) for a, b in self.edges]
        for radius in range(max(b - a for a, b in self.edges) + 1):
            for s, (a, b) in enumerate(self.edges):
                if radius > b - a:
                    continue
                probes = values[s] ^ self.ball(b - a, radius)
                begin, size = self.starts[s][probes], self.starts[s][probes + 1] - self.starts[s][probes]
                hit = size > 0
                begin, size = begin[hit], size[hit]
                if len(size):
                    ends = np.cumsum(size)
                    new = self.order[s][np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)]
                    new = new[~seen[new]]
                    seen[new] = True
                    rows = np.concatenate([rows, new])
                    far = np.concatenate([far, np.bitwise_count(self.packed[new] ^ packed).sum(1, dtype=np.int64)])
                # segments up to s are searched to radius, the others to radius - 1
                proved = (s + 1) * (radius + 1) + (self.count - s - 1) * radius - 1
                if k == 0 or len(far) >= k and np.partition(far, k - 1)[k - 1] <= proved:
                    top = np.lexsort([rows, far])[:k]
                    return rows[top], far[top], len(rows)
        top = np.lexsort([rows, far])[:k]
        return rows[top], far[top], len(rows)


def packed(codes: DataFrame) -> DataFrame:
    """(vec_id, n, vec): the codes' lengths, and eight of their bits in a byte."""

    @F.pandas_udf("binary")
    def pack(vec: pd.Series) -> pd.Series:
        return vec.map(lambda v: np.packbits(np.asarray(v, np.uint8)).tobytes())

    return codes.select("vec_id", F.size("vec").alias("n"), pack("vec").alias("vec"))


def unpacked(codes: pd.Series, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1, count=n)


def hamming_nearest(codes: DataFrame, query: Column | str, search: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id, distance (bits that differ): exact top k of
    binary codes ``vec`` (arrays of 0 and 1)."""
    rows = cut(packed(codes))
    asked = rows.where(query).groupBy("vec_id").agg(F.min(F.struct("vec", "n")).alias("x")).select("vec_id", "x.n", "x.vec")

    def prepare(shard: pd.DataFrame):
        return {n: (part["vec_id"].to_numpy(np.int64), SegmentTables(unpacked(part["vec"], n))) for n, part in shard.groupby("n")}

    def answer(index, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for n, part in asked.groupby("n"):
            if n not in index:
                continue
            (ids, tables), out = index[n], []
            for own, vec in zip(part["vec_id"].to_numpy(np.int64), unpacked(part["vec"], n), strict=True):
                mine = np.arange(np.searchsorted(ids, own), np.searchsorted(ids, own, "right"))
                at, far, verified = tables.search(vec, search.k, mine)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids[at], "score": far, "verified": verified}))
            yield pd.concat(out)

    found = ask_shards(rows, asked, search.shard, ["vec_id"], prepare, answer, "query_id long, vec_id long, score long, verified long")
    return best(found, search.k).select("query_id", "rank", "vec_id", F.col("score").alias("distance"), "verified")


def probes_within(width: int, radius: int) -> int:
    """Table look-ups of one segment up to a radius."""
    return sum(comb(width, r) for r in range(radius + 1))


def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0).drop("measured")


def q_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_nearest(sign_codes(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0).drop("verified")


_GOOD = """good AS (SELECT vec_id, embedding AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)))"""

SQL_NEAREST = f"""
WITH {_GOOD},
p AS (SELECT a.vec_id AS query_id, b.vec_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))) AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id))::INTEGER AS rank, vec_id, score FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10
"""

SQL_HAMMING = f"""
WITH {_GOOD}, c AS (SELECT vec_id, list_transform(v, lambda x: x > 0) AS s FROM good),
p AS (SELECT a.vec_id AS query_id, b.vec_id, len(list_filter(list_zip(a.s, b.s), lambda z: z[1] <> z[2]))::BIGINT AS distance
  FROM c a JOIN c b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank, vec_id, distance FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) <= 10
"""
