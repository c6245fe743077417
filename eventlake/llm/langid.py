"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams, most
frequent first.  A document's own list, made of its whole text, is compared
with each profile: every n-gram costs the difference of its two ranks, or the
profile's length where the profile lacks it.  The nearest profile wins.

N-grams (1 to 3 letters, a blank for what is between words) are packed into
64-bit numbers, 21 bits a code point (a blank is code point 1), so that numpy counts them by sorting.
Profiles are learned from the first ``per_language`` documents of each language
in a seeded hash order.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if no language could be learned.  Equal distances go to the
smaller language name, equal counts to the smaller n-gram.  Repeated rows each
get an answer; null ids and null languages are not learned from.  Columns of
other names pass through, those named as the results are replaced; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import crc_fold, small_batches, spare, table

PROFILE = 400
PER_LANGUAGE = 500
DEALT = 128  # parts of a language in the choice of ids
UNDETERMINED = "und"
BLANK = 1  # no letter


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 for what is no letter."""
    out = np.zeros(0x110000, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low[0])
    return out


def grams(text: str, letters: np.ndarray) -> np.ndarray:
    """All n-grams of the text, packed, in no order.  Runs of other characters
    count as one blank; a blank alone or inside an n-gram is left out."""
    codes = letters[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
    codes = np.concatenate([[0], codes, [0]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = codes[keep]
    if len(codes) == 1:  # no letter at all
        return codes[:0]
    codes[codes == 0] = BLANK
    two = codes[:-1] << 21 | codes[1:]
    three = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[codes[1:-1] != BLANK]
    return np.concatenate([codes[codes != BLANK], two, three])


def counted(text: str, letters: np.ndarray, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and counts; a long text is counted piece by piece, with
    two characters of overlap taken off again, so that memory stays bounded."""
    if len(text) <= piece:
        return np.unique(grams(text, letters), return_counts=True)
    total_keys, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = 0
    while at < len(text):
        end = min(len(text), at + piece)
        while end < len(text) and letters[ord(text[end - 1])]:  # to the end of a word
            end += 1
        keys, n = np.unique(grams(text[at:end], letters), return_counts=True)
        merged, where = np.unique(np.concatenate([total_keys, keys]), return_inverse=True)
        total = np.bincount(where, np.concatenate([total, n]), len(merged)).astype(np.int64)
        total_keys, at = merged, end
    return total_keys, total


def ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` most frequent n-grams, ties to the smaller one."""
    if len(keys) > 4 * most:  # leave the clearly rare ones out before sorting
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.argsort(-counts, kind="stable")[:most]]  # keys come sorted


class Profiles:
    """All languages' profiles as one table of n-grams by languages."""

    def __init__(self, by_language: dict[str, list[int]], length: int = PROFILE):
        self.by_language = by_language
        self.names = sorted(by_language)
        self.length = length
        self.keys = np.unique(np.array([k for v in by_language.values() for k in v], np.int64))
        self.rank = np.full((len(self.keys) + 1, len(self.names)), -1, np.int32)  # the last row: in no profile
        for j, name in enumerate(self.names):
            self.rank[np.searchsorted(self.keys, np.array(by_language[name], np.int64)), j] = np.arange(len(by_language[name]))

    def identify(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        if text is None or not self.names:
            return UNDETERMINED, 0.0
        keys, counts = counted(text, letters)
        if not len(keys):
            return UNDETERMINED, 0.0
        top = ranked(keys, counts, self.length)
        at = np.searchsorted(self.keys, top)
        at[at == len(self.keys)] = 0
        rank = self.rank[np.where(self.keys[at] == top, at, len(self.keys))]
        cost = np.where(rank < 0, self.length, np.abs(rank - np.arange(len(top))[:, None])).sum(0)
        best = int(cost.argmin())
        return self.names[best], float(1 - cost[best] / (self.length * len(top)))


def learn_profiles(docs: DataFrame, learn: Column, letters=None, per_language: int = PER_LANGUAGE, length: int = PROFILE, seed: int = 8) -> Profiles:
    """Profiles of the languages in ``lang``; ``learn`` is a condition on ``_key``.

    Ids are chosen without texts, first within ``DEALT`` parts of a language and
    then among the parts' choices: the last task of a language sees at most
    ``DEALT * per_language`` narrow rows (all of them where there are fewer).
    The chosen texts are counted on the executors and summed in a shuffle;
    ``length`` n-grams a language reach the driver.
    """
    spark = docs.sparkSession
    letters = letters or spark.sparkContext.broadcast(letter_table())
    rows = docs.select(F.col("doc_id").alias("_key"), F.col("lang").alias("_lang"), F.col("text").alias("_text"))
    ids = rows.where(learn & F.col("_lang").isNotNull()).select("_key", "_lang", F.xxhash64(F.lit(seed), "_key").alias("_hash"))
    for parts in (F.pmod("_hash", F.lit(DEALT)), F.lit(0)):
        order = Window.partitionBy("_lang", "_part").orderBy("_hash", "_key")
        ids = ids.withColumn("_part", parts).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language).drop("_n", "_part")
    # per_language rows of an id and a name for each language
    chosen = rows.join(F.broadcast(ids.select("_key", "_lang").distinct()), ["_key", "_lang"]).select("_lang", "_text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("_lang")["_text"]:
                parts = [counted(t, letters.value) for t in texts if t]
                if parts:
                    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    yield pd.DataFrame({"_lang": name, "_gram": keys, "_n": np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)})

    summed = chosen.mapInPandas(count, "_lang string, _gram long, _n long").groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n"))
    first = Window.partitionBy("_lang").orderBy(F.desc("_n"), "_gram")
    found = summed.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= length).select("_lang", "_gram", "_rank").collect()
    by_language: dict[str, list[int]] = {}
    for r in sorted(found, key=lambda r: r["_rank"]):
        by_language.setdefault(r["_lang"], []).append(r["_gram"])
    return Profiles(by_language, length)


def identify_language(docs: DataFrame, profiles: Profiles, letters=None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (1: the profile's own order)."""
    spark = docs.sparkSession
    small_batches(spark)
    letters = letters or spark.sparkContext.broadcast(letter_table())
    # some kilobytes a language; plain values, as a worker may not know the class
    shared = spark.sparkContext.broadcast((profiles.by_language, profiles.length))

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Profiles(*shared.value)
        for batch in batches:
            found = [known.identify(t, letters.value) for t in batch]
            yield pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}, index=batch.index)

    told = spare(docs, "_language")
    done = docs.withColumn(told, run(F.col(f"`{text}`")))
    return done.withColumns({"lang_pred": F.col(f"{told}.lang_pred"), "score": F.col(f"{told}.score")}).drop(told)


def classify_language(docs: DataFrame, folds: int = 4, fold: int = 2, **fit) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``."""
    letters = docs.sparkSession.sparkContext.broadcast(letter_table())
    profiles = learn_profiles(docs, crc_fold(F.col("_key"), folds) != fold, letters, **fit)
    return identify_language(docs, profiles, letters).withColumn("held_out", F.coalesce(crc_fold(F.col("doc_id"), folds) == fold, F.lit(False)))


def with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have letters; their language fills a null
    ``lang``.  Other columns pass through, whatever their names."""
    own = ("text", "lang")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]).alias("_row"), "doc_id", *own)
    told = classify_language(rows)
    known = F.nullif(F.col("lang_pred"), F.lit(UNDETERMINED))
    kept = told.where(known.isNotNull() | F.col("text").rlike(r"\p{L}"))
    return kept.select(*[{"lang": F.coalesce("lang", known), "text": F.col("text")}.get(c.lower(), F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_language(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")
