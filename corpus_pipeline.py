"""A training corpus from raw documents, stage by stage.

Quality classifier, language identification, SimHash near-duplicates, mixing to
target weights and SentencePiece encoding.  Each stage is a function of
(spark, docs, sf_dir); its result is written as Parquet and read again before
the next one, so that a lost executor repeats one stage's tasks only.  All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import langid, mixing, quality, sentence_pieces, simhash
from eventlake.llm.common import table
from eventlake.session import scratch_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of other rows, accepts.

    Each row is judged by its own text: repeats are kept or go together, null
    and empty texts are judged as empty ones; an empty table stays empty; other
    columns, ``score`` among them, pass through.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, whose language can be told; it fills a null ``lang``.

    Where no language can be learned (no row has a ``lang``) nothing can be
    told: texts with letters stay, and a null ``lang`` stays null.  Texts that
    are null or have no letter go; repeats are treated alike; other columns
    pass through.
    """
    return langid.with_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id
    (null last).  Null and empty texts are near-duplicates of each other; of
    repeated rows one stays."""
    return simhash.one_of_each(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of domains, languages and sources uses them.

    A null ``lang`` or ``source`` is a name of its own; documents without words
    take no tokens and stay; repeated rows share their uses.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents; a null text has none (null), an empty one no
    ids; each repeated row is encoded."""
    return sentence_pieces.encode_pieces(docs).select("doc_id", "lang", "source", "n_tokens", "parity", "round_trip", "token_ids")


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentence_pieces", encode),
]

#: A learned classifier and n-gram profiles have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
