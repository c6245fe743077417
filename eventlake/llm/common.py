"""Small helpers shared by the operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import shared_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null key: null)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)).cast("int")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared checkpoint folder."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, as ``columns`` alone; other columns never clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, made of ``name``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the texts that one Arrow batch brings to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file; the folder is a setting."""
    return os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), name)
