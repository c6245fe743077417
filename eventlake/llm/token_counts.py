"""Token counts by a separator scan over flat token files.

A flat token file is a run of little-endian token ids without any index; every
document ends with an end-of-document id.  The file is read in blocks of fixed
size that know nothing of documents.  Each block is searched for separators in
one vectorised comparison, which gives the lengths between them, the tokens
before the first and those after the last.  A prefix scan over the blocks of a
file (in two levels, so that no task sees all blocks of a large file) tells how
many documents ended before a block and how many tokens are still open, which
joins the documents that cross borders.

``write_blocks`` makes such files of a documents table: one file for each
partition, stored as Parquet rows of a block each, with a manifest of the ids
in order beside it.  ``read_files`` reads raw binary files in the same form.

Defined results: null and empty texts are documents of 0 tokens; repeated rows
are documents of their own; tokens after the last separator of a file are a
document that is not closed; an empty file has no documents.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlake.session import scratch_dir

from .common import cut, small_batches, table, tokenizer_file

RANKS = "byte_bpe_50k.tiktoken"
END = 50256  # free in the vocabulary of RANKS
BLOCK = 1 << 16  # tokens
RUN = 1024  # blocks that the first level of the scan takes together

# Fixed value: the split pattern that belongs to the vocabulary of RANKS.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(path: str | None = None) -> dict[bytes, int]:
    with open(path or tokenizer_file(RANKS), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def token_blocks(docs: DataFrame, ranks: dict[bytes, int] | None = None, end: int = END, block: int = BLOCK, dtype: str = "<u2") -> DataFrame:
    """file_id, block_no, tokens (binary) and ids: the doc_ids whose separator
    lies in the block, for the manifest only.  A partition makes a file."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ranks or load_ranks())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        file_id, number, seq, held, size, total = TaskContext.get().partitionId(), 0, 0, [], 0, 0
        ends: deque[tuple[int, int | None]] = deque()  # place of each separator in the file, and its doc_id

        def pack(whole: int) -> Iterator[pd.DataFrame]:
            """Give out the first ``whole`` tokens held, in blocks."""
            nonlocal number, seq, held, size
            flat = np.concatenate(held)
            for a in range(0, whole, block):
                part, ids = flat[a : min(a + block, whole)], []
                while ends and ends[0][0] < number * block + len(part):
                    ids.append(ends.popleft()[1])
                yield pd.DataFrame({"file_id": [file_id], "block_no": [number], "tokens": [part.tobytes()], "first": [seq], "ids": [ids]})
                number, seq = number + 1, seq + len(ids)
            held, size = [flat[whole:]], len(flat) - whole

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = np.array([*encoding.encode_ordinary(text or ""), end], dtype)
                held.append(tokens)
                size, total = size + len(tokens), total + len(tokens)
                ends.append((total - 1, None if pd.isna(doc_id) else int(doc_id)))
                if size >= 8 * block:
                    yield from pack(size // block * block)
        if size:
            yield from pack(size)

    return docs.select("doc_id", "text").mapInPandas(run, "file_id int, block_no long, tokens binary, first long, ids array<long>")


def write_blocks(docs: DataFrame, path: str, **how) -> tuple[DataFrame, DataFrame]:
    """Token files under ``path``: (blocks, manifest) read back from there."""
    token_blocks(docs, **how).write.option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    manifest = stored.select("file_id", "first", F.posexplode("ids").alias("n", "doc_id")).select("file_id", (F.col("first") + F.col("n")).alias("seq"), "doc_id")
    return stored.select("file_id", "block_no", "tokens"), manifest


def read_files(spark: SparkSession, path: str, block: int = BLOCK, width: int = 2) -> DataFrame:
    """file_id (the path), block_no and tokens of raw token files; a file may
    have up to 2 GB, the size that Spark's binary reader takes."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file_id"), "content")
    size = block * width
    count = F.ceil(F.octet_length("content") / size).cast("int")
    cuts = files.where(F.octet_length("content") > 0).select("file_id", "content", F.explode(F.sequence(F.lit(0), count - 1)).alias("b"))
    return cuts.select("file_id", F.col("b").cast("long").alias("block_no"), F.substring("content", F.col("b") * size + 1, F.lit(size)).alias("tokens"))


def scan_blocks(blocks: DataFrame, end: int = END, dtype: str = "<u2") -> DataFrame:
    """file_id, block_no, n (tokens), starts and gaps (begin and length of what
    each separator ends, within the block) and tail (tokens after the last)."""

    @F.pandas_udf("n long, starts array<int>, gaps array<int>, tail long")
    def run(tokens: pd.Series) -> pd.DataFrame:
        out = []
        for raw in tokens:
            flat = np.frombuffer(raw, dtype)
            at = np.flatnonzero(flat == end)
            starts = np.concatenate([[0], at[:-1] + 1])[: len(at)]
            out.append((len(flat), starts.astype(np.int32), (at - starts).astype(np.int32), len(flat) - 1 - (at[-1] if len(at) else -1)))
        return pd.DataFrame(out, columns=["n", "starts", "gaps", "tail"])

    done = blocks.select("file_id", "block_no", run("tokens").alias("x"))
    return done.select("file_id", "block_no", "x.n", "x.starts", "x.gaps", "x.tail")


def prefix_scan(scanned: DataFrame) -> DataFrame:
    """``scanned`` with what came before each block of its file: tokens
    (``offset``), separators (``docs``) and open tokens (``carry``)."""
    rows = scanned.withColumns({"run": F.floor(F.col("block_no") / RUN), "k": F.size("gaps").cast("long")})
    order = Window.partitionBy("file_id", "run").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    upper = Window.partitionBy("file_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")

    def scan(df: DataFrame, over) -> DataFrame:
        # after: the tokens up to and with the last separator before here
        df = df.withColumns({"offset": F.coalesce(F.sum("n").over(over), zero), "docs": F.coalesce(F.sum("k").over(over), zero)})
        return df.withColumn("after", F.coalesce(F.max(F.when(F.col("k") > 0, F.col("offset") + F.col("n") - F.col("tail"))).over(over), zero))

    inner = scan(rows, order)
    closing = F.when(F.col("k") > 0, F.col("offset") + F.col("n") - F.col("tail"))
    runs = inner.groupBy("file_id", "run").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max(closing).alias("closed"))
    runs = runs.withColumn("tail", F.col("n") - F.coalesce("closed", zero))
    outer = scan(runs, upper).select("file_id", "run", F.col("offset").alias("o"), F.col("docs").alias("d"), F.col("after").alias("a"))
    met = inner.join(outer, ["file_id", "run"])
    last = F.when(F.col("docs") > 0, F.col("o") + F.col("after")).otherwise(F.col("a"))
    return met.select("file_id", "block_no", "n", "starts", "gaps", "tail", (F.col("o") + F.col("offset")).alias("offset"), (F.col("d") + F.col("docs")).alias("docs"), (F.col("o") + F.col("offset") - last).alias("carry"))


def count_tokens(blocks: DataFrame, end: int = END, dtype: str = "<u2") -> DataFrame:
    """file_id, seq, start, n_tokens and closed of every document in the files."""
    known = cut(prefix_scan(scan_blocks(blocks, end, dtype)))
    before = F.when(F.col("i") == 0, F.col("carry")).otherwise(0)
    closed = known.select("file_id", "offset", "docs", "carry", F.posexplode(F.arrays_zip("starts", "gaps")).alias("i", "x"))
    closed = closed.select("file_id", (F.col("docs") + F.col("i")).alias("seq"), (F.col("offset") + F.col("x.starts") - before).alias("start"), (F.col("x.gaps") + before).alias("n_tokens"), F.lit(True).alias("closed"))
    last = known.groupBy("file_id").agg(F.max("block_no").alias("block_no"))
    rest = F.when(F.size("gaps") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("tail"))
    tail = known.join(last, ["file_id", "block_no"]).select("file_id", (F.col("docs") + F.size("gaps")).alias("seq"), (F.col("offset") + F.col("n") - rest).alias("start"), rest.alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(tail.where("n_tokens > 0"))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, manifest = write_blocks(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-files"))
    return count_tokens(blocks).join(manifest, ["file_id", "seq"]).select("doc_id", "n_tokens", "file_id", "seq", "start")
