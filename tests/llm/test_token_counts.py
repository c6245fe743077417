"""Separator scan against splitting whole files."""

import random

import numpy as np
import pytest
import tiktoken

from eventlake.llm import token_counts as tc
from eventlake.llm.common import table
from eventlake.session import scratch_dir


def plain(flat: list[int], end: int):
    out, start = [], 0
    for i, t in enumerate(flat):
        if t == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(flat) - start, False)] if start < len(flat) else [])


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_raw_files(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(tc, "RUN", 4)  # several runs of blocks in one file
    rng = random.Random(block)
    files = {"a": [9] * 5, "b": [1, 2, 3], "c": [], "d": [1] * 40 + [9], "e": [rng.choice([1, 2, 3, 9, 700]) for _ in range(500)], "f": [4] * 200}
    for name, flat in files.items():
        np.array(flat, "<u2").tofile(tmp_path / f"{name}.bin")
    blocks = tc.read_files(spark, f"file://{tmp_path}", block=block)
    got = {}
    for r in tc.count_tokens(blocks, end=9).collect():
        got.setdefault(r["file_id"].rsplit("/", 1)[1][0], []).append((r["seq"], r["start"], r["n_tokens"], r["closed"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(v, 9) for k, v in files.items() if v}


def test_a_texts_tokens_hold_no_separator():
    encoding = tiktoken.Encoding("ranks", pat_str=tc.PATTERN, mergeable_ranks=tc.load_ranks(), special_tokens={})
    assert tc.END not in tc.load_ranks().values()
    assert encoding.decode(encoding.encode_ordinary("<|endoftext|> é😀")) == "<|endoftext|> é😀"


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_table(spark, block):
    docs = table(spark, "/root/testdata/sf0.01", "documents").repartition(3)
    encoding = tiktoken.Encoding("ranks", pat_str=tc.PATTERN, mergeable_ranks=tc.load_ranks(), special_tokens={})
    want = {r["doc_id"]: len(encoding.encode_ordinary(r["text"])) for r in docs.select("doc_id", "text").collect()}
    blocks, manifest = tc.write_blocks(docs, scratch_dir(spark, "tokens"), block=block)
    rows = tc.count_tokens(blocks).join(manifest, ["file_id", "seq"]).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want and len(rows) == len(want)
    assert all(r["closed"] for r in rows)
    sizes = {len(r["tokens"]) for r in blocks.select("tokens").collect()}
    assert max(sizes) <= 2 * block and (block > 50 or len([s for s in sizes if s < 2 * block]) <= 3)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "a b", 3), (3, "a b", 3), (None, "c " * 100000, 4)], "doc_id long, text string, tokens int")
    blocks, manifest = tc.write_blocks(docs, scratch_dir(spark, "tokens"))
    rows = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in tc.count_tokens(blocks).join(manifest, ["file_id", "seq"]).collect())
    assert [r[0] for r in rows] == [0, 1, 2, 3, 3] and rows[1:3] == [(1, 0), (2, 0)] and rows[3] == rows[4] == (3, 2) and rows[0][1] > 50000
    empty, none = tc.write_blocks(docs.limit(0), scratch_dir(spark, "tokens"))
    assert tc.count_tokens(empty).count() == 0 and none.count() == 0
