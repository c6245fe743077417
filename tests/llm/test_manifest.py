"""Merkle manifest against a plain tree over all rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from eventlake.llm import manifest as m
from eventlake.llm.common import table

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def leaf_of(r, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        trees[s] = levels_of([x[2] for x in by[s]])
    upper = levels_of([trees[s][-1][0] for s in names])

    def up(levels, at, now):
        proof = ""
        for level in levels[:-1]:
            run = level[at // 3 * 3 : at // 3 * 3 + 3]
            proof += "".join(h for i, h in enumerate(run) if i != at % 3)
            now, at = sha(*[now if i == at % 3 else h for i, h in enumerate(run)]), at // 3
        return proof, now

    out = []
    for g, s in enumerate(names):
        for at, (_, _, leaf, r) in enumerate(by[s]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            one, now = up(trees[s], at, leaf_of(r, text))
            two, now = up(upper, g, now)
            out.append((r["doc_id"], leaf, trees[s][-1][0], upper[-1][0], sha(one + two), now, now == upper[-1][0]))
    return sorted(out, key=str)


def result(docs, levels=2):
    done = m.manifest(docs, m.FIELDS, "source", "doc_id", {"text": m.tampered()}, levels)
    assert done.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in done.collect()], key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_many_sizes(spark, levels):
    rows, n = [], 0
    for g, size in enumerate([1, 2, 3, 4, 9, 10, 27, 28, 82, 85]):
        for _ in range(size):
            rows.append((n, f"a\nb {n}" if n % 3 else "plain", "en", f"s{g}", n))
            n += 1
    docs = spark.createDataFrame(rows, KIND)
    assert result(docs, levels) == brute([r.asDict() for r in docs.collect()])


def test_odd_rows(spark):
    rows = [(None, "x\n", None, None, None), (None, "x\n", None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "ñ\n" * 20000, "es", "é", 5), (-7, "\n", "", "", 1), (3, "\n\n", "en", "Z", 1), (4, "z", "en", "z", 1)]
    docs = spark.createDataFrame(rows, KIND).withColumns({"hash": F.lit(1), "pos": F.lit("x"), "root": F.lit(2), "grp": F.lit(0)})
    assert result(docs) == brute([r.asDict() for r in docs.collect()])
    assert result(docs.limit(0)) == []


def test_hot_group_and_clean_rows(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a\nb").otherwise("ab").alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.lit(3).cast("long").alias("n_chars"))
    got = result(docs, 3)
    assert got == brute([r.asDict() for r in docs.collect()])
    changed = {i for i in range(0, 4000, 2) if zlib.crc32(str(i).encode()) % 2 == 0}
    assert {r[0] for r in got if not r[6]} == changed


def test_states_fold_like_whole_runs():
    p = m.Parent(["a" * 64, "b" * 64, "c" * 64])
    assert p.hash == sha("a" * 64, "b" * 64, "c" * 64) and p.fold(1, "d" * 64) == sha("a" * 64, "d" * 64, "c" * 64) and len(p.states) == 3


def test_registered_query(spark):
    rows = m.q_manifest(spark, "/root/testdata/sf0.001").collect()
    assert sorted([tuple(r) for r in rows], key=str) == brute([r.asDict() for r in table(spark, "/root/testdata/sf0.001", "documents").collect()])
