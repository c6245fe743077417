"""Quality classifier: held-out accuracy, whole texts, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import quality
from eventlake.llm.common import crc_fold, table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def small_net():
    rng = np.random.default_rng(1)
    words = ["the", "of", "and", "ing", "tion", "er"]
    clean = [" ".join(rng.choice(words, 80)).encode() for _ in range(150)]
    junk = [("!! ".join(w.upper() for w in rng.choice(words, 80))).encode() for _ in range(75)] + [(str(w) + " ").encode() * 60 for w in rng.choice(["asga", "der", "nichtst", "an", "pas,", "mente"], 75)]
    return quality.fit(clean + junk, np.array([1] * 150 + [0] * 150), quality.Recipe(epochs=20))


def test_fold_is_crc32_of_the_id(spark):
    rows = spark.range(200).select("id", crc_fold(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_learns_junk_that_it_has_not_seen(small_net):
    s = small_net.score([b"the of and ing the tion er of " * 9, b"THE!! OF!! AND!! ER!! " * 12, b"tiha " * 70])
    assert s[0] > 0.5 > max(s[1], s[2])


def test_long_texts_in_pieces_score_like_whole_ones(small_net):
    rng = np.random.default_rng(2)
    for n in (1, 255, 256, 257, 1020, 1024, 5000):
        text = bytes(rng.integers(32, 200, n).astype(np.uint8))
        whole = small_net.score([text])[0]
        assert small_net.score([text], most=512)[0] == pytest.approx(whole, abs=1e-5)


def test_a_score_does_not_depend_on_the_other_texts(small_net):
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 10, 240, 250, 256, 700)]
    alone = [small_net.score([t])[0] for t in texts]
    assert small_net.score(texts) == pytest.approx(alone, abs=1e-6) and small_net.score(texts[::-1])[::-1] == pytest.approx(alone, abs=1e-6)


def test_junk_at_the_end_of_a_long_text_counts(small_net):
    clean = b"the of and ing tion er " * 400
    both = small_net.score([clean, clean + b"THE!! OF!! AND!! ING!! " * 200])
    assert both[1] < both[0]


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = quality.classify_quality(docs, labels)
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.where("held_out").join(labels.select("doc_id", "quality"), "doc_id").select("quality", "predicted").collect()
    right = np.mean([r["quality"] == r["predicted"] for r in rows])
    kept = np.mean([r["predicted"] for r in rows if r["quality"] == 1])
    assert len(rows) > 500 and right > 0.97 and kept > 0.99


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, "the cat sat", 5.0), (1, "the cat sat", 5.0), (2, None, None), (None, "", 1.0), (3, "x" * 200000, 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify_quality(rows, labels, quality.Recipe(epochs=1)).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in out)
    empty = quality.classify_quality(rows.limit(0), labels)
    assert empty.count() == 0
    nothing = quality.classify_quality(rows, labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.5}
