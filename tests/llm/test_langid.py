"""Language identification against a plain rank-order comparison."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import langid
from eventlake.llm.common import table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def letters():
    return langid.letter_table()


def plain_grams(text: str) -> Counter:
    """By characters: words of letters between blanks, n-grams of 1 to 3."""
    line = "".join(c.lower()[0] if c.isalpha() else " " for c in f" {text} ")
    line = " " + " ".join(line.split()) + " "
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            g = line[i : i + n]
            if g.strip() and (n < 3 or g[1] != " "):
                out[g] += 1
    return out


def pack(g: str) -> int:
    return sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))


TEXTS = ["The cat sat.", "a", "Äpfel & Öl, größer!", "x1y2z3", "日本 語 text", "  many   blanks ", "İstanbul K", "aaa aaa aaa", "𐐀𐐨 deseret"]


@pytest.mark.parametrize("text", TEXTS)
def test_grams_and_ranks(text, letters):
    keys, counts = langid.counted(text, letters)
    want = Counter({pack(g): n for g, n in plain_grams(text).items()})
    got = {int(k): int(n) for k, n in zip(keys, counts, strict=True)}
    assert got == want
    top = langid.ranked(keys, counts, 5).tolist()
    assert top == sorted(got, key=lambda k: (-got[k], k))[:5]


def test_pieces_of_a_long_text_count_like_the_whole(letters):
    text = "the quick (brown) fox über größer " * 300
    whole = langid.counted(text, letters)
    parts = langid.counted(text, letters, piece=101)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_distance_is_out_of_place(letters):
    profiles = langid.Profiles({"a": [1, 2, 3], "b": [3, 2, 1], "c": []}, 3)
    text = "ab"
    keys, counts = langid.counted(text, letters)
    top = langid.ranked(keys, counts, 3).tolist()
    profiles = langid.Profiles({"same": top, "turned": top[::-1], "none": []}, 3)
    assert profiles.identify(text, letters) == ("same", 1.0)
    assert profiles.identify("!! 12", letters) == ("und", 0.0)
    assert profiles.identify(None, letters) == ("und", 0.0)
    assert langid.Profiles({}, 3).identify(text, letters) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    out = langid.classify_language(docs)
    rows = out.where("held_out").select("lang", "lang_pred").collect()
    assert len(rows) > 1000 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_odd_rows(spark):
    data = [(1, "the cat and the dog", "en", 1.0), (1, "the cat and the dog", "en", 1.0), (2, None, "en", 0.0), (3, "12 !!", "en", 0.0), (None, "der hund", None, 0.0), (5, "", "de", 0.0), (6, "la casa", "es", 0.0), (8, "the " * 50000, "en", 0.0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, score double")
    out = langid.classify_language(docs).collect()
    assert len(out) == 8
    und = {r["doc_id"] for r in out if r["lang_pred"] == "und"}
    assert und >= {2, 3, 5} and all(0 <= r["score"] <= 1 for r in out)
    assert langid.classify_language(docs.limit(0)).count() == 0
    unlearned = langid.classify_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}
