"""License scan against a plain search."""

import re

import duckdb
import pytest

from eventlake.llm import licenses as lic
from eventlake.llm.common import table


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(p, label) for label, phrase in lic.BASE for p in range(len(words)) if words[p : p + len(phrase.split())] == phrase.split()]
    at = [p for p, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


BASE_COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
TEXTS = [
    None, "", "mit", "Released under the MIT License.", "UNDER--THE(MIT)LICENSE under the mit license", "under the mit, licenses", "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC 4.0 and CC BY NC", "cc by nc by nc cc by nc", "Änder the MIT License", "under the mit license " * 300, "é😀 ünder\x7fthe\x00mit_license cc by nc", "Know under the Kit license",
]


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    return {r["doc_id"]: r for r in lic.scan_licenses(docs).collect()}


def test_base_columns_by_plain_search(spark):
    got = scan(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        assert tuple(got[i][c] for c in BASE_COLUMNS) == plain(t), t
        assert set(filter(None, got[i]["base_labels"].split(","))) <= set(filter(None, got[i]["labels"].split(",")))


NOTICE = lic.NOTICES[0][1]


@pytest.mark.parametrize(
    "text, labels",
    [
        (NOTICE, "mit"),
        (NOTICE.upper().replace(" ", "\n * "), "mit"),
        (NOTICE.replace("any person", "any natural person"), "mit"),
        (NOTICE.replace("free of charge", "gratis"), "mit"),
        ("This work is licensed under the GNU General Public License, version 3", "gpl-3"),
        ("Permission is hereby granted to nobody", ""),
        ("the license of this software and the files of any person", ""),
        (" one two three ".join(re.findall(r"(?:\S+ ?){1,3}", NOTICE)), ""),
        (" ".join(NOTICE.split()[11:] + NOTICE.split()[:11]), ""),
        ("under the terms of the GNU Lesser General Public License", "lgpl"),
        ("Mozilla Public License, v. 2.0", "mpl"),
        ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("licensed under the apache license version 2 0 ... " + dict(lic.NOTICES[::-1])["bsd"], "apache-2,bsd"),
    ],
)
def test_notices_with_words_put_in_or_left_out(spark, text, labels):
    padded = "some words before it and " + text + " and some words after it"
    assert scan(spark, [padded])[0]["labels"] == labels


def test_every_notice_makes_its_own_label_only(spark):
    got = scan(spark, [f"see {phrase} here" for _, phrase in lic.NOTICES])
    for i, (label, _) in enumerate(lic.NOTICES):
        assert got[i]["labels"] == label and got[i]["score"] == 1


def test_a_span_drifts_so_far_and_no_further(spark):
    words = NOTICE.split()
    put_in = lambda n: " ".join(w + " x" * (i % 5 == 4 and i // 5 < n) for i, w in enumerate(words))
    scores = [scan(spark, [put_in(n)])[0]["score"] for n in range(4)]
    assert scores[0] == 1 and all(a > b for a, b in zip(scores, scores[1:], strict=False))


def test_very_long_text_is_read_to_its_end(spark):
    r = scan(spark, ["word " * 200000 + NOTICE])[0]
    assert (r["n_words"], r["labels"]) == (200000 + len(NOTICE.split()), "mit") and r["spans"][0]["start"] == 200000


def test_neighbouring_diagonals_make_one_span(spark):
    r = scan(spark, ["x y " + NOTICE.replace("copy of this", "copy of exactly this") + " z"])[0]
    assert [s["label"] for s in r["spans"]] == ["mit"] and r["spans"][0]["start"] == 2 and 0.8 < r["score"] <= 1


def test_rows_of_one_id_stay_apart(spark):
    docs = spark.createDataFrame([(1, "under the mit license"), (1, "under the mit license"), (1, "cc by nc"), (None, "x")], "doc_id long, text string")
    out = sorted((r["labels"], r["n_words"]) for r in lic.scan_licenses(docs).collect())
    assert out == [("", 1), ("cc-by-nc", 3), ("mit", 4), ("mit", 4)]
    assert lic.scan_licenses(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    lic.q_licenses(spark, "/root/testdata/sf0.01").explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_table_by_sql(spark):
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    rows = lic.q_licenses(spark, "/root/testdata/sf0.01")
    names = ", ".join(rows.columns)
    want = {r[0]: r for r in con.sql(f"select {names} from ({lic.sql_licenses()})").fetchall()}
    assert {r["doc_id"]: tuple(r) for r in rows.collect()} == want
    for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect():
        assert want[r["doc_id"]][1:6] == plain(r["text"])
