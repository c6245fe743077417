"""The corpus pipeline: every stage's decisions take effect on its own input."""

import importlib.util
import os
import sys

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import langid, mixing, quality, simhash
from eventlake.llm.common import table
from eventlake.llm.sentence_pieces import load_model

SF = "/root/testdata/sf0.01"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_stages_one_by_one(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        out.write.parquet(f"file://{tmp_path}/{name}")
        out = spark.read.parquet(f"file://{tmp_path}/{name}")
        kept[name] = [r["doc_id"] for r in out.collect()]
        assert set(kept[name]) <= set(before) and kept[name]
        if name == "quality":
            scored = quality.classify_quality(docs, table(spark, SF, "labels")).where("predicted = 1")
            assert sorted(kept[name]) == sorted(r["doc_id"] for r in scored.collect())
            clean = [r["doc_id"] for r in table(spark, SF, "labels").where("quality = 1").collect() if r["doc_id"] in before]
            assert len(set(clean) & set(kept[name])) > 0.99 * len(clean)
        if name == "language":
            assert len(kept[name]) == langid.classify_language(docs).where("lang_pred <> 'und'").count()
        if name == "near_duplicates":
            found = simhash.near_duplicates(docs)
            assert sorted(kept[name]) == sorted(r["component_id"] for r in found.select("component_id").distinct().collect())
        if name == "mixing":
            assert sorted(kept[name]) == sorted(r["doc_id"] for r in mixing.select_mix(docs).collect())
        if name == "sentence_pieces":
            library = sentencepiece.SentencePieceProcessor(model_proto=load_model())
            rows = out.collect()
            assert len(rows) == docs.count() and all(r["parity"] and r["round_trip"] for r in rows)
            assert all(r["token_ids"] == library.encode(before[r["doc_id"]]["text"]) for r in rows)
        else:
            docs = out
    again = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in again.collect()) == sorted(kept["sentence_pieces"])


def test_language_stage_drops_texts_without_letters(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "s", 7), (2, None, "en", "s", 0), (3, "12", "en", "s", 2), (5, "le chat", "fr", "s", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_language(spark, docs, SF).collect()) == [1, 5]


def test_language_stage_keeps_a_corpus_without_languages(spark):
    docs = spark.createDataFrame([(1, "the cat", None, "s", 7), (2, None, None, "s", 0), (3, "12", None, "s", 2), (5, "le chat", None, "s", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r["doc_id"], r["lang"]) for r in corpus_pipeline.keep_language(spark, docs, SF).collect()) == [(1, None), (5, None)]


def test_stages_pass_clashing_columns_through(spark):
    names = ["score", "held_out", "predicted", "lang_pred", "_language", "_row", "_th", "_pieces", "_quality", "fp", "_key", "_mix_th"]
    docs = table(spark, SF, "documents").where("doc_id < 300").withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        rows = docs.collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)


def test_registered_and_optional(spark, monkeypatch):
    spec = importlib.util.spec_from_file_location("entry_here", f"{ROOT}/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = entry.queries()
    assert "pipeline" in names and [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in names)] == []
    assert set(entry.oracle_sql()) <= set(names)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    less = entry.queries()
    assert "pipeline" not in less and not any(k.startswith("op1_") for k in less) and "bronze_valid" in less


def test_nothing_else_imports_the_subpackage():
    for top, _, files in os.walk(f"{ROOT}/eventlake"):
        if not top.endswith("/llm") and "/llm/" not in top:
            for f in files:
                if f.endswith(".py"):
                    assert "eventlake.llm" not in open(f"{top}/{f}").read()


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.where(F.lit(True)).count() == 0


def test_language_stage_fills_null_languages(spark):
    docs = table(spark, SF, "documents").where("lang is not null")
    some = docs.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    out = corpus_pipeline.keep_language(spark, some, SF)
    assert out.columns == docs.columns and out.where("lang is null").count() == 0
    true = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = out.where("doc_id % 3 = 0").collect()
    assert got and sum(true[r["doc_id"]] == r["lang"] for r in got) > 0.9 * len(got)
