"""Queries and DuckDB oracles of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, contamination, langid, licenses, manifest, mixing, negatives, quality, search, sentence_pieces, simhash, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentence_pieces": sentence_pieces.q_sentence_pieces,
    "op2_quality_classifier": quality.q_quality,
    "op3_chat_formatting": chat.q_chat,
    "op4_nearest_neighbours": search.q_nearest,
    "op5_hamming_top_k": search.q_hamming,
    "op6_source_mixing": mixing.q_mixing,
    "op7_license_scan": licenses.q_licenses,
    "op8_language_id": langid.q_language,
    "op9_simhash": simhash.q_simhash,
    "op10_token_counts": token_counts.q_token_counts,
    "op11_hard_negatives": negatives.q_negatives,
    "op12_contamination": contamination.q_contamination,
    "op13_manifest": manifest.q_manifest,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_formatting": chat.SQL_CHAT,
        "op4_nearest_neighbours": search.SQL_NEAREST,
        "op5_hamming_top_k": search.SQL_HAMMING,
        "op6_source_mixing": mixing.sql_mixing(),
        "op7_license_scan": licenses.sql_licenses(),
        "op11_hard_negatives": negatives.SQL_NEGATIVES,
        "op12_contamination": contamination.sql_contamination(),
        "op13_manifest": manifest.sql_manifest(),
    }
