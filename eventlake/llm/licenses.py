"""License scan by diagonal voting, with DataFrame functions only.

A text's words are rolled into k-grams; their hashes meet the k-grams of the
license templates in a broadcast join (the templates are a fixed, small list).
A hit at word p of the text and word t of a template votes for the diagonal
p - t.  Votes are merged over neighbouring diagonals (a few words put in or
left out): each diagonal d that has votes opens a span of the diagonals from d
to d + ``drift``, so that a span's drift is bounded as a whole, not from one
diagonal to the next.

A span is then verified.  The hits' words, not only their hashes, must be the
template's, and they must stand in the template's order: going through the
template, a hit counts only if it lies behind all before it.  Its score is the
number of words that the counting hits cover, of the longer of the template and
the stretch of text from the first to the last of them; words strewn over a
text make no license.  Of spans of one template within ``drift`` of each other
the best is reported.

Base phrases are templates too; all their words must stand on one diagonal.
Every text is read once; each row then stays under its own row number, so that
rows with one doc_id are never mixed.

Defined results: null text: empty, no words; repeated rows: one result each;
texts shorter than k words hold no phrase (every template has k words or more);
very long texts: a row for each of their words, in the task that read them, and
then for their hits only; overlapping places of a phrase all count; an empty
table gives no rows; columns other than doc_id and text take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

K = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, each with its label.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Words of public license notices, each with its label.  Where
# licenses share their wording, the words that tell them apart.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mit", "license identifier mit"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "license identifier apache 2 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "attribution sharealike 4 0 international"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("bsl", "boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


@dataclass(frozen=True)
class Scan:
    drift: int = 6  # diagonals that a span may reach over
    least: float = 0.7  # score of a notice that makes its label


def words_of(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession) -> DataFrame:
    """One row for each k-gram of each template: some hundred rows."""
    rows = []
    for tid, (base, (label, phrase)) in enumerate([(True, x) for x in BASE] + [(False, x) for x in NOTICES]):
        words = phrase.split()
        for at in range(len(words) - K + 1):
            gram = ", ".join(f"'{w}'" for w in words[at : at + K])
            rows.append(f"({tid}, '{label}', {str(base).lower()}, {len(words)}, {at}, array({gram}))")
    grams = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(tid, label, base, t_words, t_at, gram)")
    return grams.withColumn("hash", F.xxhash64(*[F.get("gram", F.lit(j)) for j in range(K)]))


def hits(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """For every row a first line without a template, and a line for each
    verified hit: row, doc_id, n_words, p and the template's columns."""
    words = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    rolled = F.transform(F.sequence(F.lit(0), n - K), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(K)]))
    none = F.array(F.lit(None).cast("long"))
    grams = words.withColumn("hashes", F.concat(none, F.when(n >= K, rolled).otherwise(F.array().cast("array<bigint>"))))
    rows = grams.select("row", "doc_id", "words", F.posexplode("hashes").alias("p", "hash"))
    met = rows.join(F.broadcast(templates), "hash", "left")
    same = F.get("words", F.col("p") - 1) == F.get("gram", F.lit(0))
    for j in range(1, K):
        same = same & (F.get("words", F.col("p") - 1 + j) == F.get("gram", F.lit(j)))
    found = met.where((F.col("p") == 0) | (F.col("tid").isNotNull() & same))
    return found.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), (F.col("p") - 1).alias("p"), "tid", "label", "base", "t_words", "t_at")


def verified(hits: Column, t_words: Column) -> Column:
    """(score, first) of a span: its hits (t_at, p) are gone through in the
    template's order, and those count that lie behind all before them."""
    none = F.lit(-K).cast("int")
    # done: the place of the template that was looked at last; t and p: the last hit that counts
    start = F.struct(none.alias("done"), none.alias("t"), none.alias("p"), F.lit(None).cast("int").alias("first"), F.lit(0).alias("covered"))

    def go_on(seen: Column, hit: Column) -> Column:
        counts = (hit["t_at"] > seen["done"]) & (hit["p"] > seen["p"])
        new = F.least(F.lit(K), hit["t_at"] - seen["t"], hit["p"] - seen["p"])
        went = (hit["t_at"], hit["p"], F.coalesce(seen["first"], hit["p"]), seen["covered"] + new)
        took = dict(zip(["t", "p", "first", "covered"], went, strict=True))
        return F.struct(hit["t_at"].alias("done"), *[F.when(counts, x).otherwise(seen[n]).alias(n) for n, x in took.items()])

    finish = lambda x: F.struct((x["covered"] / F.greatest(t_words, x["p"] + K - x["first"])).alias("score"), x["first"].alias("first"))
    return F.aggregate(F.array_sort(hits), start, go_on, finish)


def scan_licenses(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """One row for each row of ``docs``; ``spans`` holds the verified places
    (label, base, start, score) in order."""
    found = hits(docs, template_grams(docs.sparkSession)).repartition("row")  # all that follows keeps to it
    keys = ["row", "doc_id", "n_words", "tid", "label", "base", "t_words"]
    diagonal = (F.col("p") - F.col("t_at")).cast("int")
    # a base phrase counts at each place by itself
    reach = F.when(F.col("base"), 0).otherwise(scan.drift)
    votes = found.withColumn("diagonal", diagonal).select("*", F.explode(F.when(F.col("tid").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.col("diagonal") - reach, "diagonal"))).alias("start"))
    hit = F.struct(F.col("t_at").cast("int").alias("t_at"), F.col("p").cast("int").alias("p"))
    opened = votes.groupBy(*keys, "start").agg(F.min("diagonal").alias("least"), F.collect_set(hit).alias("hits"))
    opened = opened.where(F.col("tid").isNull() | (F.col("least") == F.col("start")))  # diagonals without votes open nothing
    scored = opened.withColumn("x", F.when(F.col("tid").isNotNull(), verified(F.col("hits"), F.col("t_words"))))
    scored = scored.select(*keys, "start", F.coalesce("x.score", F.lit(0.0)).alias("score"))
    near = Window.partitionBy("row", "tid").orderBy("start")
    before = F.max("score").over(near.rangeBetween(-scan.drift, -1))
    after = F.max("score").over(near.rangeBetween(1, scan.drift))
    best = F.col("base") | (F.col("score") > F.coalesce(before, F.lit(-1.0))) & (F.col("score") >= F.coalesce(after, F.lit(-1.0)))
    scored = scored.withColumn("best", best)
    base = F.col("base") & (F.col("score") == 1)
    named = base | ~F.col("base") & (F.col("score") >= scan.least)
    names = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    place = F.struct("start", "label", "base", "score")
    return scored.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(named).alias("labels"),
        F.max("score").alias("score"),
        F.array_sort(F.collect_list(F.when(named & F.col("best"), place))).alias("spans"),
    ).drop("row")


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def sql_licenses() -> str:
    """By DuckDB, put otherwise: base phrases are sought word by word, and a
    notice's span by the furthest place reached so far and the gaps between."""
    values = lambda rows: ", ".join(f"({tid}, '{label}', string_split('{phrase}', ' '))" for tid, (label, phrase) in enumerate(rows))
    upper = "".join(map(chr, range(65, 91)))
    scan = Scan()
    return rf"""
WITH bases(tid, label, w) AS (VALUES {values(BASE)}), notices(tid, label, w) AS (VALUES {values(NOTICES)}),
dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w FROM documents),
b AS (SELECT r, label, unnest(list_filter(range(0, greatest(len(dw.w) - len(b.w) + 1, 0)), lambda p: dw.w[p+1 : p+len(b.w)] = b.w)) AS p FROM dw, bases b),
bg AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS names FROM b GROUP BY r),
part AS (SELECT max(score) AS score, r FROM (
    SELECT r, tid, diagonal, len(list_distinct(flatten(list(range(t, t + {K}))))) / any_value(n)::DOUBLE AS score
    FROM (SELECT r, tid, n, t, p - t AS diagonal FROM (SELECT r, unnest(range(0, greatest(len(w) - {K - 1}, 0))) AS p, w FROM dw) x
          JOIN (SELECT tid, len(w) AS n, unnest(range(0, len(w) - {K - 1})) AS t, w AS bw FROM bases) y ON x.w[p+1 : p+{K}] = y.bw[t+1 : t+{K}])
    GROUP BY r, tid, diagonal) GROUP BY r),
tg AS (SELECT tid, label, n, t, w[t+1] || ' ' || w[t+2] || ' ' || w[t+3] AS gram FROM (SELECT tid, label, len(w) AS n, w, unnest(range(0, len(w) - {K - 1})) AS t FROM notices)),
dg AS (SELECT r, p, w[p+1] || ' ' || w[p+2] || ' ' || w[p+3] AS gram FROM (SELECT r, w, unnest(range(0, greatest(len(w) - {K - 1}, 0))) AS p FROM dw)),
h AS (SELECT r, tid, label, n, t, p, p - t AS diagonal FROM dg JOIN tg USING (gram)),
o AS (SELECT DISTINCT r, tid, diagonal AS start FROM h),
e AS (SELECT r, tid, start, label, n, t, min(p) AS p FROM o JOIN h USING (r, tid) WHERE diagonal BETWEEN start AND start + {scan.drift} GROUP BY ALL),
f AS (SELECT *, max(p) OVER (PARTITION BY r, tid, start ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM e),
g AS (SELECT *, least({K}, coalesce(t - lag(t) OVER v, {K}), coalesce(p - lag(p) OVER v, {K})) AS new FROM f WHERE reached IS NULL OR p > reached WINDOW v AS (PARTITION BY r, tid, start ORDER BY t)),
s AS (SELECT r, label, sum(new) / greatest(any_value(n), max(p) + {K} - min(p))::DOUBLE AS score FROM g GROUP BY r, tid, start, label),
ng AS (SELECT r, max(score) AS score, list(DISTINCT label) FILTER (score >= {scan.least}) AS names FROM s GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(bg.names), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bg.names, []), coalesce(ng.names, [])))), ','), '') AS labels,
  greatest(coalesce(part.score, 0), coalesce(ng.score, 0), CASE WHEN n_base > 0 THEN 1 ELSE 0 END)::DOUBLE AS score
FROM dw LEFT JOIN bg USING (r) LEFT JOIN ng USING (r) LEFT JOIN part USING (r)
"""
