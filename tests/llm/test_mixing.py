"""Mixing against a plain tree walk and the SQL oracle."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

from eventlake.llm import mixing
from eventlake.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fill(children: list[tuple[str, int, int]], budget: int) -> dict[str, int]:
    """(name, weight, capacity) under a budget: full children leave, one after
    another, and the rest share by weight, rounded along the running sum."""
    live = sorted(((c / w if w else -1.0), n, w, c if w else 0) for n, w, c in children)
    out, left, weight = {}, budget, sum(x[2] for x in live)
    while live and live[0][3] * weight <= live[0][2] * left:
        _, n, w, c = live.pop(0)
        out[n], left, weight = c, left - c, weight - w
    run = 0
    for _, n, w, _ in live:
        out[n] = (run + w) * left // weight - run * left // weight
        run += w
    return out


def plain(rows, mix):
    domain = {s: d for d, _, ss in mix.domains for s in ss}
    leaves = defaultdict(list)
    for r in rows:
        leaf = (domain.get(r[3] or "unknown", "other"), r[2] or "unknown", r[3] or "unknown")
        leaves[leaf].append((r[0], len((r[1] or "").split())))
    total = {k: sum(t for _, t in v) for k, v in leaves.items()}
    cap = Counter()
    for (d, lang, s), t in total.items():
        for node in ((), (d,), (d, lang), (d, lang, s)):
            cap[node] += t * mix.max_epochs
    weights = [{d: w for d, w, _ in mix.domains}, mix.languages, mix.sources]
    budget = {(): min(sum(total.values()) * mix.percent // 100, cap[()])}
    for depth in range(3):
        for parent in [n for n in list(budget) if len(n) == depth]:
            names = sorted({k[depth] for k in total if k[:depth] == parent})
            for n, b in fill([(n, weights[depth].get(n, 1), cap[(*parent, n)]) for n in names], budget[parent]).items():
                budget[(*parent, n)] = b
    used = Counter()
    for leaf, docs in leaves.items():
        whole, rest = divmod(budget[leaf], total[leaf]) if total[leaf] else (0, 0)
        order = sorted((hashlib.md5(f"{mix.seed}:{whole}:{'' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, t) for i, t in docs)
        before = 0
        for _, i, t in order:
            used[leaf, None if i == -1 else i] += whole + (before < rest)
            before += t
    return budget, {k: n for k, n in used.items() if n}


def check(spark, rows, mix):
    docs = spark.createDataFrame(rows, SCHEMA)
    budget, used = plain(rows, mix)
    got = Counter(((r["domain"], r["lang"], r["source"]), r["doc_id"]) for r in mixing.select_mix(docs, mix).collect())
    assert dict(got) == used
    return budget


def words(n):
    return " ".join(["w"] * n)


MIX = mixing.Mix(domains=(("a", 50, ("s1", "s2")), ("b", 30, ("s3",)), ("c", 20, ("s4",))), languages={"en": 2, "de": 1}, sources={"s1": 3}, percent=70, max_epochs=2, seed=1)


def test_shortages_go_to_siblings_first(spark):
    rows = [(i, words(10), "en", "s1", 0) for i in range(40)] + [(100 + i, words(10), "en", "s2", 0) for i in range(3)] + [(200 + i, words(7), "de", "s2", 0) for i in range(5)]
    rows += [(300 + i, words(4), "en", "s3", 0) for i in range(10)] + [(400 + i, words(11), "de", "s4", 0) for i in range(30)]
    budget = check(spark, rows, MIX)
    # s2 in English is short (60 at most): its sibling s1 takes the rest of the family's budget
    assert budget["a", "en", "s2"] <= 60 and budget["a", "en", "s1"] + budget["a", "en", "s2"] == budget["a", "en"]
    # domain b is short as a whole (80 at most): a and c share what it leaves
    assert budget["b",] == 80 and sum(budget[d,] for d in "abc") == budget[()]


def test_nulls_empty_texts_and_repeats(spark):
    rows = [(1, None, "en", "s1", 0), (2, "", "en", "s1", 0), (3, "a b\tc\n d", None, None, 0), (None, "x y", "de", "s9", 0), (4, "q " * 5000, "en", "s1", 0), (5, "u v", "en", "s1", 0), (5, "u v", "en", "s1", 0)]
    check(spark, rows, MIX)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert mixing.select_mix(docs.limit(0), MIX).count() == 0
    whole = mixing.mixed(docs, mixing.Mix(percent=200, max_epochs=2))
    assert whole.columns == docs.columns
    texts = Counter((r["doc_id"], r["text"]) for r in whole.collect())
    assert texts[5, "u v"] == 4 and texts[3, "a b\tc\n d"] == 2 and texts[None, "x y"] == 2


def test_a_weight_of_zero_gives_nothing(spark):
    rows = [(i, words(5), "en", f"s{i % 4 + 1}", 0) for i in range(40)]
    mix = mixing.Mix(domains=(("a", 1, ("s1", "s2")), ("b", 0, ("s3", "s4"))), percent=90, max_epochs=1, seed=2)
    assert check(spark, rows, mix)["b",] == 0


@pytest.mark.parametrize("percent, epochs", [(60, 2), (5, 1), (170, 3), (1000, 2)])
def test_table_by_plain_walk_and_sql(spark, percent, epochs):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    mix = mixing.Mix(percent=percent, max_epochs=epochs)
    check(spark, [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()], mix)
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    want = Counter(con.sql(f"select doc_id, epoch, domain, lang, source, tokens from ({mixing.sql_mixing(mix)})").fetchall())
    assert Counter(tuple(r) for r in mixing.select_mix(docs, mix).collect()) == want


def test_mixed_rows_are_the_selected_ones_with_clashing_names(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").selectExpr("*", "'k' as copies", "'t' as th", "1 as rows")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = Counter(r["doc_id"] for r in out.collect())
    assert got == Counter(r["doc_id"] for r in mixing.select_mix(docs).collect())
    assert out.where("copies <> 'k' or th <> 't' or rows <> 1").count() == 0


def test_hot_names_without_a_weight_keep_their_share(spark):
    rows = [(i, words(10), "en" if i % 2 else "de", f"src{i % 20}", 0) for i in range(400)]
    for other in ([(1000 + i, words(10), "en", "new", 0) for i in range(200)], [(1000 + i, words(10), None, f"src{i % 20}", 0) for i in range(200)]):
        docs = spark.createDataFrame(rows + other, SCHEMA)
        used = mixing.select_mix(docs)
        new = used.where("doc_id >= 1000").count()
        assert 0.3 * used.count() < new < 0.37 * used.count()


def test_shares_by_tokens_leave_weights_among_listed_names(spark):
    rows = [(i, words(10), "en", f"src{10 * (i % 2)}", 0) for i in range(200)] + [(1000 + i, words(10), "en", "new", 0) for i in range(100)]
    mix = mixing.Mix(domains=(("a", 3, ("src0",)), ("b", 1, ("src10",)), ("z", 0, ("src5",))), percent=60, by_tokens=True)
    tokens = Counter()
    for r in mixing.select_mix(spark.createDataFrame([*rows, (5000, words(50), "en", "src5", 0)], SCHEMA), mix).collect():
        tokens[r["domain"]] += r["tokens"]
    assert tokens["z"] == 0 and abs(tokens["a"] - 3 * tokens["b"]) <= 40 and abs(tokens["other"] - sum(tokens.values()) / 3) <= 20


def test_the_corpus_mix_leaves_no_document_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    used = Counter(r["doc_id"] for r in mixing.mixed(docs).collect())
    assert set(used) == {r["doc_id"] for r in docs.select("doc_id").collect()} and max(used.values()) == 2
    rows = mixing.narrow(docs, mixing.CORPUS).select(*mixing.LEAF, "tokens").collect()
    largest = {}  # a leaf's last document may go over its budget
    for r in rows:
        largest[r[:3]] = max(largest.get(r[:3], 0), r["tokens"])
    over = sum(r["tokens"] for r in mixing.select_mix(docs).collect()) - sum(r["tokens"] for r in rows) * 150 // 100
    assert 0 <= over <= sum(largest.values())
    empty = spark.createDataFrame([(1, None, "en", "s1", 0), (2, "", "de", "s2", 0)], SCHEMA)
    assert sorted(r["doc_id"] for r in mixing.mixed(empty).collect()) == [1, 2]
