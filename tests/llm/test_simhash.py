"""SimHash against brute force over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from eventlake.llm import simhash
from eventlake.llm.common import table
from eventlake.llm.components import components


def plain_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_brute_force(fps: dict[int, int], bits: int) -> dict[int, int]:
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", "a", "A b", "The CAT sat on the mat the cat sat on the mat", "É é x y z", None, "a\x0bb\x0cc\td\r\ne", "x y z " * 500])
def test_fingerprint(text):
    want = plain_fingerprint(text)
    assert simhash.fingerprint(text) % (1 << 64) == want
    assert simhash.fingerprint(text, piece=3) % (1 << 64) == want


def test_hash_is_sparks_xxhash64(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("the cat sat")).alias("h")).first()
    assert r["h"] % (1 << 64) == xxh64_intdigest(b"the cat sat", 42)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_by_brute_force(spark, bits):
    rng = random.Random(bits)
    fps = set()
    for _ in range(60):
        fp = rng.getrandbits(64)
        for _ in range(5):
            fps.add(fp)
            for _ in range(rng.randrange(5)):
                fp ^= 1 << rng.randrange(64)
    fps |= {0, (1 << 64) - 1, 1 << 63, 1, 3, 7, 1 << 32, (1 << 32) | 1}
    want = {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= bits}
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(nodes, bits).collect()]
    assert {frozenset(p) for p in got} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(1, 1), (2, 3), (3, 2)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(500, 560)} == {500}
    assert found[3] == 2 and 1 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_table_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.select("doc_id", "text").collect()
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    want = groups_by_brute_force(fps, 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    kept = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_odd_rows(spark):
    data = [(1, "", "x"), (2, None, "x"), (3, "a b c d", "x"), (3, "a b c d", "x"), (4, "A  B c\nd", "x"), (None, "a b c d", "x"), (3, "quite another text here now", "x"), (None, None, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp string")
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == 8
    assert {r["component_id"] for r in out if r["fingerprint"] == "0" * 16} == {1}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, ""), (3, "a b c d"), (3, "quite another text here now")]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.one_of_each(nameless).count() == 3
