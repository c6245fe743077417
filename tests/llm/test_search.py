"""Searches against brute force over all rows."""

import numpy as np
import pytest

from eventlake.llm import search as s
from eventlake.llm.common import table

QUERY = "vec_id % 100 = 0"


def plain(ids, vectors, far, k=10):
    out = {}
    for q in {int(i) for i in ids if i % 100 == 0}:
        own = min((tuple(v) for i, v in zip(ids, vectors, strict=True) if i == q))
        rows = sorted((far(np.array(own), v), int(i)) for i, v in zip(ids, vectors, strict=True) if i != q)
        out[q] = rows[:k]
    return out


def euclid(a, b):
    return float(np.sqrt(((a.astype(np.float64) - np.asarray(b, np.float64)) ** 2).sum()))


def grouped(df, score):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r[score], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard", [16384, 700])
def test_nearest_recall_and_scores(spark, shard):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = rows.collect()
    ids, vectors = [r["vec_id"] for r in data], [np.array(r["embedding"], np.float64) for r in data]
    want = plain(ids, vectors, euclid)
    got = grouped(s.nearest(rows, QUERY, s.Search(shard=shard)), "score")
    assert got.keys() == want.keys()
    found = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert found / sum(map(len, want.values())) >= 0.99
    for q, best in got.items():
        assert [i for _, i in best] == [i for _, i in sorted(best)]
        for score, i in best:
            assert score == pytest.approx(euclid(vectors[ids.index(q)], vectors[ids.index(i)]), rel=1e-12)


def test_bounds_hold_for_most_rows():
    rng = np.random.default_rng(3)
    vectors, query = rng.normal(size=(3000, 64)), rng.normal(size=64)
    centre, turn = vectors.mean(0), s.rotation(64, 1)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes = s.encode(vectors, centre, turn)
    assert codes.bits.shape == (3000, 8)
    estimate, low = next(s.bounds(codes, query[None], centre, turn, 2.5))
    true = ((vectors - query) ** 2).sum(1)
    assert np.corrcoef(estimate, true)[0, 1] > 0.6
    assert (low <= true).mean() > 0.98 and (low <= estimate).all()
    longer = s.rotation(64, 1, 4)
    assert longer.shape == (64, 256) and np.allclose(longer @ longer.T, np.eye(64))
    wide, bound = next(s.bounds(s.encode(vectors, centre, longer), query[None], centre, longer, 2.5))
    assert np.abs(wide - true).mean() < 0.7 * np.abs(estimate - true).mean() and (bound <= true).mean() > 0.98


def test_measuring_ends_at_the_first_bound_beyond_the_kth():
    rng = np.random.default_rng(5)
    vectors, query = rng.normal(size=(2000, 32)), rng.normal(size=32)
    true = ((vectors - query) ** 2).sum(1)
    noise = rng.uniform(0, 4, 2000)
    rows, dists = s.measure(vectors, query, true + noise - 2, true - noise, 10, 16)
    assert np.argsort(true)[:10].tolist() == rows[np.argsort(dists)[:10]].tolist()
    kth = np.partition(true, 9)[9]
    assert len(rows) <= (true - noise <= kth).sum() + 10 + 16 and (np.diff(rows) > 0).all()


def test_share_of_rows_measured(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    n = rows.count()
    measured = s.nearest(rows, QUERY).groupBy("query_id").agg({"measured": "max"}).toPandas()["max(measured)"]
    assert measured.mean() / n < 0.35


def test_rows_are_shuffled_once_whatever_the_queries(spark, capsys):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    s.nearest(rows, "vec_id % 2 = 0").explain("formatted")
    assert "CoGroup" not in capsys.readouterr().out


def test_each_length_is_searched_by_itself(spark):
    odd = [(i, [float(i), 1.0, 2.0]) for i in range(0, 120)] + [(i, [float(i), 3.0]) for i in range(200, 230)]
    rows = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    near = grouped(s.nearest(rows, QUERY, s.Search(k=3)), "score")
    assert {q: [i for _, i in best] for q, best in near.items()} == {0: [1, 2, 3], 100: [99, 101, 98], 200: [201, 202, 203]}
    bits = grouped(s.hamming_nearest(s.sign_codes(rows), QUERY, s.Search(k=3)), "distance")
    assert all(i < 200 for q in (0, 100) for _, i in bits[q]) and [i for _, i in bits[200]] == [201, 202, 203]


ODD = [
    (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (3, [1.0, 0.1, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [float("nan"), 1.0, 1.0]),
    (8, [float("inf"), 1.0, 1.0]), (9, [1.0, None, 1.0]), (10, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (100, [0.0, 1.0, 0.0]), (100, [0.0, 1.0, 0.0]), (200, [0.0, 0.0, 0.0]), (-100, [-1.0, 0.0, -0.5]),
]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(i, v, 1, "x") for i, v in ODD], "vec_id long, embedding array<float>, block int, score string")
    kept = [(i, np.array(v, np.float32)) for i, v in ODD if i in (0, 1, 2, 3, 100, -100)]  # 10 has a length of its own
    want = plain([i for i, _ in kept], [v for _, v in kept], euclid, 4)
    got = grouped(s.nearest(rows, QUERY, s.Search(k=4)), "score")
    assert {q: [i for _, i in best] for q, best in got.items()} == {q: [i for _, i in best] for q, best in want.items()}
    signs = [(i, v > 0) for i, v in kept]
    bits = grouped(s.hamming_nearest(s.sign_codes(rows), QUERY, s.Search(k=4)), "distance")
    assert bits == plain([i for i, _ in signs], [v for _, v in signs], lambda a, b: int((a != b).sum()), 4)
    assert s.nearest(rows.limit(0), QUERY).count() == 0 and s.hamming_nearest(s.sign_codes(rows.limit(0)), QUERY).count() == 0


def test_many_equal_vectors_give_the_smallest_ids(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0, 3.0, 4.0]) for i in range(900)] + [(i, [1.0, 2.0, float(i), -1.0]) for i in range(900, 1000)], "vec_id long, embedding array<float>")
    near = grouped(s.nearest(rows, QUERY, s.Search(shard=100)), "score")
    bits = grouped(s.hamming_nearest(s.sign_codes(rows), QUERY, s.Search(shard=100)), "distance")
    for q in range(0, 900, 100):
        ids = [i for i in range(11) if i != q][:10]
        assert [i for _, i in near[q]] == ids and [i for _, i in bits[q]] == ids


@pytest.mark.parametrize("dims", [5, 64, 100])
def test_multi_index_is_exact(dims):
    rng = np.random.default_rng(dims)
    bits = rng.integers(0, 2, (400, dims)).astype(np.uint8)
    bits[50:90] = bits[0]
    tables = s.SegmentTables(bits)
    for q in range(0, 400, 37):
        rows, far, verified = tables.search(bits[q], 12, np.array([q]))
        true = (bits != bits[q]).sum(1)
        want = sorted((int(true[i]), i) for i in range(400) if i != q)[:12]
        assert list(zip(far.tolist(), rows.tolist(), strict=True)) == want and verified <= 399


def test_hamming_on_the_table(spark):
    codes = s.sign_codes(table(spark, "/root/testdata/sf0.1", "embeddings"))
    data = codes.collect()
    ids, bits = [r["vec_id"] for r in data], [np.array(r["vec"]) for r in data]
    got = grouped(s.hamming_nearest(codes, QUERY, s.Search(shard=900)), "distance")
    assert got == plain(ids, bits, lambda a, b: int((a != b).sum()))
