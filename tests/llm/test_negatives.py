"""Hard negatives against all pairs by brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import negatives as n
from eventlake.llm.common import table

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors, mining=n.Mining()):
    good = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own in sorted({r[0] for r in good if r[0] in anchors}):
        label, vec = min((r[1], [float(x) for x in r[2]]) for r in good if r[0] == own)
        scored = sorted((-sum(int(x) * y for x, y in zip(vec, r[2])), r[0], r[1]) for r in good if r[0] != own)
        for ps, pid, _ in [s for s in scored if s[2] == label][: mining.positives]:
            inside = [(ns, i) for ns, i, l in scored if l != label and mining.low * -ps <= 100 * -ns <= mining.high * -ps]
            out += [(own, pid, k + 1, i, -ps, -ns) for k, (ns, i) in enumerate(inside[: mining.negatives])]
    return sorted(out)


def mined(spark, rows, anchors, mining=n.Mining()):
    df = spark.createDataFrame(rows, KIND).withColumns({"id": F.lit("x"), "key": F.lit(1), "score": F.lit(2)})
    done = n.hard_negatives(n.usable(df), F.col("id").isin(*anchors), mining)
    assert done.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in done.collect())


def test_keys_sort_as_pairs_do():
    rng = random.Random(3)
    pairs = [(rng.choice([-5, 0, 7]), rng.choice([-n.MOST, -3, 0, 3, n.MOST]), rng.random() < 0.5, rng.choice([-9, 0, 2**62])) for _ in range(300)]
    packed = sorted(n.pack(*p) for p in pairs)
    assert [n.unpack(k) for k in packed] == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_iterator_opens_and_closes_windows():
    keys = sorted([n.pack(1, 100, False, 5), n.pack(1, 95, True, 6), n.pack(1, 90, True, 7), n.pack(1, 60, False, 8), n.pack(1, 54, True, 9), n.pack(1, 30, True, 3), n.pack(1, 29, True, 2), n.pack(2, 0, False, 9), n.pack(2, 0, True, 1)])
    assert list(n.mine_windows(iter(keys), n.Mining())) == [(1, 5, 1, 7, 100, 90), (1, 5, 2, 9, 100, 54), (1, 8, 1, 9, 60, 54), (1, 5, 3, 3, 100, 30), (1, 8, 2, 3, 60, 30), (1, 8, 3, 2, 60, 29), (2, 9, 1, 1, 0, 0)]


@pytest.mark.parametrize("shard", [1 << 14, 40])
def test_all_pairs(spark, shard):
    rng = np.random.default_rng(shard)
    centres = rng.normal(size=(4, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 4] * rng.uniform(0.2, 1.5) + rng.normal(0, 0.4, 8)], int((i + (i % 9 == 0)) % 4)) for i in range(300)]
    rows += [(300 + i, rows[17][1], 1) for i in range(30)] + [(340 + i, rows[17][1], 2) for i in range(30)]  # ties
    mining = n.Mining(shard=shard)
    want = brute(rows, set(range(0, 370, 10)), mining)
    assert len(want) > 300
    assert mined(spark, rows, range(0, 370, 10), mining) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2), (3, None, 1), (4, [1.0, None], 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (None, [0.5, 0.5], 2), (8, [0.5, 0.5], None), (9, [], 2), (10, [0.5], 2), (11, [0.25, 0.5, 9.0], 2), (2, [0.5, 0.5], 2), (0, [1.0, 2.0], 1), (12, [0.0, 0.0], 3), (13, [0.0, 0.0], 3), (14, [2.0**100, 1.0], 3), (15, [2.0**90, 2.0**90], 1)]
    got = mined(spark, rows, [0, 12])
    clipped = [r for r in rows if r[0] not in (14, 15)]
    assert [r for r in got if r[0] == 0 and abs(r[4]) < 1e9 and r[3] != 14] == [r for r in brute(clipped, {0})]
    assert all(abs(r[4]) <= n.MOST for r in got) and [r for r in got if r[0] == 12 and r[4] == 0]
    assert mined(spark, [], [0]) == [] and mined(spark, [(0, [1.0], 1)], [0]) == []


def test_registered_query(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "embeddings").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    got = sorted(tuple(r) for r in n.q_negatives(spark, "/root/testdata/sf0.001").collect())
    assert got == brute(moved, {r[0] for r in rows if r[0] % 100 == 0}) and got
