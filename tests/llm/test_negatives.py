"""Hard negatives against plain Python, which scores every anchor with every row."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.llm import negatives
from furlong.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, rank string"


def brute_force(rows):
    part = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            part[i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    out = []
    for i, label, v in part:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, k == label) for j, k, w in part if j != i)  # noqa: B905
        for ps, p, _ in [r for r in scored if r[2]][:5]:
            fit = [(n, ns) for ns, n, same in scored if not same and 30 * -ps <= 100 * -ns <= 90 * -ps][:10]
            out += [(i, p, r, n, -ps, -ns) for r, (n, ns) in enumerate(fit, 1)]
    return out


def clustered(rng, n, dims, spread):
    """Rows around a few centres, with copies and ties."""
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        v = [x + rng.gauss(0, spread) for x in c]
        rows.append((i * 10, rows[-3][1] if rows and i % 9 == 0 and len(rows) > 3 else v, rng.choice([1, 1, 1, 2, 3])))
    return rows


def mined(spark, rows, parts=5):
    frame = spark.createDataFrame([(i, v, k, 7, "x") for i, v, k in rows], SCHEMA).repartition(parts)
    return negatives.mine(frame, F.col("vec_id") % 100 == 0)


@pytest.mark.parametrize("spread", [0.0, 0.02, 1.0])
def test_every_window_is_filled_as_by_scoring_all(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "GROUP", 150)
    monkeypatch.setattr(negatives, "BLOCK", 12)
    rows = clustered(random.Random(3), 500, 6, spread)
    found = mined(spark, rows)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, found.collect())) == sorted(brute_force(rows))


def test_odd_rows(spark):
    rows = clustered(random.Random(4), 120, 4, 0.3)
    odd = [(None, [1.0] * 4, 1), (100, None, 1), (200, [1.0, None, 1.0, 1.0], 1), (300, [1.0, math.nan, 1.0, 1.0], 2), (400, [math.inf] * 4, 2), (500, [1.0] * 4, None)]
    odd += [rows[3], rows[20], (rows[20][0], [0.5] * 4, 2), (5001, [], 1), (5100, [], 2), (5003, [1.0, 2.0], 3), (5200, [-0.5, 2.0], 3), (-100, [0.1, 0.2, 0.3, 0.4], 1), (5300, [0.0] * 4, 2), (5004, [3e4, -3e4, 2e4, 1e4], 3), (5400, [3e6, -3e6, 2e6, 1e6], 1), (5401, [2e6, -3e6, 2e6, 1e6], 1), (5402, [2e6, -2e6, 2e6, 1e6], 2)]
    got = sorted(map(tuple, mined(spark, rows + odd).collect()))
    assert got == sorted(brute_force(rows + odd))
    assert mined(spark, rows[:2], 1).limit(0).isEmpty()
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).isEmpty()
    assert negatives.mine(spark.createDataFrame([(1, [1.0], 2, 3, "x")], SCHEMA), F.col("vec_id") % 100 == 0).isEmpty()


def test_bounds_spare_scores_and_lose_none():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 32)) * 200
    anchors = np.floor(centres[rng.integers(0, 8, 200)] + rng.normal(size=(200, 32))).astype(np.int64)
    rows = np.floor(centres[rng.integers(0, 8, 3000)] + rng.normal(size=(3000, 32)) * 20).astype(np.int64)
    score = anchors @ rows.T
    high = np.sort(score, 1)[:, -400:-399]
    search = negatives.Search(np.arange(200), np.zeros(200, np.int64), anchors, np.full((200, 1), 100_000), high, 10, False)
    for a in range(0, 3000, 500):
        search.show(np.arange(a, a + 500) + 1000, np.ones(500, np.int64), rows[a : a + 500])
    want = [(p, s, i + 1000) for p in range(200) for s, i in sorted(((-score[p, i], i) for i in range(3000) if 100_000 <= score[p, i] <= high[p, 0]))[:10]]
    assert [(a, -s, i) for a, _, s, i in search.best.T.tolist()] == want
    assert search.scored < 0.5 * score.size


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want = brute_force(rows)
    assert want and sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, path).collect())) == sorted(want)
