"""Importance resampling against plain Python: models, weights, noise and the cut; and how often a weight is drawn."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furlong.llm import resampling
from tests.llm.test_operators import text


def grams(t):
    """Bins of one text's words and word pairs, each hashed in a text of its own."""
    words = (t or "").lower().split()

    def bins(part):
        return [int(b) for _, _, block in resampling.blocks(pa.array([part]), lower=resampling._LOWER) for b in resampling._bins(block)[0]]

    return [bins(w)[0] for w in words] + [bins(f"{a} {b}")[2] for a, b in zip(words, words[1:], strict=False)]


def test_weights_and_cut_equal_plain_python(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, rng.randint(1, 60))) for i in range(40)] + [(40, None), (41, ""), (None, "The ON the"), (5, "again again"), (42, text(rng, 4000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = docs.where("doc_id < 12")

    def model(texts):
        seen = Counter(b for t in texts for b in grams(t))
        total = sum(seen.values()) + resampling.BUCKETS
        return lambda b: math.log((seen[b] + 1) / total)

    good, every = model([t for i, t in rows if i is not None and i < 12]), model([t for _, t in rows])
    want = []
    for i, t in rows:
        g = grams(t)
        want.append((i, len(g), resampling.UNIT * sum(good(b) - every(b) for b in g) / max(1, len(g))))
    got = resampling.resample(docs, wanted).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(got, key=lambda r: order(tuple(r))), sorted(want, key=order)
    assert [(r.doc_id, r.n_grams) for r in got] == [r[:2] for r in want]
    assert [r.log_weight for r in got] == pytest.approx([r[2] for r in want], abs=1e-6)
    noise = {r.doc_id: r.u for r in docs.select("doc_id", ((F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(7)).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)).alias("u")).collect()}
    keys = [w - math.log(-math.log(noise[i])) for i, _, w in want]
    assert [r.key for r in got] == pytest.approx(keys, abs=1e-6)
    cut = sorted(keys, reverse=True)[math.ceil(resampling.SHARE * len(keys)) - 1]
    assert [r.kept for r in got] == [k >= cut - 1e-9 for k in keys]


def test_keys_draw_in_proportion_to_the_weights(spark):
    # The first of many keys is each row's with a chance in proportion to its weight.
    weight = np.array([1.0, 2.0, 4.0, 8.0])
    ids = spark.range(4000)
    u = (F.xxhash64("id", F.lit(7)).bitwiseAND((1 << 52) - 1) + F.lit(0.5)) / float(1 << 52)
    noise = np.array([r.g for r in ids.select((-F.log(-F.log(u))).alias("g")).orderBy("id").collect()]).reshape(-1, 4)
    share = np.bincount((noise + np.log(weight)).argmax(1), minlength=4) / len(noise)
    assert np.allclose(share, weight / weight.sum(), atol=0.06)
