"""The latent search by itself, clauses in another order, items in several blocks, and odd tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

from furlong.llm import decontamination
from tests.llm.test_operators import WORDS, brute_force, found_leaks, planted

RARE = [f"{a}{b}{c}" for a in WORDS for b in WORDS for c in ("", "x")]


@pytest.fixture
def no_anchors(monkeypatch):
    """Candidates of the cosine alone; the anchors go to the tasks as data, so none go."""
    every = decontamination.Anchors.of

    def none(items, words, seen):
        a = every(items, words, seen)
        return decontamination.Anchors(a.words, np.zeros(0, np.int64), np.zeros(0, np.int64), a.need, a.size)

    monkeypatch.setattr(decontamination.Anchors, "of", none)


@pytest.mark.parametrize("size", [14, 40])
def test_recall_of_the_cosine_alone(spark, no_anchors, size):
    texts, items = planted(random.Random(size), RARE, [size] * 40, [0, 0.15, 0.28], 60)
    want = brute_force(texts, items)
    got = found_leaks(spark, texts, items)
    assert len(want) > 90 and len(got & want) >= 0.9 * len(want)


def reordered(rng):
    """Items of three clauses and an answer; texts with the clauses in the reverse order, and with another item's answer."""
    some = lambda n: [rng.choice(RARE) for _ in range(n)]
    items = [[some(10), some(10), some(10), some(8)] for _ in range(20)]
    say = lambda parts: " ".join(w for p in parts for w in p)
    texts = [say([some(48), *i[2::-1], i[3], some(60)]) for i in items]
    texts += [say([some(48), *i[2::-1], j[3], some(60)]) for i, j in zip(items, items[1:] + items[:1], strict=True)]
    return texts, [f"{say(i[:3])}. {say(i[3:])}" for i in items]


def test_clauses_in_another_order(spark):
    texts, items = reordered(random.Random(1))
    assert found_leaks(spark, texts, items) == {(k, k) for k in range(20)}
    assert not {(k, k) for k in range(20)} & brute_force([t.lower() for t in texts], items)  # not by their order alone


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    texts, items = planted(random.Random(5), RARE, [14, 30, 40] * 4, [0, 0.2], 50)
    frame = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (0, texts[0]), (90, ""), (91, None), (92, " ".join(random.Random(9).choices(RARE, k=200_000)) + " " + texts[1])], "doc_id long, text string")
    frame = frame.selectExpr("doc_id", "text", "doc_id AS item_id", "1 AS similarity", "text AS mass", "1 AS term")
    bench = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string").selectExpr("item_id", "text", "1 AS doc_id", "'x' AS mass")
    rows = lambda: sorted(map(tuple, decontamination.leaks(frame, bench).collect()), key=str)
    one = rows()
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 500)
    assert len(list(decontamination._item_blocks(bench))) > 3
    many = rows()
    assert [r[:2] + r[3:] for r in one] == [r[:2] + r[3:] for r in many]
    assert np.allclose([r[2] for r in one], [r[2] for r in many], atol=1e-3)
    assert {d for d, *_ in one} >= {None, 0, 92} and not {90, 91} & {d for d, *_ in one}
    assert sum(d == 0 for d, *_ in one) == 2 * sum(d is None for d, *_ in one)  # a repeated row is a row of its own


def test_the_space_does_not_depend_on_which_documents_are_drawn(spark):
    """Documents of one word set give one space, in whatever order their words and however many more than a sample they are."""
    rng = random.Random(7)
    _, items = planted(random.Random(3), RARE, [30] * 8, [0], 10)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [[rng.choice(RARE) for _ in range(30)] for _ in range(1200)]
    make = lambda some: decontamination.fit(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(some)], "doc_id long, text string"), bench)
    one, other = make(texts), make([rng.sample(t, len(t)) for t in texts])
    assert np.allclose(one.weight, other.weight)
    assert np.allclose(one.rows @ one.rows[:200].T, other.rows @ other.rows[:200].T, atol=1e-3)
