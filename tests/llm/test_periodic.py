"""Periodic runs against plain Python: every stretch is looked for period by period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from furlong.llm import periodic
from furlong.llm.queries import QUERIES


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_force(w, least=6, exponent=4):
    """Stretches of one period, smallest period first; one that a smaller period explains is no run."""
    n, out = len(w), []
    for p in range(1, n // exponent + 1):
        a = 0
        while a + p < n:
            b = a
            while b + p < n and w[b] == w[b + p]:
                b += 1
            length = b - a + p
            if length >= max(least, exponent * p) and not any(p % q == 0 and s <= a and a + length <= s + m for s, m, q in out):
                out.append((a, length, p))
            a = b + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts(rng):
    pick = lambda k, n: [rng.choice("abcdefghij"[:k]) for _ in range(n)]
    for _ in range(250):
        w = []
        for _ in range(rng.randint(1, 5)):
            w += pick(rng.choice([1, 2, 3, 9]), rng.randint(0, 12)) + pick(rng.choice([2, 3, 9]), rng.randint(1, 40)) * rng.randint(1, 7)
        yield " ".join(w[: rng.choice([10, 100, 900])])
    yield " ".join("a" * 1000)
    yield " ".join(("a" * 40 + "b") * 30)
    yield " ".join(str(bin(i).count("1") % 2) for i in range(3000))  # Thue-Morse: squares, but no cube
    yield " ".join("ab"[bin(i).count("1") % 2] for i in range(64)) * 9
    fib = ["a", "ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    yield " ".join(fib[-1])
    yield " ".join(f"w{i}" for i in range(4000))
    yield from ("", " \n\t ", "x", "é é é é é é é", "a\tb\na  b\x0ba b\x0ca b ", None)


def test_runs_equal_a_search_by_period():
    rng = random.Random(1)
    for t in texts(rng):
        w = split(t)
        words = np.array([zlib.crc32(x.encode()) for x in w] + [1 << 60], np.uint64)
        for least, exponent in ((6, 4), (2, 2), (9, 3)):
            got = list(zip(*(x.tolist() for x in periodic.runs_of(words, len(w), least, exponent)), strict=True))
            assert got == brute_force(w, least, exponent), (t, least, exponent)


def test_frames(spark):
    rows = [(i, t, "s", 1, 2) for i, t in enumerate(texts(random.Random(2)))]
    rows += [rows[3], (None, rows[4][1], None, None, None), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int, start long")
    found = periodic.find(frame.repartition(3), ("doc_id", "runs"))
    assert found.columns == ["doc_id", "runs", "n_words", "runs", "collapsed_text"]
    got = [(r[0], r[2], [tuple(x) for x in r[3]], r[4]) for r in found.collect()]
    want = [(r[0], len(w), brute_force(w), collapsed(w, brute_force(w))) for r in rows for w in [split(r[1])]]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.find(frame.limit(0)).isEmpty()


def test_a_very_long_text(spark):
    rng = random.Random(3)
    w = [str(rng.randint(0, 10**6)) for _ in range(150_000)]
    w[70_000:110_000] = w[70_000:80_000] * 4
    t = " ".join(w)
    r = periodic.find(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(70_000, 40_000, 10_000)] and r.collapsed_text == " ".join(w[:80_000] + w[110_000:])


def expected(doc_id, text):
    w, sha = split(text), lambda s: hashlib.sha256(s.encode()).hexdigest()
    if doc_id is not None and w:
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = brute_force(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(collapsed(w, runs)))


@pytest.mark.parametrize("source", ["given", "odd"])
def test_query(spark, tmp_path, source):
    path = "/root/testdata/sf0.001"
    if source == "odd":
        rng = random.Random(4)
        rows = [(i, t) for i, t in enumerate(texts(rng))] + [(None, "a a a a a a a"), (None, None), (7, None), (7, "")]
        path = str(tmp_path)
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    frame = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op11_periodic_runs"](spark, path)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in frame.collect()), key=str)
