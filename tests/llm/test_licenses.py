"""License scans against plain Python, which tries every template at every place of every text."""

from __future__ import annotations

import math
import random
import re

import pytest

from furlong.llm import licenses
from furlong.llm.queries import QUERIES

SOME = "the of license public version general 2 0 cc by mit gnu apache software permission é zz".split()


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def stands(w, phrase, lo, hi):
    return any(w[i : i + len(phrase)] == phrase for i in range(max(0, lo), min(hi, len(w)) - len(phrase) + 1))


def brute_force(rows, wanted):
    every = [(i, words_of(t)) for i, t in rows]
    count = {}
    for _, w in every:
        for x in set(w):
            count[x] = count.get(x, 0) + 1
    idf = lambda x: 1 + math.log((1 + len(every)) / (1 + count.get(x, 0)))
    out = []
    for i, w in every:
        places, base, labels, score = [], set(), set(), 0.0
        for t in wanted:
            n = len(t.words)
            if t.base:
                at = [k for k in range(len(w)) if w[k : k + n] == t.words]
                places += at
                if at:
                    base.add(t.label)
                    labels.add(t.label)
                    score = 1.0
                continue
            rare = sorted(range(n), key=lambda j, t=t: (-idf(t.words[j]), t.words[j], j))[: licenses.RARE]
            for o in range(-n, len(w)):
                at = lambda k, o=o: w[o + k] if 0 <= o + k < len(w) else None
                if not any(at(j) == t.words[j] for j in rare):
                    continue
                same = [any(at(j + k) == t.words[j] for k in range(licenses.SLACK + 1)) for j in range(n)]
                share = sum(idf(x) for x, s in zip(t.words, same, strict=True) if s) / sum(map(idf, t.words))
                if share >= licenses.MIN_SHARE and sum(same[j] for j in rare) >= min(licenses.VOTES, len(rare)) and all(stands(w, p, o, o + n + licenses.SLACK) for p in t.phrases):
                    labels.add(t.label)
                    score = max(score, 1.0 if all(same) else share)
        out.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score))
    return out


def texts(rng):
    notices = [t for _, t, _ in licenses.NOTICES]
    for _ in range(3):
        for t in notices:
            w = t.split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], ["other"], [w[k], "more"], [w[k].upper()]])
            yield " ".join([rng.choice(SOME) for _ in range(rng.randint(0, 30))] + w + [rng.choice(SOME) for _ in range(rng.randint(0, 30))])
    for _ in range(40):
        yield " ".join(rng.choice(SOME) for _ in range(rng.randint(0, 200)))
    yield from ("GNU General\nPublic-License", "cc-by cc by", "mit", "license", "the mit", "license mit license mit license", "CC BY " * 3000, "license " * 5000, "", None, "é", "İ CC BY", "K mit license")


@pytest.fixture(scope="module")
def rows():
    made = list(enumerate(texts(random.Random(6))))
    return [*made, made[0], (None, made[1][1]), (None, None)]


def same(got, want):
    assert [r[:-1] for r in sorted(got, key=str)] == [r[:-1] for r in sorted(want, key=str)]
    assert [r[-1] for r in sorted(got, key=str)] == pytest.approx([r[-1] for r in sorted(want, key=str)])


def test_scan_equals_every_template_at_every_place(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, labels string")
    found = licenses.scan(frame.repartition(4))
    assert found.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got, want = [tuple(r) for r in found.collect()], brute_force(rows, licenses.templates())
    same(got, want)
    named = {x for r in want for x in r[6].split(",")}
    assert {"gpl-3.0", "apache-2.0", "cc-by-nc-4.0", "bsd", "isc", "mpl-2.0", "unlicense"} <= named
    assert licenses.scan(frame.limit(0)).isEmpty()


def test_edits_and_families(spark):
    gpl = "Text. You can redistribute it and/or modify it under the new terms of the GNU General Public License as published by the Free Software Foundation; either version {} of the License. More."
    rows = [(1, gpl.format(2)), (2, gpl.format(3)), (3, gpl.format(9)), (4, "Licensed under CC BY-NC 4.0."), (5, "the general public and a license, version 3"), (6, "Permission is hereby granted, free of charge, to any person.")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i][0] for i in range(1, 7)] == ["gpl,gpl-2.0", "gpl,gpl-3.0", "gpl", "cc-by,cc-by-nc-4.0", "", ""] and got[5][1] == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_license_scan"](spark, path)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5 + ["string"] * 2 + ["double"]
    same([tuple(r) for r in got.collect()], brute_force(rows, licenses.templates()))
