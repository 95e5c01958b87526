"""Texts without spaces and very long texts: what a worker holds on to stays bounded, and results do not depend on it."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest

from furlong.llm import bpe, substring, toxicity

CHINESE = [chr(c) for c in range(0x4E00, 0x5E00)]


@pytest.fixture
def encoder():
    found = bpe.load(bpe.VOCABULARY)
    found.forget()
    yield found
    found.forget()


def test_texts_without_spaces_are_not_remembered(encoder):
    rng = random.Random(1)
    texts = ["".join(rng.choice(CHINESE) for _ in range(500)) for _ in range(50)]
    first = encoder.encode_all(texts)
    assert not encoder.known and len(encoder.flat) == 0 and len(encoder.at) == 1
    again = encoder.encode_all([*texts, "the thing", "x" * 65 + " y", ""])
    assert again[0][: len(first[0])].tolist() == first[0].tolist()
    assert all(len(c if isinstance(c, str) else c[0]) <= bpe.HELD_CHARS for c in encoder.known)
    assert encoder.encode("the thing " + texts[0]) == encoder.encode("the thing ") [:-1] + encoder.encode(" " + texts[0])


def test_what_is_remembered_is_bounded_by_bytes(encoder, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(12)) for _ in range(300)) for _ in range(40)]
    want = [encoder.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "HELD_BYTES", 100_000)
    encoder.forget()
    for t, ids in zip(texts, want, strict=True):
        assert encoder.encode(t) == ids and encoder.held <= 100_000 + 300 * (bpe.ENTRY_BYTES + 24)
    with bpe.lent(bpe.VOCABULARY) as e:
        e.encode(texts[0])
    assert not encoder.known


def test_scores_do_not_depend_on_what_was_seen_before(monkeypatch):
    words = ["idiot", "moron", "scum", "imbecile", "jerk"]
    rng = random.Random(3)
    some = ["the", "thing", "i.d.i.o.t", "morons", "scumm", "harmless", "s c u m", "j e r k", "idiot", "\n", "imbecile.", "mo-ron!", "x" * 5000, "é" * 70 + "idiot"]
    texts = [". ".join(" ".join(rng.choice(some) for _ in range(rng.randint(0, 12))) for _ in range(5)) + rng.choice([".", "", "!"]) for _ in range(60)] + ["s c u m.", "you idiot.", "", " "]
    make = lambda: toxicity.Landmarks([f"{toxicity.HEAD}{w}{toxicity.TAIL}" for w in words])
    plain = lambda found: sorted((i, x.round(12).tolist()) for i, x in found)
    whole = plain(make().sentences(texts))
    one = make()
    assert whole == plain((i, x) for i, t in enumerate(texts) for _, x in one.sentences([t]))
    monkeypatch.setattr(toxicity, "SEEN_BYTES", 0)
    tight = make()
    assert whole == plain((i, x) for i, t in enumerate(texts) for _, x in tight.sentences([t]))
    assert all(len(w) <= toxicity.SEEN_LETTERS for w in one.seen)
    # The word that ends a sentence counts like any other.
    assert {60, 61} <= {i for i, _ in whole}


def test_a_very_long_text_is_scored_whole(spark):
    filler = " ".join(f"w{i}" for i in range(200_000))
    marks = toxicity.Landmarks([f"{toxicity.HEAD}idiot{toxicity.TAIL}"])
    machine = toxicity.Machine(marks, toxicity.np.array([2.0]), -1.0, toxicity.np.array([1.0, 0.0, 0.0, 0.0]))
    rows = [(1, filler), (2, f"{filler}. you idiot"), (3, "i" * 1_000_000), (4, "you idiot")]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), machine).collect()}
    assert got[1] == got[3] < 0.3 < got[2] == got[4]


def test_what_substring_dedup_makes_of_a_batch_is_bounded():
    """Texts of 4 MB go through in parts; the arrays made of a part, and so what a worker takes, stay far below the batch's."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(350)]
    asked = pa.array([[]] * len(texts), pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32()), ("key", pa.int64()), ("digest", pa.int64())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int32()), pa.array(texts), asked], names=["d", "t", "text", "asked"])
    tracemalloc.start()
    done = 0
    for row, end, block, _, _ in substring._parts(batch):
        substring._segments(block)
        done += end - row
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done == len(texts) and sum(map(len, texts)) > 3 << 20 and peak < 24 << 20
