"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel counts common subsequences of p letters, each weighted by DECAY to the power of the stretches it spans, so an
insult with inserted or missing characters still matches. Words are read with a mark at either end. Landmarks are runs
of letters at a word's beginning or end, its mark included, that mark toxic training texts. A word's feature for a landmark l is K(word, l) / K(l, l), with p one less than l's length; a sentence takes the highest
of its words, Nystroem whitening turns the features into coordinates of the kernel's space, and a linear machine with
squared hinge loss is fitted there. A document's score is a calibrated probability from the margins of its two worst
sentences and the sum of what all sentences add to a margin without a match.

K is zero unless the longest common subsequence has p letters. That is tested with bit-parallel arithmetic for all words
at once, so the kernel itself runs on few pairs only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import held_out, sampled, slices

DECAY, MIN_RUN, MAX_RUN, LANDMARKS, WIDTH = 0.35, 5, 9, 64, 24
HEAD, TAIL = "\x02", "\x03"  # the marks
TRAIN_ROWS = 1500  # bound of the sample of labelled documents of each class
MIN_DOCS, THRESHOLD = 4, 0.3
# What a task remembers of words it has seen: bytes in all, letters of one word; a longer word is looked at each time.
SEEN_BYTES, SEEN_LETTERS, ENTRY_BYTES = 32 << 20, 64, 160
SLICE_BYTES, PAIRS = 2 << 20, 4096

_SENTENCE = re.compile(r"[.!?\n]+(?:\s|$)")
# Signs between letters, and letters that are doubled; words stand on lines of their own.
_FILLED = re.compile(r"(?:[^\w\n]|_)+|(.)(?=\1)")
_MAYBE_SPACED = re.compile(r"(?<!\S)\S[ \t]+\S[ \t]+\S[ \t]+\S")
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]+){3,}\S(?!\S)")


def kernel(words: np.ndarray, lengths: np.ndarray, mark: np.ndarray, p: int) -> np.ndarray:
    """Subsequence kernel of order p of many words (rows of letter codes) with one landmark, or each with its own (rows)."""
    marks = mark if mark.ndim == 2 else mark[None, :]
    inside = np.arange(words.shape[1])[None, :] < lengths[:, None]
    same = (words[:, :, None] == marks[:, None, :]) & inside[:, :, None]
    prime = np.ones(same.shape)
    for _ in range(p - 1):
        step = DECAY**2 * same * prime
        for j in range(1, step.shape[2]):
            step[:, :, j] += DECAY * step[:, :, j - 1]
        for i in range(1, step.shape[1]):
            step[:, i] += DECAY * step[:, i - 1]
        prime = np.zeros_like(step)
        prime[:, 1:, 1:] = step[:, :-1, :-1]
    return DECAY**2 * (same * prime).sum((1, 2))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.array(words, f"<U{WIDTH}").view(np.uint32).reshape(-1, WIDTH) if words else np.zeros((0, WIDTH), np.uint32)
    return codes, (codes > 0).sum(1)


@dataclass
class Landmarks:
    texts: list[str]
    seen: dict[str, np.ndarray | None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.held = 0
        letters = sorted({ord(c) for t in self.texts for c in t})
        self.letters = np.array(letters or [0], np.uint32)
        self.marks = [np.array([ord(c) for c in t], np.uint32) for t in self.texts]
        bit = {c: np.uint64(1 << i % 64) for i, c in enumerate(letters)}
        self.bits = np.array([*(bit[c] for c in letters), 0], np.uint64)
        self.masks = [np.bitwise_or.reduce([bit[int(c)] for c in m]) for m in self.marks]
        self.own = [float(kernel(m[None, :], np.array([len(m)]), m, len(m) - 1)[0]) for m in self.marks]

    def __reduce__(self):
        return Landmarks, (self.texts,)

    def vectors(self, words: list[str]) -> list[np.ndarray | None]:
        """Features of each word; none where all are zero. Long words count by overlapping parts."""
        parts, owner = [], []
        # A word counts also without signs and doubled letters, so that insults filled with them keep their weight.
        bare = _FILLED.sub("", "\n".join(words)).split("\n") if words else []
        forms = [(i, f"{HEAD}{w}{TAIL}") for i, w in enumerate(words)] + [(i, f"{HEAD}{b}{TAIL}") for i, (w, b) in enumerate(zip(words, bare, strict=True)) if b != w]
        for i, w in forms:
            if len(w) <= WIDTH:
                parts.append(w)
                owner.append(i)
                continue
            for a in range(0, len(w) - WIDTH // 2, WIDTH // 2):
                parts.append(w[a : a + WIDTH])
                owner.append(i)
        codes, lengths = _codes(parts)
        place = np.searchsorted(self.letters, codes).clip(0, len(self.letters) - 1)
        place = np.where(self.letters[place] == codes, place, len(self.letters))
        mask = np.bitwise_or.reduce(self.bits[place], axis=1) if len(parts) else np.zeros(0, np.uint64)
        out: list[np.ndarray | None] = [None] * len(words)
        pairs: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, (mark, need) in enumerate(zip(self.marks, self.masks, strict=True)):
            p = len(mark) - 1
            rows = np.flatnonzero((lengths >= p) & (np.bitwise_count(mask & need) >= np.bitwise_count(need) - 1))
            rows = rows[self._common(place[rows], mark) >= p]
            for lo, hi in ((0, WIDTH // 3), (WIDTH // 3, WIDTH // 2), (WIDTH // 2, WIDTH)):  # short words need few columns
                some = rows[(lengths[rows] > lo) & (lengths[rows] <= hi)]
                if len(some):
                    pairs.setdefault((p, hi), []).append((some, np.full(len(some), k)))
        # All pairs of one order go through the kernel together.
        for (p, hi), found in pairs.items():
            rows, which = (np.concatenate(x) for x in zip(*found, strict=True))
            for a in range(0, len(rows), PAIRS):
                r, w = rows[a : a + PAIRS], which[a : a + PAIRS]
                values = kernel(codes[r, :hi], lengths[r], np.stack([self.marks[k] for k in w]), p)
                for row, k, value in zip(r.tolist(), w.tolist(), values.tolist(), strict=True):
                    i = owner[row]
                    if out[i] is None:
                        out[i] = np.zeros(len(self.marks))
                    out[i][k] = max(out[i][k], min(1.0, value / self.own[k]))
        return out

    def _common(self, place: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each word with the landmark."""
        at = np.zeros(len(self.letters) + 1, np.uint16)
        for j, c in enumerate(mark):
            at[np.searchsorted(self.letters, c)] |= np.uint16(1 << j)
        row = np.full(len(place), (1 << len(mark)) - 1, np.uint16)
        for col in range(place.shape[1]):
            hit = row & at[place[:, col]]
            row = (row + hit) | (row - hit)
        return len(mark) - np.bitwise_count(row & np.uint16((1 << len(mark)) - 1))

    def sentences(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(text, features) of every sentence with a non-zero feature."""
        lowered = [t.lower() for t in texts]
        words = [t.split() for t in lowered]
        # Letters with blanks between them, by sentence, in the few texts that may have some.
        spaced = {i: ["".join(m.split()) for s in _SENTENCE.split(t) for m in _SPACED.findall(s)] for i, t in enumerate(lowered) if _MAYBE_SPACED.search(t)}
        if self.held > SEEN_BYTES:
            self.forget()
        # In its sentence a word stands without the stops that end it.
        raw = set().union(*words)
        asked = {w.rstrip(".!?") for w in raw}.union(*spaced.values())
        fresh = list(asked - self.seen.keys())
        self.seen.update(zip(fresh, self.vectors(fresh), strict=True))
        hits = {w for w in asked if self.seen[w] is not None}
        ending = {w for w in raw if w.rstrip(".!?") in hits}
        for i, (text, own) in enumerate(zip(lowered, words, strict=True)):
            if ending.isdisjoint(own) and hits.isdisjoint(spaced.get(i, ())):
                continue
            for sentence in _SENTENCE.split(text):
                found = hits.intersection(sentence.split())
                if i in spaced:
                    found |= hits.intersection("".join(m.split()) for m in _SPACED.findall(sentence))
                if found:
                    yield i, np.max([self.seen[w] for w in found], axis=0)
        for w in fresh:
            if len(w) > SEEN_LETTERS:
                del self.seen[w]
            else:
                self.held += ENTRY_BYTES + (8 * len(self.marks) if w in hits else 0)

    def forget(self) -> None:
        self.seen, self.held = {}, 0


@dataclass
class Machine:
    landmarks: Landmarks
    weights: np.ndarray  # per landmark feature
    bias: float
    calibration: np.ndarray  # of the summary

    def margins(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias

    def summary(self, margins: np.ndarray) -> np.ndarray:
        """What a document is judged by: its two highest margins and how much its sentences matched; faint matches add little."""
        top = np.sort(np.append(margins, [self.bias, self.bias]))
        return np.array([top[-1], top[-2], np.log1p(np.maximum(0, margins - self.bias).sum()), 1.0])

    def probability(self, margins: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.summary(margins) @ self.calibration, -500, 500))))


def _constant(marks: Landmarks, logit: float) -> Machine:
    return Machine(marks, np.zeros(len(marks.texts)), 0.0, np.array([0.0, 0.0, 0.0, logit]))


def _choose(counted: DataFrame, n: np.ndarray) -> list[str]:
    """Runs of letters that mark class 1, by z-score of their share of documents; runs much like a better one are left out."""
    p = (F.col("n1") + F.col("n0")) / float(n.sum())
    z = (F.col("n1") / float(n[1]) - F.col("n0") / float(n[0])) / F.sqrt(p * (1 - F.least(p, F.lit(0.999))) * float(1 / n[1] + 1 / n[0]))
    rows = counted.where((F.col("n1") >= MIN_DOCS) & (F.col("n1") / float(n[1]) > 20 * F.col("n0") / float(n[0])))
    rows = rows.withColumn("z", z * (1 + F.length("run") / 100)).orderBy(F.desc("z"), "run").limit(4000).collect()
    chosen: list[str] = []
    for run in (r["run"] for r in rows):
        if len(chosen) == LANDMARKS:
            break
        if not chosen or not any(_alike(run, c) for c in chosen):
            chosen.append(run)
    return chosen


def _alike(a: str, b: str) -> bool:
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0, *(row[j] + 1 if x == y else max(row[j + 1], 0) for j, y in enumerate(b))]
        for j in range(1, len(row)):
            row[j] = max(row[j], row[j - 1])
    return row[-1] >= min(len(a), len(b)) - 1


def _runs(sample: DataFrame) -> DataFrame:
    """`run`, `n0`, `n1`: in how many documents of either label a run of letters stands in a word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(re.findall(r"[^\W\d_]{3,}", (text or "").lower()))
                runs = {f"{HEAD}{w}{TAIL}"[part] for w in words for k in range(MIN_RUN, min(len(w) + 2, MAX_RUN) + 1) for part in (slice(k), slice(-k, None))}
                seen.update((run, label) for run in runs)
                if len(seen) > 200_000:
                    yield flush(seen)
                    seen.clear()
        yield flush(seen)

    def flush(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), *(pa.array([v if k[1] == label else 0 for k, v in seen.items()], pa.int64()) for label in (0, 1))], names=["run", "n0", "n1"])

    return sample.select("text", "label").mapInArrow(count, "run string, n0 long, n1 long").groupBy("run").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine from documents with `toxic` labels outside the held-out part; without both classes it scores all 0."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    size = dict(known.groupBy("label").count().collect())
    if len(size) < 2:
        return _constant(Landmarks([]), -500.0)
    ids = sampled(known.where("label = 0"), TRAIN_ROWS, size[0], "doc_id").union(sampled(known.where("label = 1"), TRAIN_ROWS, size[1], "doc_id"))
    # The ids are bounded by twice TRAIN_ROWS, so they go to the documents, not the texts to them.
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "label")
    weigh = dict(sample.groupBy("label").count().collect())
    n = np.array([weigh.get(0, 0), weigh.get(1, 0)], float)
    if not n.all():
        return _constant(Landmarks([]), -500.0)
    marks = Landmarks(_choose(_runs(sample), n))
    if not marks.texts:
        return _constant(marks, float(np.log(size[1] / size[0])))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[list[float]]] = [[] for _ in range(batch.num_rows)]
            row = 0
            for part in slices(batch, 0, SLICE_BYTES):
                for i, x in marks.sentences([t or "" for t in part.column(0).to_pylist()]):
                    found[row + i].append(x.tolist())
                row += part.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.list_(pa.float64())))], names=["label", "x"])

    rows = sorted((r["label"], r["x"]) for r in sample.mapInArrow(features, "label int, x array<array<double>>").collect())
    weight = np.array([size[k] / n[k] for k in (0, 1)])
    return _fit(marks, [(np.array(x).reshape(-1, len(marks.texts)), y) for y, x in rows], weight / (weight * n).sum() * n.sum())


def _fit(marks: Landmarks, docs: list[tuple[np.ndarray, int]], class_weight: np.ndarray) -> Machine:
    codes, lengths = _codes(marks.texts)
    gram = np.minimum(1.0, np.stack([kernel(codes, lengths, m, len(m) - 1) / own for m, own in zip(marks.marks, marks.own, strict=True)], 1))
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    white = vector / np.sqrt(np.maximum(value, 1e-2)) @ vector.T
    # Sentences take their document's label; a document without a matching sentence stands as one empty sentence.
    x = np.concatenate([s if len(s) else np.zeros((1, len(marks.texts))) for s, _ in docs])
    label = np.repeat([y for _, y in docs], [max(1, len(s)) for s, _ in docs])
    y, c = 2.0 * label - 1, class_weight[label]
    z = np.hstack((x @ white, np.ones((len(x), 1))))
    w, ridge = np.zeros(z.shape[1]), np.diag([1e-2] * (z.shape[1] - 1) + [1e-6])
    for _ in range(30):  # Newton steps on the squared hinge
        on = y * (z @ w) < 1
        new = np.linalg.solve(ridge + (z[on] * c[on, None]).T @ z[on] / len(z), (z[on] * c[on, None]).T @ y[on] / len(z))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    machine = Machine(marks, white @ w[:-1], float(w[-1]), np.zeros(4))
    design, t = np.array([machine.summary(machine.margins(s)) for s, _ in docs]), np.array([float(y) for _, y in docs])
    c = class_weight[t.astype(int)]
    for _ in range(50):  # logistic calibration
        p = 1 / (1 + np.exp(-np.clip(design @ machine.calibration, -500, 500)))
        step = np.linalg.solve((design * (c * (p * (1 - p) + 1e-6))[:, None]).T @ design + 1e-2 * np.eye(4), design.T @ (c * (t - p)) - 1e-2 * machine.calibration)
        machine.calibration = machine.calibration + np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return machine


def score(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, `score` in [0, 1] and `worst`, the landmarks that the worst sentence matches.

    Null and empty texts score like a sentence without any match.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # LANDMARKS short strings and weights
    at = len(keep)
    schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)) + ", score double, worst array<string>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        base = m.probability(np.zeros(0))
        for whole in batches:
            for batch in slices(whole, at, SLICE_BYTES):
                found: dict[int, list[np.ndarray]] = {}
                for i, x in m.landmarks.sentences([t or "" for t in batch.column(at).to_pylist()]):
                    found.setdefault(i, []).append(x)
                out, worst = np.full(batch.num_rows, base), [[] for _ in range(batch.num_rows)]
                for i, x in found.items():
                    margins = m.margins(np.array(x))
                    out[i] = m.probability(margins)
                    worst[i] = [t.strip(HEAD + TAIL) for t, v in zip(m.landmarks.texts, x[margins.argmax()], strict=True) if v > 0]
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(out), pa.array(worst, pa.list_(pa.string()))], names=[*(f"_{i}" for i in range(at)), "score", "worst"])
        m.landmarks.forget()  # a worker outlives its tasks

    chosen = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"))
    return chosen.mapInArrow(work, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "score", "worst")
