"""Quality rules: counts per document, and a linear-chain conditional random field over its lines.

The field has two labels, content and boilerplate, binary features per line and a weight per transition. It is trained
here on a bounded sample of labelled documents. Only whole documents are labelled, so lines begin with their document's
label, documents are put together into pages, so that labels change within a page as on real ones, and lines that the
field reads differently take that label and the field is fitted again; the document's label bounds this, as at least half of
its lines keep it. Viterbi decoding labels the lines; a document stays if enough of its words stand in content lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Block, blocks, mix

SYMBOLS, REPEAT = b"#*$%&|<>", 5
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_CONTENT = 10, 20, 0.5
TRAIN_ROWS, ROUNDS, RATE, DECAY = 4000, 120, 0.2, 1e-3
N_FEATURES = 14
PAGE, RELABEL = 3, 2  # documents of a training page, rounds of new line labels
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in {
    "symbol": SYMBOLS, "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "pipe": b"|", "bang": b"!", "stop": b".!?", "link": b"/@"}.items()}
_HEAD = (np.arange(256) & 0xC0) != 0x80


def _again(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the value was seen before in the same group; groups are in order."""
    h = mix(value ^ mix(group.astype(np.uint64) + np.uint64(1)))
    out = np.ones(len(h), bool)
    out[np.unique(h, return_index=True)[1]] = False
    return out


@dataclass
class Lines:
    """Lines with a word: their document, number of words and features as bits."""

    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray
    repeated: np.ndarray


def lines_of(block: Block) -> Lines:
    data, offsets = block.data, block.offsets
    first = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(data == 10) + 1)))
    first = first[first < len(data)]
    stop = np.append(first[1:], len(data))
    stop = stop - ((stop > first) & (data[stop - 1] == 10)) if len(first) else stop
    heads = np.searchsorted(block.starts, np.append(first, len(data)))
    words = np.diff(heads)
    full = np.flatnonzero(words > 0)
    first, stop, words, heads = first[full], stop[full], words[full], heads[full]
    doc = np.searchsorted(offsets, first, "right") - 1

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[stop] - total[first]

    n = {k: count(t[data]) for k, t in _IS.items()}
    size = np.maximum(1, stop - first)
    repeated = _again(doc, block.spans(first, stop))
    line = np.repeat(np.arange(len(first)), words)
    at = np.repeat(heads - np.concatenate(([0], np.cumsum(words)[:-1])), words) + np.arange(len(line)) if len(line) else line
    same = np.bincount(line, _again(line, block.hash[at]), minlength=len(first)) if len(line) else np.zeros(0)
    last = data[block.ends[heads + words - 1] - 1] if len(first) else np.zeros(0, np.uint8)
    tests = (
        np.ones(len(first), bool), words < 4, words >= 12, n["symbol"] >= 0.3 * words, n["pipe"] >= 0.2 * words, n["upper"] > n["lower"],
        n["digit"] >= 0.1 * size, _IS["stop"][last], n["bang"] >= 0.5 * words, repeated, size >= 10 * words, n["link"] > 0, same >= 0.5 * words, n["symbol"] > 0,
    )
    return Lines(doc, words, sum((t.astype(np.int32) << i for i, t in enumerate(tests)), np.zeros(len(first), np.int32)), repeated)


def base_counts(block: Block, lines: Lines) -> dict[str, np.ndarray]:
    inside = ~block.gap
    at, gram = block.grams(REPEAT)
    doc = block.doc
    h = mix(gram ^ mix(doc[at].astype(np.uint64) + np.uint64(1)))
    _, which, n = np.unique(h, return_inverse=True, return_counts=True)
    twice = at[n[which] > 1]
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + REPEAT, -1)
    return {
        "n_words": block.n_words, "word_chars": block.per_doc(inside & _HEAD[block.data], block.offsets),
        "n_symbols": block.per_doc(_IS["symbol"][block.data], block.offsets), "n_dup_lines": np.bincount(lines.doc[lines.repeated], minlength=block.n_docs),
        "n_repeat_words": block.per_doc(np.cumsum(cover)[:-1] > 0, block.first),
    }


@dataclass
class Crf:
    """Weights of the features for label 1 (content) against label 0, and of the transitions."""

    w: np.ndarray
    t: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features[:, None] >> np.arange(N_FEATURES)) & 1) @ self.w

    def decode(self, doc: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Viterbi over all documents at once: step k takes the k-th line of every document that has one."""
        if not len(doc):
            return np.zeros(0, np.int8)
        emit, back, label = self.scores(features), np.zeros((len(doc), 2), np.int8), np.zeros(len(doc), np.int8)
        heads, sizes = _sequences(doc)
        best = np.stack((np.zeros(len(heads)), emit[heads]), 1)
        for k in range(1, sizes[0] if len(sizes) else 0):
            m = np.searchsorted(-sizes, -k, "left")
            at = heads[:m] + k
            come = best[:m, :, None] + self.t
            back[at] = come.argmax(1)
            best[:m] = come.max(1) + np.stack((np.zeros(m), emit[at]), 1)
        now = best.argmax(1).astype(np.int8)
        for k in range(sizes[0] - 1 if len(sizes) else -1, -1, -1):
            m = np.searchsorted(-sizes, -k, "left")
            at = heads[:m] + k
            label[at] = now[:m]
            now[:m] = back[at, now[:m]]
        return label


def _sequences(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of each document, longest first."""
    heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    sizes = np.diff(np.append(heads, len(doc)))
    order = np.argsort(-sizes, kind="stable")
    return heads[order], sizes[order]


def fit(doc: np.ndarray, features: np.ndarray, label: np.ndarray) -> Crf:
    """Gradient ascent on the conditional likelihood; forward and backward sums run over all documents at once."""
    crf = Crf(np.zeros(N_FEATURES), np.zeros((2, 2)))
    if not len(doc):
        return Crf(np.eye(N_FEATURES)[0], crf.t)
    x = ((features[:, None] >> np.arange(N_FEATURES)) & 1).astype(float)
    heads, sizes = _sequences(doc)
    steps = [heads[: np.searchsorted(-sizes, -k, "left")] + k for k in range(sizes[0])]
    follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    seen_t = np.zeros((2, 2))
    np.add.at(seen_t, (label[follows - 1], label[follows]), 1)
    seen_w, n = x.T @ label, len(doc)
    move = [np.zeros(N_FEATURES), np.zeros((2, 2))]
    for _ in range(ROUNDS):
        emit = np.stack((np.zeros(n), x @ crf.w), 1)
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[steps[0]] = emit[steps[0]]
        for at in steps[1:]:
            a[at] = np.logaddexp(a[at - 1, 0, None] + crf.t[0], a[at - 1, 1, None] + crf.t[1]) + emit[at]
        for at in steps[:0:-1]:
            y = emit[at] + b[at]
            b[at - 1] = np.logaddexp(crf.t[:, 0] + y[:, :1], crf.t[:, 1] + y[:, 1:])
        total = np.logaddexp(a[:, 0] + b[:, 0], a[:, 1] + b[:, 1])
        p = np.exp(a[:, 1] + b[:, 1] - total)
        pair = np.exp(a[follows - 1][:, :, None] + crf.t + (emit + b)[follows][:, None, :] - total[follows][:, None, None]).sum(0)
        for k, (value, step) in enumerate(((crf.w, (seen_w - x.T @ p) / n), (crf.t, (seen_t - pair) / n))):
            move[k] = 0.9 * move[k] + step - DECAY * value
            value += RATE * move[k]
    return crf


def train(labelled: DataFrame) -> Crf:
    """A field from documents (`text`, `label` 1: content), at most a bounded sample: their lines' features come to the driver."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for row, _, block in blocks(batch.column(0)):
                found = lines_of(block)
                bounds = np.searchsorted(found.doc, np.arange(block.n_docs + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[row : row + block.n_docs], pa.int32()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found.features))], names=["label", "features"])

    rows = labelled.select("text", F.col("label").cast("int").alias("label")).mapInArrow(work, "label int, features array<int>").collect()
    rows = sorted((tuple(r["features"]), r["label"]) for r in rows if r["features"])
    return fit_pages([np.array(f, np.int32) for f, _ in rows], np.array([y for _, y in rows], np.int64))


def fit_pages(docs: list[np.ndarray], label: np.ndarray, seed: int = 7) -> Crf:
    """A field from the line features of documents and the documents' labels."""
    order = np.random.default_rng(seed).permutation(len(docs))
    sizes = np.array([len(docs[i]) for i in order], np.int64)
    features = np.concatenate([np.zeros(0, np.int32), *(docs[i] for i in order)])
    own, page = np.repeat(np.arange(len(order)), sizes), np.repeat(np.arange(len(order)) // PAGE, sizes)
    given = np.repeat(label[order], sizes)
    crf = fit(page, features, given)
    for _ in range(RELABEL):
        read = crf.decode(page, features).astype(np.int64)
        most = np.bincount(own, read != given, minlength=len(order)) * 2 <= sizes
        crf = fit(page, features, np.where(most[own], read, given))
    return crf


def judge(docs: DataFrame, crf: Crf, text: str = "text") -> DataFrame:
    """`doc_id`, the counts of BASE, `base_failed`, `content_share` (share of words in content lines; 0 without words), `kept`.

    One row per row of docs; null and empty texts have zero counts and fail.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {k: [np.zeros(0, np.int64)] for k in BASE}
            share = [np.zeros(0)]
            for _, _, block in blocks(batch.column(1)):
                found = lines_of(block)
                for k, v in base_counts(block, found).items():
                    parts[k].append(v)
                content = crf.decode(found.doc, found.features)
                share.append(np.bincount(found.doc, found.words * content, minlength=block.n_docs) / np.maximum(1, block.n_words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.concatenate(parts[k]).astype(np.int64)) for k in BASE), pa.array(np.concatenate(share))], names=["doc_id", *BASE, "content_share"])

    counted = docs.select("doc_id", F.col(text)).mapInArrow(work, "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", content_share double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= MIN_CONTENT))
