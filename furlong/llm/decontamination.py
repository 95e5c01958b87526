"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words with TF-IDF weights in hashed term space. A randomised singular value decomposition of
all benchmark passages, with partial products summed in the cluster, gives one latent space for all items. Term weights come
from all documents; their passages need no place in the space, as what lies beside the benchmark's passages adds nothing to a
product with one of them. Candidates are pairs of a passage and a benchmark item (a stated query set, in blocks): every passage
is projected, and cosines of NEAR or more are candidates. Their words are checked: the share of the item that is a common
subsequence with the text around the passage, and the same for the item's answer, its last sentence. A pair with a cosine
of CLOSE or more may have less in order (clauses that changed places), if its answer stands there word by word.

A space of fixed size and windows of fixed length rank some true pairs low, so the cosine is not the only way in: beside
it, anchors find every pair whose words pass the check. An item of n words of which LOOSE_LCS * n stand in a text in order
leaves out at most the rest, so any anchor set of `need` words more than the rest has `need` of its words there. An item's
anchors are its words that are rarest in the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Block, blocks

TERMS, HALF, LATENT, SPARE = 1 << 14, 16, 192, 8
FIT_TASKS = 2
ITEM_BYTES = 4 << 20  # benchmark text of one search of the corpus; bounds what the tasks are sent, and decides nothing else
COMMON, FAINT = 0.1, 0.05  # terms in a larger share of the documents carry this weight
LCS, ANSWER, LOOSE_LCS, SURE_ANSWER = 0.7, 0.5, 0.55, 0.8
NEAR, CLOSE, CLOSE_LCS = 0.3, 0.7, 0.4
CHUNK, POSTINGS, PART = 2048, 1 << 20, 1024  # words and passages projected at once: small enough to stay in a cache

_GAP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SENTENCE = re.compile(r"[.!?\n]+\s*")


def _blocks(column: pa.Array) -> Iterator[tuple[int, int, Block]]:
    return blocks(column, _GAP, _LOWER)


def _terms(block: Block) -> np.ndarray:
    return (block.hash % np.uint64(TERMS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text", words: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, int, np.ndarray]:
    """In how many documents each hashed term occurs, the number of documents, and how often each of the words (sorted hashes) occurs."""
    size = TERMS + 1 + len(words)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        df, n = np.zeros(size, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, block in _blocks(batch.column(0)):
                terms, doc = _terms(block), block.doc
                for d in range(0, block.n_docs, 64):
                    a, b = block.first[d], block.first[min(d + 64, block.n_docs)]
                    seen = np.zeros((64, TERMS), np.uint8)
                    seen[doc[a:b] - d, terms[a:b]] = 1
                    df[:TERMS] += np.add.reduce(seen, dtype=np.uint8)
                df[TERMS + 1 :] += np.bincount(_among(words, block.hash)[1], minlength=len(words))
        df[TERMS] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in docs.select(text).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out[:TERMS], int(out[TERMS]), out[TERMS + 1 :]


def _among(words: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted words, and their places there."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64(0xFFFF)
    maybe = np.zeros(1 << 16, bool)
    maybe[words & low] = True
    at = np.flatnonzero(maybe[hashes & low])
    place = np.searchsorted(words, hashes[at]).clip(0, len(words) - 1)
    same = words[place] == hashes[at]
    return at[same], place[same]


@dataclass
class Anchors:
    """Of each item the words that are rarest in the documents, and how many of them a text that holds the item has."""

    words: np.ndarray  # sorted hashes
    word: np.ndarray  # place in words of each (word, item)
    item: np.ndarray
    need: np.ndarray  # of each item
    size: np.ndarray  # words of each item

    @classmethod
    def of(cls, items: list[np.ndarray], words: np.ndarray, seen: np.ndarray) -> Anchors:
        word, item, need = [], [], []
        for i, w in enumerate(items):
            least = int(np.ceil(LOOSE_LCS * len(w) - 1e-9))
            need.append(min(least, 1 + len(w) // 4))
            at = np.searchsorted(words, w)
            at = np.unique(at[np.lexsort((at, seen[at]))][: len(w) - least + need[-1]])
            word.append(at)
            item.append(np.full(len(at), i))
        none = [np.zeros(0, np.int64)]
        word, item = np.concatenate(none + word), np.concatenate(none + item)
        order = np.argsort(word, kind="stable")
        return cls(words, word[order], item[order], np.array(need, np.int64), np.array([len(w) for w in items], np.int64))

    def pairs(self, block: Block, p: Passages) -> tuple[np.ndarray, np.ndarray]:
        """All (passage, item) with enough of the item's anchors in the text that the check looks at."""
        at, place = _among(self.words, block.hash)
        doc, n_passages = block.doc[at], np.bincount(p.doc, minlength=block.n_docs)
        base, n_items = np.cumsum(n_passages) - n_passages, len(self.size)
        groups = 1 + int(np.bincount(self.word, minlength=len(self.words))[place].sum()) // POSTINGS
        found = [np.zeros(0, np.int64)]
        for g in range(groups):  # postings of some of the items at a time
            own = self.item % groups == g
            word, items = self.word[own], self.item[own]
            start = np.searchsorted(word, np.arange(len(self.words) + 1))
            first = start[place]
            count = start[place + 1] - first
            hit = np.repeat(np.arange(len(at)), count)
            item = items[np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
            order = np.argsort(item, kind="stable")
            hit, item = hit[order], item[order]
            last = np.arange(len(hit)) + self.need[item] - 1
            ok = np.flatnonzero(last < len(hit))
            ok = ok[(item[last[ok]] == item[ok]) & (doc[hit[last[ok]]] == doc[hit[ok]])]
            begin, end, item, d = at[hit[ok]], at[hit[last[ok]]], item[ok], doc[hit[ok]]
            low = np.maximum((end - 2 * HALF - self.size[item] - block.first[d]) // HALF + 1, 0)
            high = np.minimum((begin + self.size[item] - block.first[d]) // HALF, n_passages[d] - 1)
            run = np.maximum(high - low + 1, 0)
            passage = np.repeat(base[d] + low - np.cumsum(run) + run, run) + np.arange(run.sum())
            found.append(np.unique(passage * n_items + np.repeat(item, run)))
        found = np.concatenate(found)
        return found // max(1, n_items), found % max(1, n_items)


@dataclass
class Passages:
    """Windows of two halves of HALF words, one half on; the last one of a document may be shorter."""

    half: np.ndarray  # of each word
    n_halves: int
    left: np.ndarray  # first half of each passage
    right: np.ndarray  # second half, or the first again if there is none
    start: np.ndarray  # first word
    doc: np.ndarray

    @classmethod
    def of(cls, block: Block) -> Passages:
        count = -(-block.n_words // HALF)
        base = np.cumsum(count) - count
        doc = block.doc
        half = base[doc] + (np.arange(len(doc)) - block.first[doc]) // HALF
        n = int(count.sum())
        owner = np.repeat(np.arange(block.n_docs), count)
        order = np.arange(n) - base[owner]
        left = np.flatnonzero((order + 1 < count[owner]) | (count[owner] == 1))
        return cls(half, n, left, np.where(count[owner[left]] == 1, left, left + 1), block.first[owner[left]] + order[left] * HALF, owner[left])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of the words' values in each passage."""
        halves = np.zeros((self.n_halves, *values.shape[1:]), values.dtype)
        heads = np.flatnonzero(np.concatenate(([True], self.half[1:] != self.half[:-1]))) if len(self.half) else np.zeros(0, int)
        if len(heads):
            halves[self.half[heads]] = np.add.reduceat(values, heads, axis=0)
        single = (self.left == self.right).reshape(-1, *[1] * (values.ndim - 1))
        return np.where(single, halves[self.left], halves[self.left] + halves[self.right])


def _parts(block: Block, p: Passages, rows: np.ndarray, weight: np.ndarray, asked: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Unit passages times a matrix whose rows are weighted already, PART passages at a time with the number of the first.

    With passages asked for, only the parts that they are in.
    """
    terms, norm = _terms(block), np.sqrt(p.sums(weight[_terms(block)] ** 2))
    used = np.flatnonzero(rows.any(1)[terms])
    for lo in range(0, len(p.left), PART) if asked is None else np.unique(asked // PART) * PART:
        left, right = p.left[lo : lo + PART], p.right[lo : lo + PART]
        begin, end = np.searchsorted(p.half[used], (left[0], right[-1] + 1))
        halves = np.zeros((right[-1] + 1 - left[0], rows.shape[1]), np.float32)
        for a in range(begin, end, CHUNK):
            words = used[a : min(a + CHUNK, end)]
            half = p.half[words] - left[0]
            heads = np.flatnonzero(np.concatenate(([True], half[1:] != half[:-1])))
            halves[half[heads]] += np.add.reduceat(rows[terms[words]], heads, axis=0)
        left, right = left - left[0], right - left[0]
        out, two = halves[left], left != right
        out[two] += halves[right[two]]
        out /= np.maximum(norm[lo : lo + PART], 1e-6)[:, None].astype(np.float32)
        yield lo, out


def _project(block: Block, rows: np.ndarray, weight: np.ndarray) -> tuple[Passages, np.ndarray]:
    """All of the parts, for texts of bounded number."""
    p = Passages.of(block)
    return p, np.concatenate([np.zeros((0, rows.shape[1]), np.float32), *(y for _, y in _parts(block, p, rows, weight))])


def _products(texts: DataFrame, q: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A' A q for the matrix A of all unit passages of the texts ."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((q.astype(np.float32), weight.astype(np.float32)))
    k = q.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, weight = shared.value
        rows, total = q * weight[:, None], np.zeros((TERMS, k), np.float32)
        for batch in batches:
            for _, _, block in _blocks(batch.column(0)):
                p, y = _project(block, rows, weight)
                norm = np.sqrt(p.sums(weight[_terms(block)] ** 2))
                y = y / np.maximum(norm, 1e-6)[:, None].astype(np.float32)
                halves = np.zeros((p.n_halves, k), np.float32)
                np.add.at(halves, p.left, y)
                two = p.left != p.right
                np.add.at(halves, p.right[two], y[two])
                terms = _terms(block)
                for a in range(0, len(terms), CHUNK):
                    order = np.argsort(terms[a : a + CHUNK], kind="stable")
                    t = terms[a : a + CHUNK][order]
                    heads = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
                    total[t[heads]] += np.add.reduceat(halves[p.half[a : a + CHUNK][order]] * weight[t][:, None], heads, axis=0)
        used = np.flatnonzero(total.any(1))
        for a in range(0, len(used), 2048):
            part = used[a : a + 2048]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([r.tobytes() for r in total[part]], pa.binary())], names=["term", "row"])

    out = np.zeros((TERMS, k))
    for r in texts.repartition(FIT_TASKS).mapInArrow(work, "term long, row binary").toLocalIterator():
        out[r["term"]] += np.frombuffer(r["row"], np.float32)
    return out


@dataclass
class Space:
    """The latent space, and how often the benchmark's words occur in the documents."""

    rows: np.ndarray  # terms x LATENT, weighted
    weight: np.ndarray
    vocabulary: np.ndarray  # sorted hashes
    seen: np.ndarray


@dataclass
class Index:
    """Some benchmark items' passages and words in the space."""

    space: Space
    latent: np.ndarray  # item passages x LATENT, unit length
    item: np.ndarray  # item of each passage
    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    anchors: Anchors

    def near(self, block: Block, p: Passages) -> tuple[np.ndarray, np.ndarray]:
        """All (passage, item) with a cosine of NEAR or more, as passage * items + item in order, and the highest cosine of each."""
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        for lo, y in _parts(block, p, self.space.rows, self.space.weight):
            able = np.flatnonzero(np.einsum("ij,ij->i", y, y) >= 0.999 * NEAR**2)  # a cosine is at most the length of y
            y = y[able]
            for a in range(0, len(self.latent), PART):
                cosine = y @ self.latent[a : a + PART].T
                at, column = np.divmod(np.flatnonzero(cosine >= NEAR), max(1, cosine.shape[1]))
                keys.append((lo + able[at]) * len(self.ids) + self.item[a + column])
                values.append(cosine[at, column])
        return _highest(np.concatenate(keys), np.concatenate(values))


def _highest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[order][heads], np.maximum.reduceat(values[order], heads) if len(keys) else values


def fit(docs: DataFrame, benchmark: DataFrame, text: str = "text", seed: int = 11) -> Space:
    """The space of all benchmark items (`text`); frequencies cover all documents."""
    known, n_items = [np.zeros(0, np.uint64)], 0
    for r in benchmark.select("text").toLocalIterator():  # different words of a stated query set
        known[:] = [np.unique(np.concatenate((known[0], *(block.hash for _, _, block in _blocks(pa.array([r["text"]]))))))]
        n_items += 1
    df, n, seen = document_frequencies(docs, text, known[0])
    weight = np.where(df > max(20, COMMON * n), FAINT, np.log((1.0 + n) / (1.0 + df)) + 0.05)
    texts = benchmark.select("text")
    q = np.random.default_rng(seed).standard_normal((TERMS, LATENT + SPARE))
    q, _ = np.linalg.qr(_products(texts, q, weight))
    y = _products(texts, q, weight)
    value, vector = np.linalg.eigh(q.T @ y)
    order = np.argsort(-value)[:LATENT]
    order = order[value[order] > 1e-6 * value.max()]  # a small benchmark has fewer directions
    rows = (q @ vector[:, order] * weight[:, None]).astype(np.float32)
    size = np.linalg.norm(rows, axis=1)
    rows[size < 1e-3 * size.max()] = 0  # terms that the space does not hold
    return Space(rows, weight.astype(np.float32), known[0], seen)


def index(space: Space, benchmark: list[tuple[int, str]]) -> Index:
    """Items (id, text) in the space; items without a word are left out."""
    latent, item, ids, words, answers = [np.zeros((0, space.rows.shape[1]), np.float32)], [np.zeros(0, int)], [], [], []
    for i, t in benchmark:
        _, _, block = next(_blocks(pa.array([t])))
        if not len(block.starts):
            continue
        _, y = _project(block, space.rows, space.weight)
        latent.append(y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-6))
        item.append(np.full(len(y), len(ids)))
        sentences = [s for s in _SENTENCE.split(t) if s.strip()]
        _, _, last = next(_blocks(pa.array([sentences[-1] if len(sentences) > 1 else ""])))
        ids.append(i)
        words.append(block.hash.copy())
        answers.append(last.hash.copy() if len(last.starts) >= 3 else block.hash[-8:].copy())
    return Index(space, np.concatenate(latent), np.concatenate(item), ids, words, answers, Anchors.of(words, space.vocabulary, space.seen))


def common_length(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Longest common subsequence of each pair of word lists; bit-parallel, all pairs at once, in blocks of 64 words of a."""
    out, n = np.zeros(len(a), np.int64), np.array([len(x) for x in a])
    short = np.flatnonzero((n <= 64) & (n > 0))
    if len(short):
        width = max(len(b[i]) for i in short)
        mask = np.zeros((len(short), width), np.uint64)
        for r, i in enumerate(short):
            order = np.argsort(a[i], kind="stable")
            key, head = np.unique(a[i][order], return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << order.astype(np.uint64), head)
            at = np.searchsorted(key, b[i]).clip(0, len(key) - 1)
            mask[r, : len(b[i])] = np.where(key[at] == b[i], bits[at], np.uint64(0))
        row = np.full(len(short), ~np.uint64(0))
        for col in range(width):
            hit = row & mask[:, col]
            row = (row + hit) | (row - hit)
        full = np.where(n[short] == 64, ~np.uint64(0), (np.uint64(1) << (n[short].astype(np.uint64) & np.uint64(63))) - np.uint64(1))
        out[short] = np.bitwise_count(~row & full)
    for i in np.flatnonzero(n > 64):
        where: dict[int, int] = {}
        for j, w in enumerate(a[i].tolist()):
            where[w] = where.get(w, 0) | 1 << j
        full = row = (1 << len(a[i])) - 1
        for w in b[i].tolist():
            hit = row & where.get(w, 0)
            row = (row + hit | row - hit) & full
        out[i] = len(a[i]) - row.bit_count()
    return out


def _near_lengths(items: list[np.ndarray], item: np.ndarray, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Longest common subsequence of each item, which come in order, with the words from begin to end."""
    out, width = np.zeros(len(item), np.int64), int((end - begin).max(initial=0))
    n = np.array([len(items[i]) for i in item], np.int64)
    short = np.flatnonzero(n <= 64)
    mask = np.zeros((width, len(short)), np.uint64)
    heads = np.flatnonzero(np.concatenate(([True], item[short][1:] != item[short][:-1]))) if len(short) else []
    for a, b in zip(heads, [*heads[1:], len(short)], strict=True):
        words, rows = items[item[short[a]]], short[a:b]
        order = np.argsort(words, kind="stable")
        key, head = np.unique(words[order], return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << order.astype(np.uint64), head)
        at = begin[rows] + np.arange(width)[:, None]
        seen = hashes[np.minimum(at, len(hashes) - 1)]
        place = np.searchsorted(key, seen).clip(0, len(key) - 1)
        mask[:, a:b] = np.where((key[place] == seen) & (at < end[rows]), bits[place], np.uint64(0))
    row = np.full(len(short), ~np.uint64(0))
    for col in mask:
        hit = row & col
        row = (row + hit) | (row - hit)
    full = np.where(n[short] == 64, ~np.uint64(0), (np.uint64(1) << (n[short].astype(np.uint64) & np.uint64(63))) - np.uint64(1))
    out[short] = np.bitwise_count(~row & full)
    long = np.flatnonzero(n > 64)
    out[long] = common_length([items[item[r]] for r in long], [hashes[begin[r] : end[r]] for r in long])
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `item_id`, `similarity`, `lcs_share`, `answer_share`, one row per row of docs and item found in it.

    A pair counts if LCS of the item's words and ANSWER of its answer's stand in the text in order near the passage, or
    LOOSE_LCS and SURE_ANSWER, or, with a cosine of CLOSE, CLOSE_LCS and the answer word by word. Null and empty texts, and items
    without words, match nothing. One space and one count of frequencies serve all items; the corpus is searched once for
    every ITEM_BYTES of them.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").orderBy("item_id")
    space, found = None, None
    for part in _item_blocks(items):
        space = space or fit(docs, items, text)
        pairs = _search(docs, index(space, part), text)
        found = pairs if found is None else found.unionAll(pairs)
    return found if found is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, lcs_share double, answer_share double")


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    part, size = [], 0
    for r in items.toLocalIterator():
        part.append((r["item_id"], r["text"]))
        size += len(r["text"].encode())
        if size >= ITEM_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _search(docs: DataFrame, items: Index, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        for batch in batches:
            for row, _, block in _blocks(batch.column(1)):
                if not len(block.starts) or not len(x.ids):
                    continue
                p = Passages.of(block)
                near, cosine = x.near(block, p)
                passage, item = x.anchors.pairs(block, p)
                keys, cosine = _highest(np.concatenate((near, passage * len(x.ids) + item)), np.concatenate((cosine, np.full(len(item), -1, np.float32))))
                doc, item, share, answer, cosine = _best(x, block, p, *_check(x, block, p, keys // len(x.ids), keys % len(x.ids), cosine))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + doc)), pa.array([x.ids[i] for i in item], pa.int64()), *(pa.array(v, pa.float64()) for v in (cosine, share, answer))],
                    names=["doc_id", "item_id", "similarity", "lcs_share", "answer_share"])

    return docs.select("doc_id", F.col(text)).mapInArrow(work, "doc_id long, item_id long, similarity double, lcs_share double, answer_share double")


def _check(x: Index, block: Block, p: Passages, passage: np.ndarray, item: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, ...]:
    """Passage, item, both shares and cosine of the pairs that count."""
    doc, size = p.doc[passage], x.anchors.size[item]
    begin = np.maximum(block.first[doc], p.start[passage] - size)
    end = np.minimum(block.first[doc + 1], p.start[passage] + 2 * HALF + size)
    order, share, answer = np.argsort(item, kind="stable"), np.zeros(len(item)), np.zeros(len(item))
    for cut in range(0, len(order), 8192):
        rows = order[cut : cut + 8192]
        share[rows] = _near_lengths(x.words, item[rows], block.hash, begin[rows], end[rows]) / size[rows]
    close = (cosine >= CLOSE) & (share >= CLOSE_LCS)
    for r in np.flatnonzero((share >= LOOSE_LCS) | close):
        own, near = x.answers[item[r]], block.hash[begin[r] : end[r]]
        answer[r] = int(common_length([own], [near])[0]) / len(own)
        close[r] = close[r] and answer[r] == 1 and _whole(own, near)
    good = np.flatnonzero((share >= LCS) & (answer >= ANSWER) | (share >= LOOSE_LCS) & (answer >= SURE_ANSWER) | close)
    return passage[good], item[good], share[good], answer[good], cosine[good]


def _whole(words: np.ndarray, near: np.ndarray) -> bool:
    """Do the words stand one after another?"""
    starts = np.flatnonzero(near[: max(0, len(near) - len(words) + 1)] == words[0])
    return bool((near[starts[:, None] + np.arange(len(words))] == words).all(1).any())


def _best(x: Index, block: Block, p: Passages, passage: np.ndarray, item: np.ndarray, share: np.ndarray, answer: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, item, shares and cosine of each document's best passage for an item: highest share, answer, then cosine.

    Where the anchors alone found all passages with the highest shares, their cosines are taken now.
    """
    def last(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((*keys, item, p.doc[passage]))
        pair = p.doc[passage[order]] * len(x.ids) + item[order]
        return order, np.append(pair[1:] != pair[:-1], True) if len(pair) else np.zeros(0, bool)

    order, end = last(cosine, answer, share)
    top = np.zeros(len(item), np.int64)
    top[order] = order[np.flatnonzero(end)[np.cumsum(end) - end]]
    rest = np.flatnonzero((cosine[top] < NEAR) & (share == share[top]) & (answer == answer[top]))
    first = np.searchsorted(x.item, np.arange(len(x.ids) + 1))
    for lo, y in _parts(block, p, x.space.rows, x.space.weight, passage[rest]):
        for r in rest[(passage[rest] >= lo) & (passage[rest] < lo + PART)]:
            cosine[r] = (x.latent[first[item[r]] : first[item[r] + 1]] @ y[passage[r] - lo]).max()
    order, end = last(cosine, answer, share)
    top = order[end]
    return p.doc[passage[top]], item[top], share[top], answer[top], cosine[top]
