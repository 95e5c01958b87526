"""Byte-level BPE by monoid tree reduction.

A text is cut in halves down to leaves. A node holds (head, chunks, tail): the tokens of the chunks in its middle, which
nothing outside the node can change; head and tail are the text at its borders, which can. Two nodes are joined by re-encoding
the window tail + head at the seam. The window grows up the tree until it reaches a place on either side that provably
stands whatever surrounds it:

* Matches of the pattern. A space before a character that is no white space always begins a match: only the last space
  of a run can be part of the next match, and no match reaches over it. So a middle reaches from such a place to another.
* Merges in one long match. A token sequence is the encoding of its bytes if every pair of neighbours is the encoding
  of the pair's bytes. Long matches are cut in halves too, and a seam's window is doubled until the pairs at its two
  borders hold.

So a leaf need not be encoded in place: it is a list of chunks between two such places, each with a place at either end,
and the different chunks of a batch are encoded together. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import text_bytes

LEAF_CHARS, LEAF_BYTES, ROWS = 16384, 32, 512
# What a worker remembers of chunks it has encoded: bytes in all, characters of one chunk, and bytes beside its text and ids.
HELD_BYTES, HELD_CHARS, ENTRY_BYTES = 64 << 20, 64, 160
_NONE = 1 << 30
_UNSAFE, _CUT = re.compile(r" (?:\s|\Z)"), re.compile(r" (?=\S)")

Node = tuple[str, list[str], str] | str


class Pairs:
    """Rank of the token that two neighbouring tokens make, for arrays of pairs: an open hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        known = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.bits = max(4, (4 * len(known)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NONE, np.int32)
        key, value = np.array([k for k, _ in known], np.int64), np.array([v for _, v in known], np.int32)
        at = self._slot(key)
        while len(key):
            free = self.keys[at] == -1
            self.keys[at[free]], self.values[at[free]] = key[free], value[free]
            lost = self.keys[at] != key  # another key took the slot
            key, value, at = key[lost], value[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.values[at], _NONE)
        todo = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[todo]]
            out[todo] = np.where(found == key[todo], self.values[at[todo]], _NONE)
            todo = todo[(found != key[todo]) & (found != -1)]
        return out


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find, self.pairs = ranks, regex.compile(pattern).findall, Pairs(ranks)
        self.bytes_of = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.first = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        raw = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.raw, self.raw_at = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw])))
        self.stands = lru_cache(1 << 15)(self._stands)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str | tuple[str], int] = {}
        self.held = 0
        self.at, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    # merges in one match

    def _merge(self, raw: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals; a heap and a linked list."""
        ranks, n = self.ranks, len(raw)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, to = heappop(heap)
            mid = end[i]
            if mid < 0 or mid >= n or end[mid] != to:
                continue
            end[i], end[mid] = to, -1
            if to < n:
                before[to] = i
                if (r := ranks.get(raw[i : end[to]])) is not None:
                    heappush(heap, (r, i, end[to]))
            if (j := before[i]) >= 0 and (r := ranks.get(raw[j:to])) is not None:
                heappush(heap, (r, j, to))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : end[i]]])
            i = end[i]
        return out

    def _merge_all(self, raws: list[bytes]) -> list[list[int]]:
        """The same for many short byte strings at once: a row each, one merge a row and round."""
        width = max(map(len, raws))
        size = np.array([len(x) for x in raws])
        data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raws), np.uint8).reshape(len(raws), width)
        column = np.arange(width)
        token = np.where(column < size[:, None], self.first[data], -1)
        rank = np.full((len(raws), width), _NONE, np.int32)  # of a token and the next one
        pair = column[:-1] + 1 < size[:, None]
        rank[:, :-1][pair] = self.pairs.get(token[:, :-1][pair], token[:, 1:][pair])
        live = np.arange(len(raws))
        while len(live):
            at = rank[live].argmin(1)
            best = rank[live, at]
            some = best < _NONE
            live, at, best = live[some], at[some], best[some]
            if not len(live):
                break
            shift = np.minimum(column + (column > at[:, None]), width - 1)
            token[live] = np.take_along_axis(token[live], shift, 1)
            token[live, -1] = -1
            shift = np.minimum(column + (column >= at[:, None]), width - 1)
            rank[live] = np.take_along_axis(rank[live], shift, 1)
            rank[live, -1] = _NONE
            token[live, at] = best
            for side in (at - 1, at):
                ok = (side >= 0) & (side + 1 < width)
                row, col = live[ok], side[ok]
                next_one = token[row, col + 1]
                rank[row, col] = np.where(next_one >= 0, self.pairs.get(token[row, col], np.maximum(next_one, 0)), _NONE)
        return [row[:n] for row, n in zip(token.tolist(), (token >= 0).sum(1).tolist(), strict=True)]

    def _stands(self, left: int, right: int) -> bool:
        return self._merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if self.stands(left[-1], right[0]):
            return left + right
        width, raw = 2, self.bytes_of
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self._merge(b"".join([raw[t] for t in left[a:]]) + b"".join([raw[t] for t in right[:b]]))
            if (a == 0 or self.stands(left[a - 1], window[0])) and (b == len(right) or self.stands(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def _tokens(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF_BYTES:
            return self._merge(raw)
        half = len(raw) // 2
        return self._join_tokens(self._tokens(raw[:half]), self._tokens(raw[half:]))

    def _pieces(self, matches: list[str]) -> dict[str, list[int]]:
        """Ids of each match: a token of its own, or merged."""
        out, short = {}, {}
        for m in matches:
            raw = m.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[m] = [rank]
            elif len(raw) > LEAF_BYTES:
                out[m] = self._tokens(raw)
            else:
                short.setdefault((len(raw) + 3) // 4, []).append((m, raw))
        for group in short.values():
            for a in range(0, len(group), 1 << 14):
                part = group[a : a + (1 << 14)]
                out.update(zip([m for m, _ in part], self._merge_all([raw for _, raw in part]), strict=True))
        return out

    def _learn(self, chunks: list[str | tuple[str]]) -> None:
        """Ids of texts that begin and end where a match must: a str has a space before it, a tuple has not."""
        # Letters alone are one match; beyond Latin, the pattern's own tables decide what a letter is.
        plain = [isinstance(c, str) and c.isalpha() and (c.isascii() or max(c) < "\u0250") for c in chunks]
        found = [(" " + c,) if one else self.find(" " + c if isinstance(c, str) else c[0]) for c, one in zip(chunks, plain, strict=True)]
        ids = self._pieces(list(set(chain.from_iterable(found))))
        rows = [ids[f[0]] if len(f) == 1 else [t for m in f for t in ids[m]] for f in found]
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))
        self.at = np.concatenate((self.at, self.at[-1] + np.cumsum([len(r) for r in rows], dtype=np.int64)))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(rows), np.int32)))

    def _drop(self, chunks: list[str | tuple[str]]) -> None:
        """Forget the chunks that were learned last."""
        for c in chunks:
            del self.known[c]
        self.at = self.at[: len(self.known) + 1]
        self.flat = self.flat[: self.at[-1]]

    # matches in a text

    def _node(self, text: str, lo: int, hi: int) -> Node:
        if hi - lo > LEAF_CHARS:
            mid = (lo + hi) // 2
            return self._join(self._node(text, lo, mid), self._node(text, mid, hi))
        text = text[lo:hi]
        words = text.split(" ") if _UNSAFE.search(text) is None else _CUT.split(text)
        return (words[0], words[1:-1], words[-1]) if len(words) > 1 else text

    def _join(self, left: Node, right: Node) -> Node:
        if isinstance(left, str):
            return left + right if isinstance(right, str) else (left + right[0], right[1], right[2])
        if isinstance(right, str):
            return left[0], left[1], left[2] + right
        left[1].append(left[2] + right[0])
        left[1].extend(right[1])
        return left[0], left[1], right[2]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's bounds in them."""
        chunks: list[str | tuple[str]] = []
        ends = []
        for text in texts:
            node = self._node(text, 0, len(text))
            if isinstance(node, str):
                chunks.append((node,))
            else:
                chunks.append((node[0],))
                chunks += node[1]
                chunks.append(node[2])
            ends.append(len(chunks))
        if self.held > HELD_BYTES:
            self.forget()
        fresh = list(set(chunks).difference(self.known))
        sizes = [len(c) if isinstance(c, str) else len(c[0]) for c in fresh]
        short = [c for c, n in zip(fresh, sizes, strict=True) if n <= HELD_CHARS]
        long = [c for c, n in zip(fresh, sizes, strict=True) if n > HELD_CHARS]
        for group in (short, long):
            if group:
                self._learn(group)
        self.held += ENTRY_BYTES * len(short) + 2 * sum(n for n in sizes if n <= HELD_CHARS)
        place = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        ids, bounds = _gather(self.flat, self.at[place], self.at[place + 1])
        self._drop(long)
        return ids, np.concatenate(([0], bounds[ends])) if ends else np.zeros(1, np.int64)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in a row, and each text's bounds in them."""
        raw, at = _gather(self.raw, self.raw_at[ids], self.raw_at[ids + 1])
        return raw, at[bounds]

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0].tobytes()


def _gather(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of flat one after another, and their bounds."""
    size = ends - starts
    bounds = np.concatenate(([0], np.cumsum(size)))
    return flat[np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], size)], bounds


@lru_cache(2)
def load(vocabulary: str, pattern: str | None = None) -> Bpe:
    """The ranks of a vocabulary file of the installed tokenizer package, read where the code runs."""
    import public_tokenizers as P

    with open(P.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Bpe(ranks, pattern or P.PATTERN)


VOCABULARY = "byte_bpe_50k.tiktoken"


@contextmanager
def lent(vocabulary: str) -> Iterator[Bpe]:
    """The encoder for one task: a worker outlives its tasks, so what it remembers of their texts goes at the end of each."""
    bpe = load(vocabulary)
    try:
        yield bpe
    finally:
        bpe.forget()


def _parts(batch: pa.RecordBatch, column: int, size) -> Iterator[pa.RecordBatch]:
    """Slices of at most ROWS rows and about 1 MB (a row at least)."""
    start, sizes = 0, size(batch.column(column))
    while start < batch.num_rows:
        total = np.cumsum(sizes[start : start + ROWS])
        step = max(1, int(np.searchsorted(total, 1 << 20)))
        yield batch.slice(start, step)
        start += step


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",), text: str = "text", decoded: bool = False) -> DataFrame:
    """The kept columns and `ids`, the token ids of the whole text in order; with `decoded`, also the bytes they decode to.

    Null and empty texts give an empty list. Each row is encoded by itself, so ties, repeated rows and columns of any
    other name do not matter.
    """
    at = len(keep)
    schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)) + ", ids array<int>" + ", decoded binary" * decoded

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lent(vocabulary) as bpe:
            for batch in batches:
                for part in _parts(batch, at, lambda c: np.diff(text_bytes(c)[1])):
                    ids, bounds = bpe.encode_all([x or "" for x in part.column(at).to_pylist()])
                    out = [*part.columns[:at], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
                    if decoded:
                        out.append(_binary(*bpe.decode_all(ids, bounds)))
                    yield pa.RecordBatch.from_arrays(out, names=[*(f"_{i}" for i in range(at)), "ids", *["decoded"] * decoded])

    chosen = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"))
    return chosen.mapInArrow(work, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "ids", *["decoded"] * decoded)


def _binary(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """One `n_tokens` per row of docs; a null text has length 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lent(vocabulary) as bpe:
            for batch in batches:
                for part in _parts(batch, 0, lambda c: np.diff(text_bytes(c)[1])):
                    _, bounds = bpe.encode_all([x or "" for x in part.column(0).to_pylist()])
                    yield pa.RecordBatch.from_arrays([pa.array(np.diff(bounds), pa.int64())], names=["n_tokens"])

    return docs.select(text).mapInArrow(work, "n_tokens long")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, `ids` and `decoded`, the bytes the ids stand for (UTF-8 where they came from text). A null list gives no bytes."""
    at = len(keep)
    schema = ", ".join(f"_{i} {encoded.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)) + ", ids array<int>, decoded binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            for part in _parts(batch, at, lambda c: 4 * np.diff(c.offsets.to_numpy())):
                offsets = part.column(at).offsets.to_numpy()
                ids = part.column(at).values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                yield pa.RecordBatch.from_arrays([*part.columns, _binary(*bpe.decode_all(ids, offsets - offsets[0]))], names=[*(f"_{i}" for i in range(at)), "ids", "decoded"])

    chosen = encoded.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), "ids")
    return chosen.mapInArrow(work, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "ids", "decoded")


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the bytes they decode to."""
    both = encode(docs, vocabulary, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
