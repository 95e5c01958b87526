"""Periodic runs in the words of a text, found by catching squares from dyadic blocks.

A run is a stretch of consecutive words that repeats with its smallest period p at least `exponent` times and that no
neighbouring word extends. Every square of period p has, in its first half, a whole block [mS, mS + S) of the largest
power of two S with 2S - 1 <= p. So each completed block of size S becomes a catcher for the periods 2S - 1 to 4S - 2: it
is compared with the suffix of length S that each appended word completes, from 2S - 1 to 4S - 2 words later, and then
closes. An appended word is heard by two live catchers on each level, so a text of n words takes 2 n comparisons a level
and there are log2(n) levels. A catcher's hit is a pair of equal blocks p words apart. Hits of one period in neighbouring
blocks are one stretch, which suffix and prefix comparisons extend at its two ends; a stretch that holds the asked number
of periods is a run. Runs of small periods are known before those of larger ones, and take the hits of their multiples.

The words of a document are all at hand, so the comparisons are made a level at a time for all words of a batch: row m
of the comparison matrix is the catcher of block m, column d an appended word. Documents follow each other with a word
of its own between them that equals no other.

Words are known by 64-bit hashes. Blocks are named by hashes that are mixed anew at each doubling (sums of powers would
meet in Thue-Morse texts); every stretch is then compared word by word, so a false hit of a block makes no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Block, blocks, mix

MIN_LENGTH, EXPONENT = 6, 4
_LEFT, _RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)
_BETWEEN = np.uint64(0x165667B19E3779F9)


def _reach(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words in a row, from `at` on in the direction of step, equal the word a period later."""
    n, live, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    while len(live):
        x = at[live, None] + step * (n[live, None] + np.arange(width))
        ok = (x >= 0) & (x + period[live, None] < len(words))
        x = np.where(ok, x, 0)
        ok &= words[x] == words[np.where(ok, x + period[live, None], 0)]
        whole = ok.all(1)
        n[live] += np.where(whole, width, ok.argmin(1))
        live = live[whole]
        width = int(min(2 * width, 1 << 14, max(8, (1 << 20) // max(1, len(live)))))
    return n


def _primitive(words: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """False where a proper divisor of the period is a period too; it is enough to try period / prime."""
    which, parts = [], []
    for p in np.unique(period).tolist():
        same, left, prime = np.flatnonzero(period == p), p, 2
        while left > 1:
            if prime * prime > left:
                prime = left
            if left % prime == 0:
                which.append(same)
                parts.append(np.full(len(same), p // prime))
                while left % prime == 0:
                    left //= prime
            prime += 1
    out = np.ones(len(start), bool)
    if which:
        at, q = np.concatenate(which), np.concatenate(parts)
        out[at[_reach(words, start[at], q, 1) >= length[at] - q]] = False
    return out


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + size)."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)


def runs_of(words: np.ndarray, longest: int, least: int = MIN_LENGTH, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs of `least` words and `exponent` periods at least, none beyond `longest` words."""
    names, size, total = words, 1, len(words)
    known, until = np.ones(total, np.int64), np.zeros(total, np.int64)  # period and end of a run that a word is in
    out = [np.zeros((3, 0), np.int64)]
    while 2 * size - 1 <= longest // exponent and total >= size:
        rows, first = total // size, 2 * size - 1
        padded = np.zeros(rows * size + 4 * size, np.uint64)
        padded[: len(names)] = names
        later = np.lib.stride_tricks.as_strided(padded[first:], (rows, 2 * size), (8 * size, 8))
        at = np.flatnonzero(later == padded[: rows * size : size, None])
        block, off = np.divmod(at, 2 * size)
        lo, period = block * size, off + first
        fits = lo + period < len(names)
        fits &= (until[lo] < lo + period + size) | (period % known[lo] != 0)
        block, period = block[fits], period[fits]
        order = np.argsort(period, kind="stable")
        block, period = block[order], period[order]
        new = np.ones(len(block), bool)
        new[1:] = (period[1:] != period[:-1]) | (block[1:] != block[:-1] + 1)
        head = np.flatnonzero(new)
        hits = np.diff(np.append(head, len(block)))
        lo, period = block[head] * size, period[head]
        need = np.maximum(exponent * period, least) - period
        enough = hits >= np.maximum(1, -((2 * (size - 1) - need) // size))
        lo, period = lo[enough], period[enough]
        back = _reach(words, lo - 1, period, -1)
        start, length = lo - back, back + _reach(words, lo, period, 1) + period
        long = length >= np.maximum(exponent * period, least)
        found = np.unique(np.stack([start[long], length[long], period[long]]), axis=1)
        found = found[:, _primitive(words, *found)]
        out.append(found)
        inside = _spread(found[0], found[1])
        known[inside], until[inside] = np.repeat(found[2], found[1]), np.repeat(found[0] + found[1], found[1])
        if total <= 2 * size:
            break
        names = mix(names[:-size] * _LEFT ^ mix(names[size:] * _RIGHT))
        size *= 2
    found = np.concatenate(out, axis=1)
    return tuple(found[:, np.lexsort((found[2], found[0]))])


def _collapsed(block: Block, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of each document's kept words, joined by one space."""
    data, doc = block.data.copy(), block.doc[kept]
    more = np.zeros(len(kept), bool)
    at = np.flatnonzero(kept)
    more[at[:-1]] = doc[1:] == doc[:-1]  # another kept word follows in the document
    step = np.zeros(len(data) + 1, np.int8)
    step[block.starts[kept]] += 1
    np.subtract.at(step, block.ends[kept], 1)
    flag = np.cumsum(step[:-1], dtype=np.int8) > 0
    gaps = block.ends[more]
    flag[gaps], data[gaps] = True, 32
    return data[flag], np.concatenate(([0], np.cumsum(flag)))[block.offsets]


def _work(block: Block, least: int, exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    n, base, doc = block.n_words, block.first[:-1] + np.arange(block.n_docs), block.doc
    words = np.empty(len(doc) + block.n_docs, np.uint64)
    place = np.arange(len(doc)) + doc
    words[place] = block.hash
    words[base + n] = mix(np.arange(1, block.n_docs + 1, dtype=np.uint64) * _BETWEEN)
    start, length, period = runs_of(words, int(n.max(initial=0)), least, exponent)
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, start + period, 1)
    np.subtract.at(gone, start + length, 1)
    raw, offsets = _collapsed(block, np.cumsum(gone)[place] == 0)
    owner = np.searchsorted(base, start, "right") - 1
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - base[owner], length, period)], names=["start", "length", "period"])
    bounds = np.searchsorted(owner, np.arange(block.n_docs + 1))
    text = pa.Array.from_buffers(pa.string(), block.n_docs, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
    return pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs), text


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", least: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """The kept columns, `n_words`, `runs` (array of start, length, period in words, by start and period) and `collapsed_text`.

    A word is left out of the collapsed text if a run contains it after that run's first period; the others are joined
    by one space. Null and empty texts have no words, no runs and an empty collapsed text. Each row is worked on by
    itself: rows that repeat, null ids and columns of any name make no difference, and an empty table gives no rows.
    """
    at = len(keep)
    schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    schema += ", n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, block in blocks(batch.column(at)):
                part = [c.slice(a, b - a) for c in batch.columns[:at]]
                yield pa.RecordBatch.from_arrays([*part, *_work(block, least, exponent)], names=[*(f"_{i}" for i in range(at)), "n_words", "runs", "collapsed_text"])

    chosen = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"))
    found = chosen.mapInArrow(work, schema)
    return found.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "n_words", "runs", "collapsed_text")


def looped(doc_id: Column, text: Column) -> Column:
    """The text that the query looks at: one in ten repeats its tail, from a word on and with a period that its id gives.

    With h = crc32(id), a text of n words and h % 10 = 0 goes on from word a = (h / 10) % n with period
    1 + (n - a) / (3 + (h / 10) % 8). A text without words or without an id stays as it is.
    """
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h, n = F.crc32(doc_id.cast("string")), F.size(words)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(text)
