"""Substring dedup: windows of WINDOW words that start more than once, found with FM-indexes.

1. Every window gets a key: the smallest hash of the 8-word runs in it. Equal windows have equal keys. Consecutive
   windows with one key make a segment (at most 28 windows).
2. Segments whose key occurs once cannot repeat; counting keys drops them. Equal segments are folded to one with a count.
3. What is left is dealt to shards by key. A shard builds an FM-index (Burrows-Wheeler text in a wavelet matrix with
   packed bits and block counts) over its segments and streams them through it: backward search gives the longest
   stretch ending at a place that occurs twice; stretches of WINDOW words and more are reported. Only whole keys share
   an index, and an index is closed at INDEX_WORDS words.
4. A key with over HOT different segments (the rim of a passage that a large share of all documents holds) is dealt
   anew by the hash of each single window, which cannot be hot: equal windows fold to one.

Segments travel as hashes; words only once per different segment, and texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Block, blocks, saved

WINDOW, RUN, INDEX_WORDS, HOT = 35, 8, 1 << 17, 16_384
#: Text worked on at once. The arrays made of it are some fifty times as large, and a worker keeps what it once took.
TEXT_BYTES = 1 << 17
SEGMENT = "key long, digest long, d long, p long, n int, w int"
_NAMES = ["key", "digest", "d", "p", "n", "w"]


class FmIndex:
    """Counts of word runs in a text of integer symbols; 0 parts segments and is in no query."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        order, rank, k = None, np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        while k < depth and (order is None or rank.max() < n - 1):  # prefix doubling, as deep as queries are long
            nxt = np.zeros(n, np.int64)
            nxt[:-k] = rank[k:] + 1
            pair = rank * (n + 1) + nxt
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            rank[order] = np.concatenate(([0], np.cumsum(pair[1:] != pair[:-1])))
            k *= 2
        order = np.argsort(text, kind="stable") if order is None else order
        last = text[order - 1]
        self.n, self.levels = n, max(1, int(text.max()).bit_length())
        before = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.bits, self.counts, self.zeros = [], [], []
        row = last
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level & 1).astype(np.uint8)
            packed = np.zeros((n >> 6) + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            self.bits.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1])))
            self.zeros.append(n - int(bit.sum()))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        # Where the symbol's own stretch begins in the lowest level.
        begin = np.zeros(len(before), np.int64)
        heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        begin[row[heads]] = heads
        self.shift = before - begin

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The bound of the suffix range after one more symbol on the left."""
        for level, bits, counts, zeros in zip(range(self.levels - 1, -1, -1), self.bits, self.counts, self.zeros, strict=True):
            word, inside = at >> 6, (at & 63).astype(np.uint64)
            ones = counts[word] + np.bitwise_count(bits[word] & ((np.uint64(1) << inside) - np.uint64(1)))
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at + self.shift[symbol]


def repeated(words: np.ndarray, bounds: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, last window): runs of windows that occur at two places or more of the segments.

    Every segment is swept from its right end. A search that ends before `width` words is followed by short searches
    next to the word where it failed, which show how far to jump.
    """
    sizes = np.diff(bounds)
    symbols = np.unique(words, return_inverse=True)[1] + 1
    text = np.zeros(len(words) + len(sizes) + 1, np.int64)
    base = bounds[:-1] + np.arange(len(sizes)) + 1
    text[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = symbols
    index = FmIndex(text, int(sizes.max()))
    lane = np.flatnonzero(sizes >= width)
    e = sizes[lane].copy()
    s, lo, hi = e.copy(), np.zeros(len(lane), np.int64), np.full(len(lane), index.n)
    f, q, old = np.full(len(lane), -1), np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def restart(m: np.ndarray, end: np.ndarray) -> None:
        e[m], s[m], lo[m], hi[m] = end, end, 0, index.n

    def main(m: np.ndarray, end: np.ndarray) -> None:
        f[m] = -1
        restart(m, end)

    while len(lane):
        c = text[base[lane] + s - 1]
        both = index.step(np.concatenate((c, c)), np.concatenate((lo, hi)))
        new_lo, new_hi = both[: len(lane)], both[len(lane) :]
        ok, probing = new_hi - new_lo >= 2, f >= 0
        s = np.where(ok, s - 1, s)
        lo, hi = np.where(ok, new_lo, lo), np.where(ok, new_hi, hi)
        hit = np.flatnonzero(~probing & ((ok & (s == 0)) | ~ok) & (e - s >= width))
        if len(hit):
            found.append((lane[hit], s[hit], e[hit] - width))
        done = ~probing & ok & (s == 0)
        far = np.flatnonzero(~probing & ~ok & (e - s >= width))
        main(far, s[far] - 1 + width)
        near = ~probing & ~ok
        near[far] = False
        near = np.flatnonzero(near)
        f[near], q[near], old[near] = s[near] - 1, 3, e[near]
        up = np.flatnonzero(probing & ok & (s == f))
        q[up] *= 2
        tried = np.concatenate((near, up))
        known = f[tried] + q[tried] >= old[tried]
        back = tried[known]
        main(back, old[back] - 1)
        on = tried[~known]
        restart(on, f[on] + q[on])
        failed = np.flatnonzero(probing & ~ok)
        main(failed, f[failed] + q[failed] - 1)
        done |= (f < 0) & (e < width)
        if done.any():
            keep = ~done
            lane, e, s, lo, hi, f, q, old = (x[keep] for x in (lane, e, s, lo, hi, f, q, old))
    return tuple(np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(3))


def _windows(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows and their keys."""
    n = len(block.starts)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = block.doc
    at = np.arange(n - WINDOW + 1)
    low = block.runs(np.arange(n - RUN + 1), np.arange(RUN, n + 1))
    reach = 1
    while 2 * reach <= WINDOW - RUN + 1:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = WINDOW - RUN + 1 - reach
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    own = doc[: len(at)] == doc[WINDOW - 1 :]
    return at[own], low[: len(at)][own]


def _segments(block: Block) -> tuple[np.ndarray, ...]:
    """(document, first word in it, words, key, digest, weight) of each segment.

    The weight is 2 if the run of words behind the key occurs again in the segment, so that its windows may repeat.
    """
    at, key = _windows(block)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int32),)
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)))
    head = np.flatnonzero(new)
    run = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    head = np.flatnonzero(run % (WINDOW - RUN + 1) == 0)
    last = np.append(head[1:], len(at)) - 1
    a, b = at[head], at[last] + WINDOW
    doc = block.doc[a]
    key, size = key[head], b - a - RUN + 1
    start = np.cumsum(size) - size
    inner = np.arange(size.sum()) + np.repeat(a - start, size)
    same = block.runs(inner, inner + RUN) == np.repeat(key, size)
    weight = np.minimum(2, np.add.reduceat(same, start, dtype=np.int32))
    return doc, a - block.first[doc], b - a, key, block.runs(a, b), weight


def _place(first: np.ndarray, t: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 32 | t.astype(np.int64)


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _own(text: str) -> Column:
    """The id; a row without one takes a hash of its text, so that many of them do not share an id."""
    return F.coalesce("doc_id", F.xxhash64(F.lit("no id"), F.col(text)))


def _rows(docs: DataFrame, text: str) -> DataFrame:
    """A row is known by (d, t): its id and 31 bits of its text's hash. Equal rows are treated equally."""
    return docs.select("doc_id", _own(text).alias("d"), _low(F.xxhash64(text)).alias("t"), F.col(text).alias("text"))


def _found(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, end, block in blocks(batch.column(2), size=TEXT_BYTES):
                doc, first, n, key, digest, weight = _segments(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(d[row:end][doc]), pa.array(_place(first, t[row:end][doc])), pa.array(n.astype(np.int32)), pa.array(weight, pa.int32())],
                    names=_NAMES)

    return rows.select("d", "t", "text").mapInArrow(work, SEGMENT)


def _asked(listed: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows with the list `asked` of (first word, words, key, digest) that belongs to them."""
    per = listed.select("d", _low(F.col("p")).alias("t"), F.struct(F.shiftright("p", 32).cast("int").alias("first"), "n", "key", "digest").alias("x"))
    return rows.join(per.groupBy("d", "t").agg(F.collect_list("x").alias("asked")), ["d", "t"])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Block, np.ndarray, tuple[np.ndarray, ...]]]:
    """Blocks of a batch (d, t, text, asked) with the asked segments' documents and fields."""
    asked = batch.column(3)
    offsets, flat = asked.offsets.to_numpy(), asked.values
    fields = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)]
    for row, end, block in blocks(batch.column(2), size=TEXT_BYTES):
        lo, hi = offsets[row], offsets[end]
        yield row, end, block, np.repeat(np.arange(end - row), np.diff(offsets[row : end + 1])), tuple(x[lo:hi] for x in fields)


def _single(listed: DataFrame, rows: DataFrame) -> DataFrame:
    """The windows of the listed segments as segments of their own, each with a key of its own."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, end, block, doc, (first, n, _, _) in _parts(batch):
                count = n - WINDOW + 1
                doc, start = np.repeat(doc, count), np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at = block.first[doc] + start
                digest = block.runs(at, at + WINDOW)
                key = digest ^ np.uint64(0x5851F42D4C957F2D)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(d[row:end][doc]), pa.array(_place(start, t[row:end][doc])), pa.array(np.full(len(at), WINDOW, np.int32)), pa.array(np.ones(len(at), np.int32))],
                    names=_NAMES)

    return _asked(listed, rows).select("d", "t", "text", "asked").mapInArrow(work, SEGMENT)


def _contents(listed: DataFrame, rows: DataFrame) -> DataFrame:
    """`key`, `digest`, `words`: the word hashes of the listed segments."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, block, doc, (first, n, key, digest) in _parts(batch):
                a = block.first[doc] + first
                raw = [block.hash[i : i + k].tobytes() for i, k in zip(a.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(digest), pa.array(raw, pa.binary())], names=["key", "digest", "words"])

    return _asked(listed, rows).select("d", "t", "text", "asked").mapInArrow(work, "key long, digest long, words binary")


def _search(contents: DataFrame) -> DataFrame:
    """`key`, `digest`, `first`, `last`: runs of repeated windows in the segments, counted from the segment's start."""
    def search(keys: list[int], digests: list[int], words: list[bytes]) -> pa.RecordBatch:
        bounds = np.concatenate(([0], np.cumsum([len(w) // 8 for w in words])))
        segment, first, last = repeated(np.frombuffer(b"".join(words), np.uint64), bounds)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(keys, np.int64)[segment]), pa.array(np.array(digests, np.int64)[segment]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
            names=["key", "digest", "first", "last"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, digests, words, size = [], [], [], 0
        for batch in batches:
            for k, g, w in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if size > 8 * INDEX_WORDS and k != keys[-1]:
                    yield search(keys, digests, words)
                    keys, digests, words, size = [], [], [], 0
                if keys and keys[-1] == k and digests[-1] == g:
                    continue  # the same segment out of a repeated row
                keys.append(k)
                digests.append(g)
                words.append(w)
                size += len(w)
        if keys:
            yield search(keys, digests, words)

    n = max(1, int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = contents.repartition(n, "key").sortWithinPartitions("key", "digest")
    return dealt.mapInArrow(work, "key long, digest long, first int, last int")


def repeated_spans(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """`d`, `t`, `spans`: per row of `_rows` with any, the word spans [first, end) that repeated windows cover."""
    found = _found(rows)
    again = found.groupBy("key").agg(F.sum("w").alias("c")).where("c > 1").select("key")
    listed = saved(found.join(again, "key"))
    kinds = listed.groupBy("key", "digest").agg(F.count("*").alias("c"), F.first("d").alias("d"), F.first("p").alias("p"), F.first("n").alias("n"))
    crowded = saved(kinds.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("key"))
    if not crowded.isEmpty():
        split = _single(listed.join(crowded, "key"), rows)
        split = split.join(split.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "key")
        listed = saved(listed.join(crowded, "key", "left_anti").select("key", "digest", "d", "p", "n").union(split.select("key", "digest", "d", "p", "n")))
        kinds = listed.groupBy("key", "digest").agg(F.count("*").alias("c"), F.first("d").alias("d"), F.first("p").alias("p"), F.first("n").alias("n"))
    kinds = saved(kinds)
    # A segment that occurs twice repeats whole; it needs no search, but the others are searched in it.
    alone = kinds.groupBy("key").agg(F.max("c").alias("most"), F.min("c").alias("least"))
    searched = kinds.join(alone.where("least = 1").select("key"), "key")
    spans = _search(_contents(searched, rows)).union(
        kinds.where("c > 1").select("key", "digest", F.lit(0).alias("first"), (F.col("n") - WINDOW).alias("last")))
    placed = listed.join(spans, ["key", "digest"]).select(
        "d", _low(F.col("p")).alias("t"), (F.shiftright("p", 32) + F.col("first")).cast("int").alias("first"),
        (F.shiftright("p", 32) + F.col("last") + WINDOW).cast("int").alias("end"))
    return placed.groupBy("d", "t").agg(F.collect_list(F.struct("first", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", hot: int = HOT) -> DataFrame:
    """The kept columns, `kept_text`, `n_words`, `n_removed`: every word in a window that also starts elsewhere is gone.

    kept_text is the remaining words joined by one space. Windows are judged on the input. Null and short texts have no
    windows; rows that are equal in id and text see each other as repeats, as any two rows do.
    """
    rows = _rows(docs, text)
    spans = repeated_spans(rows, hot)
    own = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), _own(text).alias("d"), _low(F.xxhash64(text)).alias("t"), F.col(text).alias("text"))
    joined = own.join(spans, ["d", "t"], "left").select(*(f"_{i}" for i in range(len(keep))), "text", "spans")
    at = len(keep)
    fields = [*(docs.schema[c].simpleString().split(":", 1) for c in keep)]
    schema = ", ".join(f"_{i} {kind}" for i, (_, kind) in enumerate(fields)) + ", kept_text string, n_words long, n_removed long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(at + 1)
            offsets = asked.offsets.to_numpy()
            first, last = (asked.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            kept, words, gone = [], [], []
            for row, end, block in blocks(batch.column(at), size=TEXT_BYTES):
                lo, hi = offsets[row], offsets[end]
                base = block.first[np.repeat(np.arange(end - row), np.diff(offsets[row : end + 1]))]
                cover = np.zeros(len(block.starts) + 1, np.int64)
                np.add.at(cover, base + first[lo:hi], 1)
                np.add.at(cover, base + last[lo:hi], -1)
                stay = np.cumsum(cover)[:-1] == 0
                # Bytes of the kept words, each with the byte after it, which is then made a space.
                width = np.where(stay, block.ends - block.starts + 1, 0)
                sizes, w = block.per_doc(width, block.first), width[stay]
                ends = np.cumsum(w)
                index = np.repeat(block.starts[stay] - (ends - w), w) + np.arange(w.sum())
                flat = np.append(block.data, np.uint8(32))[index]
                flat[ends - 1] = 32
                raw, at_byte = flat.tobytes(), np.concatenate(([0], np.cumsum(sizes)))
                kept += [raw[a : max(a, b - 1)].decode() for a, b in zip(at_byte[:-1].tolist(), at_byte[1:].tolist(), strict=True)]
                words.append(block.n_words)
                gone.append(block.per_doc(~stay, block.first))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(kept, pa.string()), pa.array(np.concatenate(words) if words else [], pa.int64()), pa.array(np.concatenate(gone) if gone else [], pa.int64())],
                names=[*(f"_{i}" for i in range(at)), "kept_text", "n_words", "n_removed"])

    done = joined.mapInArrow(work, schema)
    return done.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "kept_text", "n_words", "n_removed")
