"""Words, hashes and folders shared by the corpus operators.

A word is a run of bytes other than space and 0x09-0x0D. Batches are worked on as one byte array with numpy:
no Python loop over words. A batch is cut between documents into blocks of about BLOCK_BYTES, so memory stays
bounded by the larger of that and one document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
HELD_OUT = 2  # crc32(doc_id) mod 4 of the rows that nothing is learned from

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows kept for measuring; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == HELD_OUT


def saved(df: DataFrame) -> DataFrame:
    """The rows, stored in the folder that spark.checkpoint.dir names, and read from there.

    Where the session names none (tests), its warehouse folder is used.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/furlong-checkpoints"
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, bound: int, rows: int, *key: str) -> DataFrame:
    """About min(rows, bound) of the rows, the same ones in every run."""
    if rows <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int((1 << 30) * bound / rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


class _Powers:
    """Powers of an odd number and of its inverse mod 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(0xD1342543DE82EF95), _Powers(0xA0761D6478BD642F)


def _sums(values: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down[:-1], out=total[1:])
    return total, up


class Block:
    """Words of some documents. doc[i] is the document of word i, first[d] the first word of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE):
        self.data, self.offsets, self.n_docs = data, offsets, len(offsets) - 1
        gap = space[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        self.gap = gap
        self.starts = np.flatnonzero(~gap & (before | cut[:-1]))
        self.ends = np.flatnonzero(~gap & (after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.n_words = np.diff(self.first)
        self._bytes = self._hash = self._words = None

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.n_words)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each byte span; equal bytes give equal hashes."""
        if self._bytes is None:
            self._bytes = _sums(_BYTE[self.data], _BYTES)
        total, up = self._bytes
        return mix((total[ends] - total[starts]) * up[starts] + (ends - starts).astype(np.uint64) * _ODD)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.spans(self.starts, self.ends)
        return self._hash

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of n words in one document, and a hash of each run."""
        at = np.arange(max(0, len(self.starts) - n + 1))
        if len(at):
            doc = self.doc
            at = at[doc[: len(at)] == doc[n - 1 :]]
        return at, self.runs(at, at + n)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each run of words; equal words give equal hashes, whatever stands between them."""
        if self._words is None:
            self._words = _sums(self.hash, _WORDS)
        total, up = self._words
        return mix((total[ends] - total[starts]) * up[starts])

    def per_doc(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sums of values between consecutive bounds."""
        total = np.concatenate(([0], np.cumsum(values)))
        return np.diff(total[bounds])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, space: np.ndarray = _SPACE, lower: np.ndarray | None = None, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first row, end row, block) over a text column, in blocks of about so many bytes."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        part = data[offsets[row] : offsets[end]]
        yield row, end, Block(part if lower is None else lower[part], offsets[row : end + 1] - offsets[row], space)
        row = end


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about so many bytes of a text column, a row at least."""
    offsets = text_bytes(batch.column(column))[1]
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def lists(rows: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """A list column of n rows; rows, which must be in order, tells each value's row."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
