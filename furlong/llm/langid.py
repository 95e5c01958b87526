"""Language ID with bit-sliced Bloom filters of character n-grams.

One table serves all languages: row r holds a bit per language, in as many words as they take, so the AND of a gram's rows is the set of languages
whose filter has the gram. The bits are counted per document and language and corrected for each filter's rate of
false positives; the highest corrected count decides.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.common import BLOCK_BYTES, mix, saved, text_bytes

GRAM, HASHES, ROW_BITS = 4, 3, 20
TRAIN_ROWS, LEAST_ROWS = 20_000, 1000  # labelled rows that the filters are filled from; of each language as many at least, or all it has
MAX_GRAMS = 1 << 16  # most frequent grams of a language, those of equal count all or none
MIN_COUNT, MIN_SHARE = 3, 0.1  # a gram belongs to a language if it is no rarer there than this share of its best rate
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)


@dataclass
class Filters:
    languages: list[str]
    table: np.ndarray  # words of bits x rows
    false_rate: np.ndarray

    @classmethod
    def of(cls, grams: dict[str, np.ndarray]) -> Filters:
        kind = next((t for t in (np.uint8, np.uint16, np.uint32) if len(grams) <= np.iinfo(t).bits), np.uint64)
        bits = np.iinfo(kind).bits
        table = np.zeros((max(1, -(-len(grams) // bits)), 1 << ROW_BITS), kind)
        for i, codes in enumerate(grams.values()):
            for rows in _rows(codes):
                table[i // bits, rows] |= kind(1 << i % bits)
        full = np.array([np.mean(table[i // bits] >> kind(i % bits) & kind(1)) for i in range(len(grams))])
        return cls(list(grams), table, full**HASHES)

    def counts(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Corrected number of known grams by document and language."""
        first, *rest = _rows(codes)
        n, out = np.diff(bounds), np.zeros((len(bounds) - 1, len(self.languages)))
        bits = np.iinfo(self.table.dtype).bits
        for i, rate in enumerate(self.false_rate):
            if i % bits == 0:
                word = self.table[i // bits]
                sets = word[first]
                for rows in rest:
                    sets &= word[rows]
            seen = np.concatenate(([0], np.cumsum(sets >> sets.dtype.type(i % bits) & sets.dtype.type(1), dtype=np.int64)))
            out[:, i] = np.maximum(0, (np.diff(seen[bounds]) - n * rate) / max(1e-9, 1 - rate))
        return out


def _rows(codes: np.ndarray) -> list[np.ndarray]:
    h = mix(codes.astype(np.uint64) + np.uint64(1))
    return [(h >> np.uint64(ROW_BITS * i) & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64) for i in range(HASHES)]


def _grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the GRAM-byte runs of the folded texts with a space at either end, and each text's bounds in them.

    Letters are lower-cased, all other ASCII is a space; runs with two spaces in a row are left out, so none spans two texts.
    """
    data, offsets = text_bytes(pc.utf8_lower(column.fill_null("")))
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        at = offsets[row : end + 1] - offsets[row]
        x = np.full(at[-1] + 2 * (end - row), 32, np.uint32)
        x[np.arange(at[-1]) + np.repeat(2 * np.arange(end - row) + 1, np.diff(at))] = _FOLD[data[offsets[row] : offsets[end]]]
        code = x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:] if len(x) > 3 else np.zeros(0, np.uint32)
        gap = x == 32
        double = np.append(gap[:-1] & gap[1:], [False, False, False])
        keep = ~(double[: len(code)] | double[1 : len(code) + 1] | double[2 : len(code) + 2])
        place = np.concatenate(([0], np.cumsum(keep)))
        yield code[keep], place[np.minimum(at + 2 * np.arange(end - row + 1), len(code))]
        row = end


def _quota(rows: list[int]) -> int:
    """How many rows of a language may be taken: TRAIN_ROWS divided over the languages, what small ones leave going to the others."""
    left, quota = TRAIN_ROWS, TRAIN_ROWS
    for k, n in enumerate(sorted(rows)):
        quota = left // (len(rows) - k)
        if n > quota:
            break
        left -= n
    return max(LEAST_ROWS, quota)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from the texts with a language. Rows without either count for nothing; no rows give no languages."""
    labelled = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    size = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row per language
    number = {lang: i for i, lang in enumerate(sorted(size, key=lambda k: (-size[k], k)))}
    if not number:
        return Filters([], np.zeros((1, 1 << ROW_BITS), np.uint8), np.zeros(0))
    # Each language is sampled by itself, so that one does not shrink as the others grow; small ones are taken whole.
    quota, picked = _quota(list(size.values())), labelled
    large = {lang: int((1 << 30) * quota / n) for lang, n in size.items() if n > quota}
    if large:
        share = F.create_map(*(F.lit(x) for pair in large.items() for x in pair))
        picked = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.coalesce(F.element_at(share, F.col("lang")), F.lit(1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, row = np.array([number.get(x, -1) for x in batch.column(1).to_pylist()]), 0
            for codes, bounds in _grams(batch.column(0)):
                own = np.repeat(langs[row : row + len(bounds) - 1], np.diff(bounds))
                row += len(bounds) - 1
                pair, n = np.unique(own[own >= 0].astype(np.int64) << 32 | codes[own >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((pair >> 32).astype(np.int32)), pa.array(pair & 0xFFFFFFFF), pa.array(n)], names=["l", "gram", "n"])

    counted = saved(picked.mapInArrow(count, "l int, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n")))
    totals = counted.groupBy("l").agg(F.sum("n").alias("total"))  # a row per language
    kept = counted.join(F.broadcast(totals), "l").withColumn("rate", F.col("n") / F.col("total"))
    kept = kept.withColumn("best", F.max("rate").over(Window.partitionBy("gram")))
    kept = kept.where((F.col("n") >= MIN_COUNT) & (F.col("rate") >= MIN_SHARE * F.col("best"))).select("l", "gram", "n")
    # The least count that a language's grams need, from how many grams have each count, so that no task ranks a language.
    least, room = dict.fromkeys(number.values(), MIN_COUNT), dict.fromkeys(number.values(), MAX_GRAMS)
    for r in kept.groupBy("l", "n").agg(F.count("*").alias("k")).orderBy("l", F.desc("n")).toLocalIterator():
        room[r["l"]] -= r["k"]
        if room[r["l"]] < 0:
            least[r["l"]] = max(least[r["l"]], r["n"] + 1)
    floor = F.element_at(F.create_map(*(F.lit(x) for pair in least.items() for x in pair)), F.col("l"))
    grams = {i: array("Q") for i in number.values()}
    for r in kept.where(F.col("n") >= floor).select("l", "gram").orderBy("l", "gram").toLocalIterator():
        grams[r["l"]].append(r["gram"])
    return Filters.of({lang: np.array(grams[i], np.uint64) for lang, i in number.items()})


def predict(docs: DataFrame, filters: Filters, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, `lang_pred`, `score` and `known`.

    score is the winner's share of the two best corrected counts (0.5: a tie, 1: no other language knows a gram), known
    the share of the text's grams that the winner's filter has. A null text or one without a letter is `und` with score
    0. A text whose grams no language knows, and ties, go to the language with more training rows, with score 0.5.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)  # at most 8 MB for each 64 languages, whatever the data
    at = len(keep)
    schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)) + ", lang_pred string, score double, known double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = model.value
        for batch in batches:
            letter = pc.match_substring_regex(batch.column(at).fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
            best, score, known = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            row = 0
            for codes, bounds in _grams(batch.column(at)) if f.languages else ():
                counts, part = f.counts(codes, bounds), slice(row, row + len(bounds) - 1)
                row = part.stop
                best[part] = counts.argmax(1)
                top = np.sort(np.append(counts, np.zeros((len(counts), 1)), axis=1), axis=1)[:, -2:]
                score[part] = np.where(top[:, 1] > 0, top[:, 1] / np.maximum(top.sum(1), 1e-9), 0.5)
                known[part] = np.minimum(1, top[:, 1] / np.maximum(1, np.diff(bounds)))
            letter &= bool(f.languages)
            names = np.array([*f.languages, UNKNOWN], object)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(names[np.where(letter, best, len(f.languages))], pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(np.where(letter, known, 0.0))],
                names=[*(f"_{i}" for i in range(at)), "lang_pred", "score", "known"])

    chosen = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"))
    return chosen.mapInArrow(work, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score", "known")
