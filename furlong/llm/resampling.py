"""Quality by importance resampling: how likely a text is under a model of wanted text against one of all text.

Both models are bags of words and word pairs hashed to BUCKETS bins. A document's log weight is the mean log ratio of its
grams times UNIT (so that long documents do not win by length); with Gumbel noise added, the k highest keys are a
sample without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Block, blocks, mix, sampled, saved

BUCKETS, UNIT, SHARE = 1 << 14, 100.0, 0.75
TARGET_ROWS = 20_000  # bound of the sample of labelled documents that the target model is made of
_SCALE, _STEPS = 1 << 30, (24, 10, 0)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _bins(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all words and word pairs, and the documents they are in."""
    at, pair = block.grams(2)
    doc = block.doc
    return (np.concatenate((block.hash, mix(pair + np.uint64(1)))) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate((doc, doc[at]))


def model(texts: DataFrame) -> np.ndarray:
    """Log probability of each bin over the texts (column `text`), smoothed by one."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, block in blocks(batch.column(0), lower=_LOWER):
                total += np.bincount(_bins(block)[0], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], names=["bin", "n"])

    out = np.ones(BUCKETS)
    for r in texts.mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] += r["n"]
    return np.log(out / out.sum())


def weights(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """`doc_id`, `n_grams`, `log_weight`; null and empty texts have no grams and weight 0."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS doubles

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, block in blocks(batch.column(1), lower=_LOWER):
                bins, doc = _bins(block)
                n.append(np.bincount(doc, minlength=block.n_docs))
                total.append(np.bincount(doc, shared.value[bins], minlength=block.n_docs))
            n, total = np.concatenate(n), np.concatenate(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(UNIT * total / np.maximum(n, 1))], names=["doc_id", "n_grams", "log_weight"])

    return docs.select("doc_id", F.col(text)).mapInArrow(work, "doc_id long, n_grams long, log_weight double")


def kth_largest(keyed: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, found by counting ever narrower ranges; none if k is out of range."""
    low, left, part = None, k, keyed
    for step in _STEPS:
        seen = part.groupBy(F.shiftright(column, step).alias("range")).count().orderBy(F.desc("range")).collect()
        for r in seen:
            if left <= r["count"]:
                low = r["range"]
                break
            left -= r["count"]
        else:
            return None
        part = part.where(F.shiftright(column, step) == low)
    return low


def resample(docs: DataFrame, target: DataFrame, share: float = SHARE, text: str = "text", seed: int = 7) -> DataFrame:
    """`doc_id`, `n_grams`, `log_weight`, `key` and `kept`: true for the ceil(share * rows) highest keys.

    target holds the wanted texts (column `text`). The noise hangs on the id alone, so runs agree; rows that share the
    last kept key (repeated rows) are kept all. Keys are fixed-point, 2^-30 apart.
    """
    ratio = model(target.select("text")) - model(docs.select(F.col(text).alias("text")))
    uniform = (F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed)).bitwiseAND((1 << 52) - 1) + F.lit(0.5)) / float(1 << 52)
    noise = -F.log(-F.log(uniform))
    keyed = saved(weights(docs, ratio, text).withColumn("fixed", F.round((F.col("log_weight") + noise) * _SCALE).cast("long")))
    cut = kth_largest(keyed, "fixed", max(1, math.ceil(share * keyed.count())))
    return keyed.select("doc_id", "n_grams", "log_weight", (F.col("fixed") / _SCALE).alias("key"), (F.col("fixed") >= F.lit(cut)).alias("kept"))


def labelled(docs: DataFrame, labels: DataFrame, wanted: str, bound: int = TARGET_ROWS) -> DataFrame:
    """`doc_id`, `text`, `label` of a sample of about `bound` labelled documents at most.

    The sample's ids are few, so they are sent to the documents and no text is shuffled. Of several labels of one id the
    highest counts; null labels do not.
    """
    known = labels.where(F.col(wanted).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(wanted).alias("label"))
    known = sampled(known, bound, labels.count(), "doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
