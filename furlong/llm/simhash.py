"""SimHash near-duplicates found with vantage-point trees.

Equal fingerprints are folded first, so copies cost nothing. The distinct ones are dealt to shards by two trees, one per
32-bit half: the Hamming distance on a half is a metric, and two fingerprints that differ in at most three bits differ
in at most one bit on one of the halves. A node has a vantage point v and a bound mu: points with d(v, x) <= mu go
left, the others right. By the triangle inequality two points at distance 1 or less can part only if one lies on the
bound and the other just beyond it, so points with d(v, x) = mu are sent to both sides: the overlap of the shards.
(On all 64 bits with radius 3 a third of all points lie that close to the bound at every level; on a half, a seventh.)
Each shard goes on splitting the same way, and compares the fingerprints of its leaves over all 64 bits. Links are
joined to components by alternating star contraction in the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import blocks, saved

SEED, WORDS, RADIUS = 42, 3, 3
SAMPLE, SHARD, MAX_DEPTH, LEAF = 40_000, 4096, 14, 256
HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _fingerprints(block) -> np.ndarray:
    """Majority of the bits of the XXH64 of all shingles of each document."""
    gap, out = block.gap, np.zeros(block.n_docs, np.uint64)
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    place = np.cumsum(keep)
    joined = np.where(gap, np.uint8(32), block.data)[keep].tobytes()
    if not len(block.starts):
        return out
    starts, ends = place[block.starts] - 1, place[block.ends - 1]
    n, doc = block.n_words, block.doc
    index = np.arange(len(doc))
    short = n < WORDS
    heads = index[np.where(short[doc], index == block.first[doc], index + WORDS <= block.first[doc + 1])]
    tails = np.where(short[doc[heads]], block.first[doc[heads] + 1], heads + WORDS) - 1
    x = xxhash.xxh64_intdigest
    h = np.array([x(joined[a:b], SEED) for a, b in zip(starts[heads].tolist(), ends[tails].tolist(), strict=True)], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(n > 0)
    count = np.where(short, 1, n - WORDS + 1)[full]
    sums = np.add.reduceat(bits, np.concatenate(([0], np.cumsum(count)[:-1])), axis=0, dtype=np.uint32)
    out[full] = np.packbits(2 * sums > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id` and `fp`, the 64-bit fingerprint as a signed long. Null and empty texts have fingerprint zero."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_fingerprints(block) for _, _, block in blocks(batch.column(1), lower=_LOWER)]
            fp = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col(text)).mapInArrow(work, "doc_id long, fp long")


def _split(x: np.ndarray, half: np.uint64) -> tuple[np.uint64, int, np.ndarray] | None:
    """Vantage point, bound and distances of the evenest split of some tries; none if every split leaves a side nearly whole."""
    best = None
    for v in x[np.linspace(0, len(x) - 1, 8).astype(int)]:
        d = np.bitwise_count((x ^ v) & half)
        below = np.cumsum(np.bincount(d, minlength=34))
        left, right = below[:-1], len(x) - np.concatenate(([0], below[:-2]))
        worst = np.maximum(left, right)  # the bound itself is on both sides
        mu = int(np.argmin(worst))
        if best is None or worst[mu] < best[0]:
            best = worst[mu], v, mu, d
    return None if best[0] > 0.8 * len(x) else best[1:]


class Tree:
    """Vantage points and bounds by position in a heap; -1 for leaves. Built on a bounded sample; any points can be routed."""

    def __init__(self, sample: np.ndarray, half: np.uint64, depth: int):
        self.half, self.depth = half, depth
        self.v, self.mu = np.zeros(1 << (depth + 1), np.uint64), np.full(1 << (depth + 1), -1)
        todo = [(1, sample)]
        while todo:
            node, x = todo.pop()
            if node < 1 << depth and len(x) >= 8 and (found := _split(x, half)):
                self.v[node], self.mu[node], d = found
                todo += [(2 * node, x[d <= self.mu[node]]), (2 * node + 1, x[d >= self.mu[node]])]

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shard, point), once for every shard that the point lies in or at the border of."""
        node = np.ones(len(x), np.int64)
        for _ in range(self.depth):
            mu = self.mu[node]
            d = np.bitwise_count((x ^ self.v[node]) & self.half)
            inner = mu >= 0
            left, right = inner & (d <= mu), inner & (d >= mu)
            x = np.concatenate((x[~inner], x[left], x[right]))
            node = np.concatenate((node[~inner], 2 * node[left], 2 * node[right] + 1))
        return node, x


def _links(x: np.ndarray, half: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of the distinct points x, those that differ in at most one bit of the half among them."""
    todo = [x]
    while todo:
        x = todo.pop()
        if len(x) > LEAF and (found := _split(x, half)):
            _, mu, d = found
            todo += [x[d <= mu], x[d >= mu]]
            continue
        rest = x
        while len(rest) > 1:  # whoever is reached leaves the rest, so a dense group is gone soon
            root, front, rest = rest[0], [rest[0]], rest[1:]
            while front and len(rest):
                near = np.bitwise_count(rest ^ front.pop()) <= RADIUS
                if near.any():
                    hit, rest = rest[near], rest[~near]
                    front.extend(hit)
                    yield np.full(len(hit), root), hit


def links(distinct: DataFrame) -> DataFrame:
    """`a`, `b`: links between distinct fingerprints (column `fp`) that connect every pair within RADIUS bits."""
    n = distinct.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(n, 1) / SHARD)))))
    share = min(1.0, SAMPLE / max(n, 1))
    picked = distinct.where(F.pmod(F.xxhash64("fp", F.lit("tree")), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else distinct
    sample = np.array([r.fp for r in picked.select("fp").collect()], np.int64).view(np.uint64)
    trees = [Tree(np.sort(sample), half, depth) for half in HALVES]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for t, tree in enumerate(trees):
                shard, point = tree.route(x)
                yield pa.RecordBatch.from_arrays([pa.array(2 * shard + t), pa.array(point.view(np.int64))], names=["shard", "fp"])

    def match(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.unique(rows["fp"].to_numpy().view(np.uint64))
        np.random.default_rng(7).shuffle(x)
        found = list(_links(x, HALVES[int(key[0]) % 2]))
        a, b = (np.concatenate([f[i] for f in found]).view(np.int64) if found else np.zeros(0, np.int64) for i in (0, 1))
        return pd.DataFrame({"a": a, "b": b})

    dealt = distinct.select("fp").mapInArrow(route, "shard long, fp long")
    return dealt.groupBy("shard").applyInPandas(match, "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """`node`, `root`: the smallest node reachable, for every node of an edge (`a`, `b`) other than the roots themselves.

    Alternating large-star and small-star steps; every round is stored, so that no lineage builds up.
    """
    def lowest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("w"), F.first("u")).alias("low"))

    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w")).distinct())
    state = None
    while True:
        check = now.agg(F.count("*"), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first()
        if check[0] == 0 or check == state:
            return now.select(F.col("u").alias("node"), F.col("w").alias("root"))
        state = check
        both = now.union(now.select("w", "u"))
        large = both.join(lowest(both), "u").where("w > u").select(F.col("w").alias("u"), F.col("low").alias("w")).where("u <> w").distinct()
        down = large.groupBy("u").agg(F.min("w").alias("low"))
        small = large.join(down, "u")
        now = saved(small.select(F.explode(F.array(F.struct("w", "low"), F.struct(F.col("u").alias("w"), "low"))).alias("x"))
                    .select(F.col("x.w").alias("u"), F.col("x.low").alias("w")).where("u <> w").distinct())


def components(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `fp`, `component_id`: the smallest doc_id that is reachable over links of RADIUS bits or fewer.

    One row per row of docs. Null ids are carried along; a component of null ids only has a null component_id.
    """
    prints = saved(fingerprints(docs, text))
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    root = connected(links(distinct))
    member = distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(member.join(smallest, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
