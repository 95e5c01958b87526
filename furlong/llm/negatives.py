"""Hard negatives mined with bounds along a spanning tree of the anchors.

A score is the inner product of two integer vectors. If q is an anchor whose score with a row x is known, or bounded,
then that of an anchor p at distance |p - q| lies within |p - q| |x| of it. So the anchors of a block are joined by their
minimum spanning tree, and a chunk of rows is taken down the tree, a level at a time: each anchor's scores are bounded
by its parent's and by |p| |x|, and only rows whose bounds overlap the anchor's window are scored. The window runs from
the lowest score that can still be among the first k to the highest allowed one, and narrows as rows come in.

Rows are packed into chunks once and stored. Anchors are dealt to blocks of about BLOCK by the nearest of some pivots,
which keeps edges short, chunks to groups of about GROUP rows; a task takes one group down one tree and returns at most k
rows per window, and these partial results are ranked together. So every anchor meets every row, in blocks, and neither
a block nor a group grows with the data.

A window is a range of scores on one side of the labels. First each anchor looks for its positives, the best rows of its
own label; each positive then opens a window for negatives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.common import saved

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
BLOCK, GROUP, CHUNK, PIVOTS = 1024, 8192, 1024, 256
SPARSE = 0.25  # share of a level's pairs up to which they are scored one by one
_LEAST = -(1 << 63)
_PACKED = "size int, dims int, first long, ids binary, labels binary, vectors binary"


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in the batch, ids, labels and integer vectors of the rows that take part: short vectors end in zeros."""
    ids, labels, vectors = batch.column(0), batch.column(1), batch.column(2)
    offsets = vectors.offsets.to_numpy()
    parts = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    size = np.diff(offsets)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(parts))))
    good = (bad[offsets[1:]] == bad[offsets[:-1]])
    for column in (ids, labels, vectors):
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(good)
    size, start = size[at], offsets[:-1][at]
    out = np.zeros((len(at), int(size.max(initial=0))))
    inside = np.arange(out.shape[1]) < size[:, None]
    out[inside] = np.floor(SCALE * parts[(start[:, None] + np.arange(out.shape[1]))[inside]])
    take = pa.array(at)
    number = lambda c: c.take(take).cast(pa.int64()).to_numpy(zero_copy_only=False)
    return at, number(ids), number(labels), out.astype(np.int64)


def _narrow(x: np.ndarray) -> bytes:
    """32-bit integers where all fit; the reader tells by the length."""
    fits = not x.size or (x.min() >= -(1 << 31) and x.max() < 1 << 31)
    return x.astype(np.int32 if fits else np.int64).tobytes()


def _wide(raw: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32 if len(raw) == 4 * rows * dims else np.int64).reshape(rows, dims).astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, ids, labels, vectors = _rows(batch)
        for a in range(0, len(ids), CHUNK):
            i, v = ids[a : a + CHUNK], vectors[a : a + CHUNK]
            columns = [[len(i)], [v.shape[1]], [int(i[0])], [i.tobytes()], [labels[a : a + CHUNK].tobytes()], [_narrow(v)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["size", "dims", "first", "ids", "labels", "vectors"])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, ids, labels, vectors = _rows(batch)
        raw = [x.tobytes() for x in vectors]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), pa.array(raw, pa.binary())], names=["vec_id", "label", "vector"])


def _stack(raws: list[bytes]) -> np.ndarray:
    dims = max((len(r) // 8 for r in raws), default=0)
    return np.stack([np.pad(np.frombuffer(r, np.int64), (0, dims - len(r) // 8)) for r in raws]) if raws else np.zeros((0, 0), np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, rounded up."""
    return np.sqrt((x.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: as doubles where no sum can leave their whole numbers, else as integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if _norms(a).max() * _norms(b).max() < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.concatenate([np.einsum("nd,nd->n", a[i[k : k + 65536]], b[j[k : k + 65536]]) for k in range(0, max(1, len(i)), 65536)])


class Tree:
    """Minimum spanning tree of some vectors, a level at a time: `levels` holds (nodes, parents, distances)."""

    def __init__(self, vectors: np.ndarray):
        n, x = len(vectors), vectors.astype(np.float64)
        parent, depth, near, edge = np.full(n, -1), np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
        from_, left, now = np.zeros(n, np.int64), np.ones(n, bool), 0
        for _ in range(n):
            left[now] = False
            if not left.any():
                break
            d = np.sqrt(((x - x[now]) ** 2).sum(1))
            closer = left & (d < near)
            near[closer], from_[closer] = d[closer], now
            now = int(np.argmin(np.where(left, near, np.inf)))
            parent[now], edge[now], depth[now] = from_[now], near[now] * (1 + 1e-9), depth[from_[now]] + 1
        self.levels = [(at, parent[at], edge[at]) for k in range(int(depth.max(initial=-1)) + 1) for at in [np.flatnonzero(depth == k)]]


class Search:
    """The first k rows of every window of every anchor of a block, over the chunks that it is shown."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.vectors, self.low, self.high, self.k, self.same = ids, labels, vectors, low, high, k, same
        self.tree, self.norm = Tree(vectors), _norms(vectors)
        self.best = np.zeros((4, 0), np.int64)  # anchor, window, score, id
        self.kth = low.copy()
        self.scored = 0

    def show(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        dims = max(vectors.shape[1], self.vectors.shape[1])
        a, x = (np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for v in (self.vectors, vectors))
        norm = _norms(x)
        exact = _norms(a).max() * norm.max(initial=0) < 1 << 62  # no score or bound can leave a long
        floor, roof = self.kth.min(1).astype(np.float64), self.high.max(1).astype(np.float64)
        asked = (labels == self.labels[:, None]) == self.same
        asked &= ids != self.ids[:, None]
        score, known = np.zeros((len(a), len(x)), np.int64), np.zeros((len(a), len(x)), bool)
        lo = -self.norm[:, None] * norm
        hi = -lo
        for nodes, parents, edge in self.tree.levels:
            if parents[0] >= 0:
                width = edge[:, None] * norm + 1e-6
                lo[nodes] = np.maximum(lo[nodes], lo[parents] - width)
                hi[nodes] = np.minimum(hi[nodes], hi[parents] + width)
            slack = 1e-9 * np.abs(hi[nodes]) + 1
            meets = asked[nodes] & (((hi[nodes] + slack >= floor[nodes, None]) & (lo[nodes] - slack <= roof[nodes, None])) | (not exact))
            self.scored += int(meets.sum())
            if meets.mean() > SPARSE:
                found = _products(a[nodes], x)
                i, j = np.nonzero(meets)
                value = found[i, j]
            else:
                i, j = np.nonzero(meets)
                value = _pairs(a[nodes], x, i, j)
            i = nodes[i]
            score[i, j], known[i, j] = value, True
            lo[i, j] = hi[i, j] = value
        self._keep(score, known, ids)

    def _keep(self, score: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        found = [self.best]
        for w in range(self.low.shape[1]):
            ok = known & (score >= self.kth[:, w, None]) & (score <= self.high[:, w, None])
            anchors = np.flatnonzero(ok.any(1))
            i, j = np.nonzero(ok[anchors])
            found.append(np.stack([anchors[i], np.full(len(i), w), score[anchors[i], j], ids[j]]))
        every = np.concatenate(found, axis=1)
        every = every[:, np.lexsort((every[3], -every[2], every[1], every[0]))]
        new = np.ones(every.shape[1], bool)
        new[1:] = (every[:, 1:] != every[:, :-1]).any(0)  # a row that repeats counts once
        every = every[:, new]
        slot = every[0] * self.low.shape[1] + every[1]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = place == self.k - 1
        self.kth[every[0][full], every[1][full]] = every[2][full]
        self.best = every[:, place < self.k]


def _meet(chunks: DataFrame, blocks: DataFrame, groups: int, k: int, same: bool) -> DataFrame:
    """Partial results of every group of chunks with every block: `block`, `anchor` (a place in it), `slot`, `id`, `score`, `anchor_id`."""

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        search = None
        if left.num_rows and right.num_rows:
            one = right.slice(0, 1).to_pylist()[0]
            ids, labels = (np.frombuffer(one[c], np.int64) for c in ("a_ids", "a_labels"))
            n = len(ids)
            low, high = (np.frombuffer(one[c], np.int64).reshape(n, -1) for c in ("low", "high"))
            search = Search(ids, labels, _wide(one["a_vectors"], n, one["a_dims"]), low, high, k, same)
            for row in range(left.num_rows):
                c = left.slice(row, 1).to_pylist()[0]
                search.show(np.frombuffer(c["ids"], np.int64), np.frombuffer(c["labels"], np.int64), _wide(c["vectors"], c["size"], c["dims"]))
        anchor, slot, score, found = search.best if search else np.zeros((4, 0), np.int64)
        columns = (np.full(len(anchor), key[0].as_py()), anchor, slot, found, score, ids[anchor] if search else anchor)
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["block", "anchor", "slot", "id", "score", "anchor_id"])

    dealt = chunks.withColumn("part", F.pmod(F.xxhash64("first", "ids"), F.lit(groups)))
    n = F.lit((blocks.agg(F.max("block")).first()[0] or 0) + 1)
    left = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    right = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(work, "block long, anchor long, slot long, id long, score long, anchor_id long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The partial results of each window ranked together; repeated rows count once."""
    order = Window.partitionBy("block", "anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).distinct()


def _dealt(anchors: DataFrame) -> DataFrame:
    """Anchors with their block: those nearest to one pivot, in several blocks if there are many."""
    total = anchors.count()
    if total <= BLOCK:
        return anchors.withColumn("block", F.lit(0).cast("long"))
    some = anchors.where(F.pmod(F.xxhash64("vec_id", F.lit("pivot")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * PIVOTS / total)))
    pivots = _stack([bytes(r.vector) for r in some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, -(-total // BLOCK))).collect()]).astype(np.float64)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _stack(batch.column(2).to_pylist()).astype(np.float64)
            dims = max(x.shape[1], pivots.shape[1])
            p, x = (np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for v in (pivots, x))
            pivot = np.argmin((p**2).sum(1) - 2 * x @ p.T, axis=1) if len(p) else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot, pa.int64())], names=["vec_id", "label", "vector", "pivot"])

    routed = saved(anchors.mapInArrow(near, "vec_id long, label long, vector binary, pivot long"))
    # At most PIVOTS rows: how many blocks a pivot needs, and the number of its first one.
    size = {r["pivot"]: -(-r["count"] // BLOCK) for r in routed.groupBy("pivot").count().collect()}
    first = dict(zip(sorted(size), np.cumsum([0, *(size[p] for p in sorted(size))]).tolist(), strict=False))
    by = F.create_map(*(F.lit(v) for p in sorted(size) for v in (p, f"{first[p]} {size[p]}")))
    place = F.split(by[F.col("pivot")], " ")
    return routed.withColumn("block", place[0].cast("long") + F.pmod(F.xxhash64("vec_id"), place[1].cast("long"))).drop("pivot")


_BLOCKS = "block long, a_ids binary, a_labels binary, a_vectors binary, a_dims int, low binary, high binary"


def _blocks(dealt: DataFrame) -> DataFrame:
    """One row per block: its anchors by id, each with one open window."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        vectors = _stack(rows.column("vector").to_pylist())
        order = np.lexsort((*vectors.T[::-1], labels, ids))
        ids, labels, vectors = ids[order].astype(np.int64), labels[order].astype(np.int64), vectors[order]
        one = [key[0].as_py(), ids.tobytes(), labels.tobytes(), _narrow(vectors), vectors.shape[1], np.full(len(ids), _LEAST).tobytes(), np.full(len(ids), -_LEAST - 1).tobytes()]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(one, kinds, strict=True)], names=["block", "a_ids", "a_labels", "a_vectors", "a_dims", "low", "high"])

    return dealt.groupBy("block").applyInArrow(work, _BLOCKS)


def _windows(blocks: DataFrame, positives: DataFrame, low: int, high: int) -> DataFrame:
    """The blocks with a window for every positive; an anchor with fewer has empty windows for the rest."""
    listed = positives.groupBy("block").agg(F.collect_list(F.struct("anchor", "rank", "score")).alias("positives"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["a_ids"]) // 8
                lo, hi = np.full((n, POSITIVES), -_LEAST - 1), np.full((n, POSITIVES), _LEAST)  # no score lies between
                for p in row["positives"]:
                    least, most = -(-low * p["score"] // 100), high * p["score"] // 100
                    if least <= most:
                        lo[p["anchor"], p["rank"] - 1], hi[p["anchor"], p["rank"] - 1] = least, most
                row |= {"low": lo.tobytes(), "high": hi.tobytes()}
                del row["positives"]
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([batch.schema.field(c) for c in row]))

    return blocks.join(listed, "block").mapInArrow(work, _BLOCKS)


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", low: int = LOW, high: int = HIGH) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    Components are floor(256 x). An anchor's positives are the first 5 other rows of its label; for each, the first 10 rows of another
    label are returned whose score is between low and high percent of the positive's. Higher scores come first, ties by
    smaller id. Rows with a null id, label, vector or component, or one that is not finite, take no part. Vectors of
    different sizes are scored as if the shorter ended in zeros; scores must fit a long. Rows that repeat id, label and
    vector count once; an anchor's other rows are those of other ids. Empty tables give no rows.
    """
    given = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), is_anchor.alias("is_anchor"))
    chunks = saved(given.select("vec_id", "label", "vector").mapInArrow(_pack, _PACKED))
    anchors = saved(given.where("is_anchor").select("vec_id", "label", "vector").mapInArrow(_single, "vec_id long, label long, vector binary").distinct())
    blocks = saved(_blocks(_dealt(anchors)))
    total = chunks.agg(F.sum("size")).first()[0] or 0
    groups = max(1, math.ceil(total / GROUP))
    positives = saved(_first(_meet(chunks, blocks, groups, POSITIVES, True), POSITIVES))
    negatives = _first(_meet(chunks, saved(_windows(blocks, positives, low, high)), groups, NEGATIVES, False), NEGATIVES)
    asked = positives.select("block", "anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = negatives.join(asked, ["block", "anchor", "slot"])
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

