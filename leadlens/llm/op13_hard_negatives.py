"""Hard negatives by a secondary-sort shuffle over packed keys.

Anchors are a stated set of the rows.  An anchor's positives are its
``n_positive`` other rows of its label with the highest integer inner product;
the negatives of a positive are the first ``n_negative`` rows of another label,
by descending score, whose score lies in the positive's window ``low`` to
``high`` percent.

Vectors become whole numbers in the tasks, so that scores are exact.  Anchors
are taken in blocks of a bounded size, which are sent to all tasks; each task
goes through its rows once a block and keeps, as a map-side combine, only what
can matter: of each anchor the best ``n_positive`` positives, and in a second
pass of each of its windows the best ``n_negative`` negatives.  So a task emits
a fixed number of pairs an anchor, however many rows tie or repeat, and no pair
that any window could take is lost.

The pairs that are left are packed into keys of bytes that sort as (anchor,
descending score, positives first, id).  ``repartitionAndSortWithinPartitions``
deals them out by anchor and sorts them within Spark's shuffle; a streaming
iterator then opens a window at each of the first positives and emits
negatives into the windows that are open, without holding an anchor's rows.

Rows with a null id, a null label, a null vector, or a null or non-finite
component take no part.  Vectors of other lengths than the anchor's have no
score with it.  Equal scores go by the smaller id.  Rows that repeat id, label
and vector count once; rows that share an id but differ otherwise take part
each, but none of them is an "other row" of an anchor with that id.  Scores
beyond a long count as the largest long.  A positive with a score below zero
has an empty window.  An empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import materialized

#: Anchors of a block: their vectors (as doubles) hold so many bytes at most, and there are so many at most.
BLOCK_BYTES, BLOCK_ANCHORS = 16 << 20, 16_384
#: Scores that are held at once.
TILE = 1 << 21
#: Up to this, sums of products are exact in doubles.
EXACT = 2 ** 53

KEY = ">QIQBQ"  # anchor id, its number, descending score, 0 for positives, id
LONG = 1 << 63
PAIRS = "anchor_no int, anchor_id long, score long, negative boolean, vec_id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def pack(anchor_id: int, anchor_no: int, score: int, negative: bool, vec_id: int) -> bytes:
    return struct.pack(KEY, anchor_id + LONG, anchor_no, LONG - 1 - score, negative, vec_id + LONG)


def unpack(key: bytes) -> tuple[int, int, int, bool, int]:
    anchor_id, no, score, negative, vec_id = struct.unpack(KEY, key)
    return anchor_id - LONG, no, LONG - 1 - score, bool(negative), vec_id - LONG


def whole_rows(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """vec_id, label, vector of the rows that take part, each once."""
    v = F.col(vector_col).cast("array<double>")
    whole = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                        v.alias("vector")).where(
        "vec_id is not null and label is not null and vector is not null"
        " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    again = whole.groupBy("vec_id").count().where("count > 1").limit(1).count()
    return whole.dropDuplicates(["vec_id", "label", "vector"]) if again else whole


def integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(vectors * scale)


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles, as int64 (at its limits where they are beyond)."""
    bound = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if bound < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in anchors], object).reshape(anchors.shape)
    other = np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape)
    found = whole.dot(other.T)
    return np.clip(found, -LONG, LONG - 1).astype(np.int64)


def first_of(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` of each group, by descending score and then id."""
    order = np.lexsort((vec_id, ~score, group))
    g = group[order]
    start = np.maximum.accumulate(np.where(np.r_[True, g[1:] != g[:-1]], np.arange(len(g)), 0)) if len(g) else g
    return order[np.arange(len(g)) - start < n]


class Best:
    """The first ``n`` rows of each of many groups, as scores arrive tile by tile."""

    def __init__(self, n: int):
        self.n = n
        self.group, self.score, self.vec_id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, groups: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``scores[i, j]`` belongs to group ``groups[i]`` and row ``ids[j]`` where ``allowed``; ids ascend."""
        if not allowed.any():
            return
        if scores.shape[1] > self.n:
            # Above the n-th highest of the line, and of those equal to it as many as are left, by id.
            line = np.where(allowed, scores, -LONG)
            least = np.partition(line, scores.shape[1] - self.n, axis=1)[:, scores.shape[1] - self.n][:, None]
            above, equal = allowed & (scores > least), allowed & (scores == least)
            allowed = above | equal & (np.cumsum(equal, axis=1) <= self.n - above.sum(axis=1)[:, None])
        i, j = np.nonzero(allowed)
        group, score, vec_id = (np.concatenate(x) for x in (
            (self.group, groups[i]), (self.score, scores[i, j]), (self.vec_id, ids[j])))
        keep = first_of(group, score, vec_id, self.n)
        self.group, self.score, self.vec_id = group[keep], score[keep], vec_id[keep]


class Anchors:
    """A block of anchors: their numbers, ids, labels and, by length, vectors as whole numbers."""

    def __init__(self, rows: list, scale: float):
        self.no = np.array([r["anchor_no"] for r in rows], np.int64)
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        of: dict[int, list[int]] = {}
        for k, r in enumerate(rows):
            of.setdefault(len(r["vector"]), []).append(k)
        self.by_length = {n: (np.array(ks), integers(np.array([rows[k]["vector"] for k in ks], np.float64).reshape(len(ks), n), scale))
                          for n, ks in of.items()}


def tiles(batch: pa.RecordBatch, anchors: Anchors, scale: float) -> Iterator[tuple]:
    """(anchors' places in the block, rows' ids, same label, scores) in tiles of ``TILE`` scores; an anchor's own id is no row."""
    vec_id, label = (np.asarray(batch.column(k), dtype=np.int64) for k in (0, 1))
    vectors = batch.column(2)
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for n, (places, whole) in anchors.by_length.items():
        own = np.flatnonzero(sizes == n)
        own = own[np.argsort(vec_id[own], kind="stable")]
        if not len(own):
            continue
        rows = integers(flat[starts[own][:, None] + np.arange(n)].reshape(len(own), n), scale)
        for a in range(0, len(places), 1024):
            some = places[a:a + 1024]
            step = max(1, TILE // len(some))
            for r in range(0, len(own), step):
                ids, labels = vec_id[own[r:r + step]], label[own[r:r + step]]
                yield (some, ids, anchors.labels[some][:, None] == labels, anchors.ids[some][:, None] != ids,
                       scores_of(whole[a:a + 1024], rows[r:r + step]))


def pairs_of(best: Best, anchors: Anchors, places: np.ndarray, negative: bool) -> pa.RecordBatch:
    """Each pair of an anchor and a row once."""
    found = np.unique(np.stack([places, best.score, best.vec_id], 1), axis=0) if len(places) else np.zeros((0, 3), np.int64)
    at = found[:, 0]
    return pa.RecordBatch.from_arrays([
        pa.array(anchors.no[at], pa.int32()), pa.array(anchors.ids[at], pa.int64()), pa.array(found[:, 1], pa.int64()),
        pa.array(np.full(len(at), negative), pa.bool_()), pa.array(found[:, 2], pa.int64())],
        names=["anchor_no", "anchor_id", "score", "negative", "vec_id"])


def positive_pairs(rows: DataFrame, anchors, scale: float, n: int) -> DataFrame:
    """Of each task the best ``n`` positives of each anchor of the broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = anchors.value, Best(n)
        for batch in batches:
            for places, ids, same, other, scores in tiles(batch, block, scale):
                best.add(places, scores, same & other, ids)
        yield pairs_of(best, block, best.group, negative=False)

    return rows.mapInArrow(run, PAIRS)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The negative scores s with low * score <= 100 * s <= high * score: the first and the last."""
    return -(-low * score // 100), high * score // 100


def negative_pairs(rows: DataFrame, anchors, windows, scale: float, n: int) -> DataFrame:
    """Of each task the best ``n`` negatives of each window; ``windows``: lists of (place, window's number, first, last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = anchors.value, Best(n)
        own = windows.value
        for batch in batches:
            for places, ids, same, _, scores in tiles(batch, block, scale):
                negative = ~same
                for k, (first, last) in enumerate(zip(*own, strict=True)):
                    inside = negative & (scores >= first[places][:, None]) & (scores <= last[places][:, None])
                    best.add(places * len(own[0]) + k, scores, inside, ids)
        yield pairs_of(best, block, best.group // max(1, len(own[0])), negative=True)

    return rows.mapInArrow(run, PAIRS)


def secondary_sorted(pairs: DataFrame, parts: int):
    """An RDD of packed keys, all of an anchor in one partition, sorted."""
    keys = pairs.rdd.map(lambda r: (pack(r[1], r[0], r[2], r[3], r[4]), None))
    return keys.repartitionAndSortWithinPartitions(parts, lambda k: zlib.crc32(k[:12]))


def first_positives(pairs: DataFrame, n: int, parts: int) -> DataFrame:
    """The first ``n`` positives of each anchor over all tasks' own."""

    def run(keys: Iterator) -> Iterator[tuple]:
        anchor, taken = None, 0
        for key, _ in keys:
            if key[:12] != anchor:
                anchor, taken = key[:12], 0
            if taken < n:
                anchor_id, no, score, negative, vec_id = unpack(key)
                yield no, anchor_id, score, negative, vec_id
                taken += 1

    return pairs.sparkSession.createDataFrame(secondary_sorted(pairs, parts).mapPartitions(run), PAIRS)


def mined(pairs: DataFrame, n_positive: int, n_negative: int, low: int, high: int, parts: int) -> DataFrame:
    """Windows open at the first positives of an anchor as its sorted keys pass, and take negatives until they are full."""

    def run(keys: Iterator) -> Iterator[tuple]:
        anchor, opened, seen = None, [], 0
        for key, _ in keys:
            anchor_id, no, score, negative, vec_id = unpack(key)
            if (anchor_id, no) != anchor:
                anchor, opened, seen = (anchor_id, no), [], 0
            if not negative:
                if seen < n_positive:
                    first, last = window(score, low, high)
                    if first <= last:
                        opened.append([vec_id, score, first, last, 0])
                seen += 1
                continue
            opened = [w for w in opened if w[4] < n_negative and w[2] <= score]
            for w in opened:
                if score <= w[3]:
                    w[4] += 1
                    yield anchor_id, w[0], w[4], vec_id, w[1], score

    return pairs.sparkSession.createDataFrame(secondary_sorted(pairs, parts).mapPartitions(run), MINED)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", scale: float = 256.0, n_positive: int = 5, n_negative: int = 10,
                   low: int = 30, high: int = 90, block_anchors: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``.  Windows start at 0 percent or more and end below 100.
    """
    if not 0 <= low <= high < 100:
        raise ValueError("a window lies between 0 and 99 percent of the positive's score")
    spark = rows.sparkSession
    whole = materialized(whole_rows(rows, id_col, label_col, vector_col), "vectors")
    longest = whole.agg(F.max(F.size("vector"))).first()[0] or 0
    size = block_anchors or max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // max(8 * longest, 1)))
    # Blocks by hash: about ``size`` anchors each, whatever their ids are; numbers tell anchors apart within a block.
    chosen = whole.where(is_anchor)
    blocks = max(1, -(-chosen.count() // size))
    chosen = materialized(chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks))), "anchors")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for b in range(blocks):
        own = [r.asDict() | {"anchor_no": k} for k, r in enumerate(chosen.where(F.col("block") == b).collect())]
        if not own:
            continue
        block = spark.sparkContext.broadcast(Anchors(own, scale))
        positives = materialized(first_positives(positive_pairs(whole, block, scale, n_positive), n_positive, parts), "positives")
        scores: list[list[int]] = [[] for _ in own]
        for r in positives.select("anchor_no", "score").collect():
            scores[r[0]].append(r[1])
        spans = [[window(s[k], low, high) if k < len(s) else (1, 0) for s in scores] for k in range(n_positive)]
        edges = tuple(tuple(np.array([w[e] for w in ws], np.int64) for ws in spans) for e in (0, 1))
        negatives = negative_pairs(whole, block, spark.sparkContext.broadcast(edges), scale, n_negative)
        out = mined(positives.unionByName(negatives), n_positive, n_negative, low, high, parts)
        if blocks > 1:
            out = materialized(out, "negatives")
        found = out if found is None else found.unionByName(out)
    return found if found is not None else spark.createDataFrame([], MINED)
