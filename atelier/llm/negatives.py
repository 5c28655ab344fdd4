"""Hard negatives of anchors, by a secondary-sort shuffle.

Anchors (the stated query set) meet all rows in the cells of a grid: a cell has a bounded block of anchors and a share of the
rows, streams the rows past the anchors, and holds no more than the best few of each anchor. The first pass over
the grid finds the positives, the second what each cell can add to the windows that these open: of a window's first negatives over
all rows, each is among the first of its cell, so nothing is lost. What remains is packed into keys of (anchor, descending score, id),
dealt by anchor and sorted on the way by repartitionAndSortWithinPartitions; an iterator over the sorted keys opens a
window at each positive and emits negatives as they come, and holds only windows that are open.

Pairs are as many as anchors times rows, and are never stored: a cell's output is bounded by its anchors.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.shared import partitions, table, written
from atelier.llm.vectors import by_length, finite, whole

#: Anchors of a cell at most: their vectors, in doubles, are what a task holds.
BLOCK = 16_384
#: Rows and anchors whose scores are a matrix at a time
TILE = 1_024
#: Integer components beyond it count as it: products of 64 of them, a hundred times, fit in 64 bits.
LIMIT = 1 << 24


class Best:
    """The first `most` of each group by descending score, then id, over what add() has been given."""

    def __init__(self, groups: int, most: int) -> None:
        self.most, self.parts, self.waiting = most, [np.empty((0, 3), np.int64)], 0
        self.least = np.full(groups, -(1 << 62), np.int64)  # a group's worst score, once it is full

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(group):
            self.parts.append(np.stack([group, score, ids], 1))
            self.waiting += len(group)
            if self.waiting > 500_000:
                self.rows()

    def rows(self) -> np.ndarray:
        x = np.concatenate(self.parts)
        x = x[np.lexsort((x[:, 2], -x[:, 1], x[:, 0]))]
        x = x[np.append(True, (x[1:] != x[:-1]).any(1))] if len(x) else x  # repeated rows
        start = np.flatnonzero(np.append(True, x[1:, 0] != x[:-1, 0])) if len(x) else np.empty(0, np.int64)
        rank = np.arange(len(x)) - np.repeat(start, np.diff(np.append(start, len(x))))
        full = x[rank == self.most - 1]
        self.least[full[:, 0]] = full[:, 1]
        x = x[rank < self.most]
        self.parts, self.waiting = [x], 0
        return x


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integers: by doubles where these hold them all."""
    if not a.size or not b.size or int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Cell:
    """A block of anchors of one length; windows (score bounds, inclusive) are columns of lo and hi."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, alike: bool, most: int) -> None:
        self.ids, self.label, self.x, self.lo, self.hi, self.alike = ids, label, x, lo, hi, alike
        self.best = Best(lo.size, most)

    def feed(self, ids: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
        windows = self.lo.shape[1]
        for a in range(0, len(self.ids), TILE):
            cut = slice(a, a + TILE)
            for b in range(0, len(ids), TILE):
                few = slice(b, b + TILE)
                score = _scores(self.x[cut], x[few])
                same = self.label[cut, None] == label[None, few]
                fit = same & (self.ids[cut, None] != ids[None, few]) if self.alike else ~same
                for w in range(windows):
                    worst = self.best.least[np.arange(a, min(a + TILE, len(self.ids))) * windows + w]
                    i, j = np.nonzero(fit & (score >= np.maximum(self.lo[cut, w], worst)[:, None]) & (score <= self.hi[cut, w][:, None]))
                    self.best.add((a + i) * windows + w, score[i, j], ids[b + j])

    def found(self) -> Iterator[pa.RecordBatch]:
        x = self.best.rows()
        own = np.stack([self.ids[x[:, 0] // self.lo.shape[1]], x[:, 1], x[:, 2]], 1)
        own = np.unique(own, axis=0)  # a row is in several windows
        for at in range(0, len(own), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in own[at : at + 10_000].T.copy()], names=["anchor_id", "score", "vec_id"])


def _best(rows: DataFrame, anchors: DataFrame, *, alike: bool, most: int, low: int = 0, high: int = 0) -> DataFrame:
    """(anchor_id, score, vec_id): in each cell, the first `most` rows of each window of each anchor.

    rows: vec_id, label, x, share; anchors: vec_id, label, x, block, and scores, the positives' (with `alike`, none: one window has all).
    """
    n = partitions(rows.sparkSession)
    blocks = anchors.agg(F.coalesce(F.max("block") + 1, F.lit(0))).head()[0]
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    if not blocks:
        return rows.sparkSession.createDataFrame([], "anchor_id long, score long, vec_id long")
    left = anchors.select(every(n).alias("share"), "block", F.lit(0).alias("side"), "vec_id", "label", "x", "scores")
    right = rows.select((F.col("share") % n).cast("int").alias("share"), every(blocks).alias("block"), F.lit(1).alias("side"), "vec_id", "label", "x", F.array().cast("array<long>").alias("scores"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, cells = None, [], {}

        def opened() -> dict[int, Cell]:
            by: dict[int, list] = {}
            for b in waiting:
                lo, hi = _windows(b.column("scores").to_pylist(), low, high)
                for at, x in by_length(b.column("x")):
                    by.setdefault(x.shape[1], []).append((b.column("vec_id").to_numpy()[at], b.column("label").to_numpy()[at], x.astype(np.int64), lo[at], hi[at]))
            return {d: Cell(*map(np.concatenate, zip(*parts, strict=True)), alike, most) for d, parts in by.items()}

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("share", "block", "side")], 1)
            edges = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(key)], strict=True):
                part, (share, block, side) = batch.slice(lo, hi - lo), key[lo].tolist()
                if (share, block) != cell:
                    for c in cells.values():
                        yield from c.found()
                    cell, waiting, cells = (share, block), [], {}
                if side == 0:
                    waiting.append(part)
                    continue
                if waiting:
                    cells, waiting = opened(), []
                for at, x in by_length(part.column("x")):
                    if x.shape[1] in cells:
                        cells[x.shape[1]].feed(part.column("vec_id").to_numpy()[at], part.column("label").to_numpy()[at], x.astype(np.int64))
        for c in cells.values():
            yield from c.found()

    dealt = left.unionByName(right).repartition(max(n, n * blocks // 8), "share", "block").sortWithinPartitions("share", "block", "side")
    return dealt.mapInArrow(run, "anchor_id long, score long, vec_id long")


def _windows(scores: list[list[int]], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each row's windows, low to high hundredths of the scores; one without bounds where no row has a score. A missing window has none that fits."""
    n = max(map(len, scores), default=0)
    if not n:
        return np.full((len(scores), 1), -(1 << 62)), np.full((len(scores), 1), 1 << 62)
    lo, hi = np.ones((len(scores), n), np.int64), np.zeros((len(scores), n), np.int64)
    for i, row in enumerate(scores):
        lo[i, : len(row)], hi[i, : len(row)] = [-(-low * s // 100) for s in row], [high * s // 100 for s in row]
    return lo, hi


#: Packed keys: big-endian, the sign bits flipped, so that bytes sort as (anchor, -score, id).
_KEY = struct.Struct(">QQQ")
_HALF = 1 << 63


def packed(anchor: int, score: int, vec_id: int) -> bytes:
    return _KEY.pack(anchor + _HALF, _HALF - score, vec_id + _HALF)


def unpacked(key: bytes) -> tuple[int, int, int]:
    a, s, v = _KEY.unpack(key)
    return a - _HALF, _HALF - s, v - _HALF


def _dealt(key: bytes) -> int:
    """A hash of the key's anchor."""
    return int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 >> 24 & 0xFFFFFFFF


def emitted(rows: Iterator[tuple[bytes, bool]], *, low: int, high: int, most: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive's score, negative's score) from sorted keys and whether they are positives.

    A window takes the negatives whose score is low to high hundredths of its positive's. It holds those of the positive's own score
    that stand before it, too, of which `most` at most are kept meanwhile.
    """
    anchor, level, tied, last, seen = None, None, [], None, set()
    windows: list[list[int]] = []  # positive, its score, negatives so far
    for key, positive in rows:
        if key != last:
            last, seen = key, set()
        if positive in seen:
            continue
        seen.add(positive)
        a, score, other = unpacked(key)
        if a != anchor:
            anchor, level, windows = a, None, []
        if score != level:
            level, tied = score, []
            windows = [w for w in windows if w[2] < most and low * w[1] <= 100 * score]
        if positive:
            windows.append([other, score, 0])
            news, against = windows[-1:], tied
        else:
            tied = [*tied, other][:most]
            news, against = windows, [other]
        for w in news:
            for negative in against:
                if w[2] < most and low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    yield anchor, w[0], w[2], negative, w[1], score


def mined(
    vectors: DataFrame, *, anchor: Column, label: Column, scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors' hard negatives.

    Components count as floor(scale * x), beyond 2^24 as that. Rows with a null label, vec_id or vector, or with null or non-finite
    components take no part, and rows meet only rows of as many components. Rows that repeat an anchor's vec_id aren't other
    rows, and one of them (the least label, then vector) is the anchor; rows of one vec_id and one score with an anchor count once. Scores
    come in descending order, ties by vec_id. An empty table gives no rows; other columns are left out.
    """
    spark = vectors.sparkSession
    valid = vectors.where(finite() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), "embedding").where("label is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in by_length(batch.column("embedding")):
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * x.shape[1])
                made = pa.ListArray.from_arrays(offsets, pa.array(whole(x, scale, LIMIT).ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), batch.column("label").take(pa.array(rows)), made], names=["vec_id", "label", "x"])

    rows = written(valid.mapInArrow(run, "vec_id long, label long, x array<int>").withColumn("share", F.monotonically_increasing_id() % 1_000_003), "rows")
    one = rows.where(anchor).groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("own")).select("vec_id", "own.*")
    # blocks of about BLOCK anchors, by hash; Poisson makes none much larger
    blocks = max(1, -(-one.count() // BLOCK))
    one = written(one.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "anchors")
    first = _best(rows, one.withColumn("scores", F.array().cast("array<long>")), alike=True, most=positives)
    # a cell's first ones meet: at most `positives` rows a cell and anchor
    top = F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("down"), "vec_id"))), 1, positives)
    chosen = written(first.groupBy("anchor_id").agg(top.alias("top")), "positives")
    windows = chosen.select(F.col("anchor_id").alias("vec_id"), F.transform("top.down", lambda d: -d).alias("scores"))
    seen = _best(rows, one.join(windows, "vec_id"), alike=False, most=negatives, low=low, high=high)
    marked = seen.select("anchor_id", "score", "vec_id", F.lit(False).alias("positive")).unionByName(
        chosen.select("anchor_id", F.explode("top").alias("t")).select("anchor_id", (-F.col("t.down")).alias("score"), F.col("t.vec_id").alias("vec_id"), F.lit(True).alias("positive"))
    )
    keyed = marked.rdd.map(lambda r: (packed(r[0], r[1], r[2]), r[3]))
    by_anchor = keyed.repartitionAndSortWithinPartitions(partitions(spark), _dealt)
    out = by_anchor.mapPartitions(lambda part: emitted(part, low=low, high=high, most=negatives))
    return spark.createDataFrame(out, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=label)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE = {
    "op13_hard_negatives": """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 5
"""
}
