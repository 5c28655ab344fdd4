"""Centroid clustering of vectors by Orchard's search.

Every centroid has the list of all centroids by their distance from it. A vector's search walks the list of its closest
centroid so far; a closer one (or an equally close one of a smaller number) takes over with its own list, and centroids
that were measured are marked. What stands strictly beyond twice the vector's current distance is farther from the vector
than its centroid is, so the walk ends there. Components are integers: distances, ties and sums are exact, and rounds give
the same centroids in whatever order rows come.

A round is one scan that sends each task's sums, one row a centroid; only centroids and their sums meet on the driver, and
their number is a parameter of at most MOST.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.shared import table, written
from atelier.llm.vectors import by_length, finite, whole

#: Centroids at most: their neighbour lists have as many entries as its square.
MOST = 4096


class Orchard:
    """Neighbour lists of the centroids, and the search of them for many vectors at once. measured counts distances."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids, self.measured = centroids, 0
        k = len(centroids)
        self.near, self.gap = np.empty((k, k), np.int64), np.empty((k, k), np.int64)
        for i in range(k):
            gaps = ((centroids - centroids[i]) ** 2).sum(1)
            self.near[i] = np.lexsort((np.arange(k), gaps))
            self.gap[i] = gaps[self.near[i]]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The closest centroid of each row (of equally close ones the smallest number), and its squared distance."""
        n, k = len(x), len(self.centroids)
        best, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        distance = ((x - self.centroids[0]) ** 2).sum(1)
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        self.measured += n
        live = np.arange(n)
        while len(live):
            live = live[place[live] < k]
            live = live[self.gap[best[live], place[live]] <= 4 * distance[live]]
            other = self.near[best[live], place[live]]
            place[live] += 1
            new = ~marked[live, other]
            row, other = live[new], other[new]
            marked[row, other] = True
            self.measured += len(row)
            d = ((x[row] - self.centroids[other]) ** 2).sum(1)
            closer = (d < distance[row]) | (d == distance[row]) & (other < best[row])
            row = row[closer]
            best[row], distance[row], place[row] = other[closer], d[closer], 0
        return best, distance


def _sums(vectors: DataFrame, centroids: np.ndarray, scale: int, most: int) -> dict[int, tuple[int, list[int]]]:
    """Of each centroid that has vectors, their number and componentwise sums."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Orchard(centroids)
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, x in by_length(batch.column("embedding")):
                v = whole(x, scale, most)
                best, _ = index.nearest(v)
                n += np.bincount(best, minlength=len(n))
                np.add.at(sums, best, v)
        there = np.flatnonzero(n)
        offsets = pa.array(np.arange(len(there) + 1, dtype=np.int32) * dim)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[there]), pa.ListArray.from_arrays(offsets, pa.array(sums[there].ravel()))], names=["cluster", "n", "sums"])

    parts = vectors.select("embedding").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n"), *[F.sum(F.col("sums")[i]) for i in range(dim)])
    return {r[0]: (r[1], list(r[2:])) for r in total.collect()}


def clustered(vectors: DataFrame, *, k: int = 16, dim: int = 64, scale: int = 64, rounds: int = 3, seed: str = "1:") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each vector of `dim` finite components.

    Components count as floor(scale * x), and beyond a bound that keeps squares in 64 bits (2^26 for 64 of them) as that bound.
    Rows whose vector is null, of another length, or holds null or non-finite components are left out. Centroids
    start as the k vectors of the least sha256 of seed and vec_id (of equal ones, the lesser vector; fewer vectors make fewer
    centroids; rows without vec_id start none). Repeated rows count as often as they stand. Inertia beyond 64 bits is null.
    An empty table gives no rows. Other columns are left out.
    """
    if k > MOST:
        raise ValueError(f"at most {MOST} centroids")
    spark, most = vectors.sparkSession, isqrt((1 << 62) // (16 * dim))
    kept = vectors.select(F.col("vec_id").cast("long"), "embedding").where((F.size("embedding") == dim) & finite())
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = kept.where("vec_id is not null").select(order.alias("at"), "embedding").orderBy("at", "embedding").limit(k).collect()
    centroids = whole(np.array([r.embedding for r in first], float).reshape(-1, dim), scale, most)
    kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], kind)
    for _ in range(rounds):
        for c, (n, sums) in _sums(kept, centroids, scale, most).items():
            centroids[c] = [s // n for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Orchard(centroids)
        for batch in batches:
            for rows, x in by_length(batch.column("embedding")):
                best, distance = index.nearest(whole(x, scale, most))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = written(kept.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    own = {r[0]: int(r[1]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    per = spark.createDataFrame([(c, fits(x), fits(sum(own.values())), digest(c)) for c, x in own.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    parts = [
        """pts AS MATERIALIZED (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)),
c0 AS MATERIALIZED (SELECT k, i, x FROM pts JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM pts)) USING (vec_id) WHERE k < 16)"""
    ]
    for r in range(4):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, k, d FROM (
  SELECT vec_id, k, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM pts p JOIN c{r} c USING (i) GROUP BY vec_id, k)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)""")
        if r < 3:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, i, (s - ((s % n) + n) % n) // n AS x FROM (
  SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM pts JOIN a{r} USING (vec_id) GROUP BY k, i)
  UNION ALL SELECT k, i, x FROM c{r} WHERE k NOT IN (SELECT k FROM a{r}))""")
    return "WITH " + ",\n".join(parts) + """
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a3 JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c3 GROUP BY k) USING (k)
"""


QUERIES = {"op11_centroid_clustering": op11_centroid_clustering}
ORACLE = {"op11_centroid_clustering": _oracle()}
