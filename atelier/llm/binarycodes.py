"""Near-duplicate vectors of one label, by binary codes of a random rotation.

A unit vector is rotated into as many dimensions as the code has bits, and the code is the signs of its coordinates. With
the stored correction factor, the inner product of the vector and its own code, a code and a rotated other vector give an
unbiased estimate of the two vectors' cosine, whose error has a bound of known confidence: only pairs whose bound reaches the
threshold are computed anew from the vectors.

Candidates share a band of code bits. Bands have as many bits as make chance collisions rare among the vectors of the
largest label, and there are so many that a pair at the threshold shares none with a chance of MISS. Large groups of near
copies don't become pairs: vectors within half the threshold's angle of a leader form its ball, in which all are linked
by the triangle inequality. Balls meet as wholes: two are linked wholly, or not at all, or, in between, member by ball, and in
between again member by member. Counts and components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.components import components
from atelier.llm.shared import table, written
from atelier.llm.vectors import by_length, finite

COSINE = 0.93
#: Chance that a pair at the threshold shares no band
MISS = 1e-5
#: Standard errors of an estimate; beyond 4.5 lie 7 of a million.
ERRORS = 4.5
#: Radians that decisions by angle leave to rounding
MARGIN = 1e-7
#: Turns of choosing leaders; what is left then are balls of one.
TURNS = 3


@lru_cache(maxsize=4)
def rotation(dim: int, bits: int) -> np.ndarray:
    """bits x dim, of orthonormal columns; the same in every task."""
    return np.linalg.qr(np.random.default_rng(bits * 65_537 + dim).standard_normal((max(bits, dim), dim)))[0][:bits]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encoded(u: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs (as 0 and 1) of the rotated rows, and their correction factors."""
    y = u @ rotation(u.shape[1], bits).T
    return (y > 0).astype(np.uint8), np.abs(y).sum(1) / np.sqrt(bits)


def estimates(signs: np.ndarray, factor: np.ndarray, u: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of coded vectors with the vectors u, row by row, and the standard errors."""
    inner = np.einsum("ij,ij->i", 2.0 * signs - 1, u @ rotation(u.shape[1], bits).T)
    return inner / np.sqrt(bits) / factor, np.sqrt(np.maximum(0, 1 - factor**2)) / factor / np.sqrt(bits - 1)


def bands(most: int, least: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits in a band, bands) for labels of up to `most` vectors."""
    width = min(48, max(8, ceil(log2(max(2, most))) + 2))
    return width, ceil(log(miss) / log(1 - (1 - acos(least) / pi) ** width))


def _lists(column: pa.Array) -> np.ndarray:
    """Equally long arrays as a matrix."""
    o = column.offsets.to_numpy()
    return column.values.to_numpy()[o[0] : o[-1]].reshape(len(column), -1)


def _coded(found: DataFrame, width: int, n: int) -> DataFrame:
    """The distinct vectors as nodes with code and factor; code is packed bits."""
    bits = ceil(width * n / 64) * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in by_length(batch.column("vector")):
                signs, factor = encoded(unit(x), bits)
                code = pa.array([r.tobytes() for r in np.packbits(signs, axis=1)], pa.binary())
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*own.columns, code, pa.array(factor)], names=[*own.schema.names, "code", "factor"])

    kind = "node long, label long, dim int, content string, copies long, first long, vector array<double>, code binary, factor double"
    return written(found.mapInArrow(run, kind), "nodes")


def _banded(nodes: DataFrame, width: int, n: int) -> DataFrame:
    """(label, dim, bucket, node): n rows a node."""
    weights = 1 << np.arange(width, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                bits = np.unpackbits(np.stack([np.frombuffer(c.as_buffer(), np.uint8) for c in part.column("code")]), axis=1)
                bucket = (bits[:, : width * n].reshape(-1, n, width).astype(np.int64) @ weights) + (np.arange(n, dtype=np.int64) << 48)
                row = pa.array(np.repeat(np.arange(part.num_rows), n))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(row) for c in ("label", "dim")), pa.array(bucket.ravel()), part.column("node").take(row)], names=["label", "dim", "bucket", "node"])

    return nodes.select("label", "dim", "node", "code").mapInArrow(run, "label long, dim int, bucket long, node long")


def decided(pairs: DataFrame, nodes: DataFrame, *, bits: int, least: float) -> DataFrame:
    """(a, b, angle, all) of the pairs (a, b, reach) of nodes that may have vectors within `reach` of a and b, together, whose cosine is `least`.

    all: every such two have. With a reach of 0, that is the pair itself, by the cosine in double precision.
    """
    most = acos(least)
    side = lambda name, *cols: nodes.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in cols])

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keep = np.zeros(part.num_rows, bool)
                for rows, x in by_length(part.column("b_vector")):
                    own = part.take(pa.array(rows))
                    signs = np.unpackbits(np.stack([np.frombuffer(c.as_buffer(), np.uint8) for c in own.column("a_code")]), axis=1)
                    about, error = estimates(signs, own.column("a_factor").to_numpy(), unit(x), bits)
                    reach = own.column("reach").to_numpy()
                    keep[rows] = (reach + most >= pi) | (about + ERRORS * error >= np.cos(np.minimum(pi, most + reach)))
                yield part.select(["a", "b", "reach", "b_vector"]).filter(pa.array(keep))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in by_length(batch.column("b_vector")):
                own = batch.take(pa.array(rows))
                y = by_length(own.column("a_vector"))[0][1]
                cosine = np.einsum("ij,ij->i", unit(x), unit(y))
                angle, reach = np.arccos(np.clip(cosine, -1, 1)), own.column("reach").to_numpy()
                every = np.where(reach > 0, angle + reach <= most - MARGIN, cosine >= least)
                keep = pa.array(every | (reach > 0) & (angle - reach <= most + MARGIN))
                made = [own.column("a"), own.column("b"), pa.array(angle), pa.array(every)]
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in made], names=["a", "b", "angle", "all"])

    near = pairs.select("a", "b", F.col("reach").cast("double")).join(side("a", "code", "factor"), "a").join(side("b", "vector"), "b")
    kind = "a long, b long, reach double, b_vector array<double>"
    open_ = near.select("a", "b", "reach", "a_code", "a_factor", "b_vector").mapInArrow(estimated, kind)
    both = open_.join(side("a", "vector"), "a").select("a", "b", "reach", "a_vector", "b_vector")
    return both.mapInArrow(exact, "a long, b long, angle double, all boolean")


def _balls(nodes: DataFrame, banded: DataFrame, *, bits: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(node, ball, angle), ball being the node's leader, and the rows of buckets of several nodes.

    In each bucket the node of the highest priority is proposed to the others; a node that is near none of those
    proposed to it leads, and the others join the highest that they are near to, if it leads. The others try again among themselves.
    """
    within = float(np.cos(acos(least) / 2 - MARGIN))
    priority = lambda c, turn: F.xxhash64(c, F.lit(turn))
    key = ["label", "dim", "bucket"]
    shared, open_, joined = None, banded, None
    for turn in range(TURNS):
        heads = written(open_.groupBy(*key).agg(F.count("*").alias("n"), F.max_by("node", F.struct(priority("node", turn), "node")).alias("head")).where("n > 1").drop("n"), "heads")
        open_ = written(open_.join(heads, key), "buckets")
        shared = open_ if shared is None else shared
        offered = open_.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"), F.lit(0).alias("reach")).distinct()
        near = decided(offered, nodes, bits=bits, least=within).where("all")
        best = near.groupBy("a").agg(F.max_by(F.struct("b", "angle"), F.struct(priority("b", turn), "b")).alias("to"))
        best = written(best.select(F.col("a").alias("node"), F.col("to.b").alias("ball"), "to.angle"), "best")
        own = best.join(best.select(F.col("node").alias("ball")), "ball", "left_anti").select("node", "ball", "angle")
        own = written(own, "joined")
        joined = own if joined is None else joined.unionByName(own)
        left = written(best.join(own, "node", "left_anti").select("node"), "left")
        if left.isEmpty():
            break
        open_ = open_.drop("head").join(left, "node", "left_semi").select(*key, "node")
    balls = nodes.select("node").join(joined, "node", "left").select("node", F.coalesce("ball", "node").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle"))
    return written(balls, "balls"), shared


def linked(vectors: DataFrame, *, least: float = COSINE, miss: float = MISS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors.

    Rows of one label and as many components are linked if their cosine is `least` or more. Rows with a null
    label, vec_id or vector, with null or non-finite components, and zero vectors link with nothing; a null vec_id has no component.
    Rows that repeat a vector are other rows and count as links; with a repeated vec_id, each row has its own, and kept ones are kept
    each. A linked pair is missed with a chance of about `miss` at the threshold, and of less above it. An empty table gives no rows.
    Other columns are left out.
    """
    content = F.md5(F.col("embedding").cast("string").cast("binary"))
    fit = F.coalesce(finite() & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding", fit.alias("fit"))
    valid = rows.where("fit").withColumn("content", content)
    found = valid.groupBy("label", "content").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"), F.any_value("embedding").cast("array<double>").alias("vector"))
    found = written(found.select(F.monotonically_increasing_id().alias("node"), "label", F.size("vector").alias("dim"), "content", "copies", "first", "vector"), "vectors")
    width, n = bands(found.groupBy("label", "dim").count().agg(F.max("count")).head()[0] or 1, least, miss)
    bits = ceil(width * n / 64) * 64
    nodes = _coded(found, width, n)
    balls, shared = _balls(nodes, _banded(nodes, width, n), bits=bits, least=least)
    members = written(balls.join(nodes.select("node", "copies", "first"), "node"), "members")
    whole = written(members.groupBy("ball").agg(F.max("angle").alias("radius"), F.sum("copies").alias("weight"), F.min("first").alias("first")), "whole")

    # balls that share a bucket, once
    key = ["label", "dim", "bucket"]
    present = written(shared.select(*key, "node").join(balls.select("node", "ball"), "node").select(*key, "ball").distinct(), "present")
    met = present.withColumnRenamed("ball", "a").join(present.withColumnRenamed("ball", "b"), key).where("a < b").select("a", "b").distinct()
    size = lambda name: whole.select(F.col("ball").alias(name), F.col("radius").alias(f"{name}_radius"))
    level = lambda pairs, reach: pairs.select("a", "b", reach.alias("reach"))
    first = written(decided(level(met.join(size("a"), "a").join(size("b"), "b"), F.col("a_radius") + F.col("b_radius")), nodes, bits=bits, least=least), "first")
    # those in between: members of a with the ball of b, then members with members; a and b are nodes there, and a_ball and b_ball theirs
    of = lambda name, ball: members.select(F.col("node").alias(name), F.col("ball").alias(ball))
    second = level(first.where("not all").select(F.col("a").alias("a_ball"), "b").join(of("a", "a_ball"), "a_ball").join(size("b"), "b"), F.col("b_radius"))
    second = written(decided(second, nodes, bits=bits, least=least), "second")
    third = level(second.where("not all").select("a", F.col("b").alias("b_ball")).join(of("b", "b_ball"), "b_ball"), F.lit(0.0))
    third = written(decided(third, nodes, bits=bits, least=least), "third")

    weight, copies = whole.select(F.col("ball").alias("b"), "weight"), nodes.select(F.col("node").alias("b"), "copies")
    turned = lambda x: x.select(F.col("b").alias("a"), F.col("a").alias("b"))
    full, half = first.where("all").select("a", "b"), second.where("all").select("a", "b")
    sums = lambda parts, name: parts.groupBy(F.col("a").alias(name)).agg(F.sum("k").alias(f"{name}_links"))
    each = lambda pairs, other, k: pairs.join(other, "b").select("a", F.col(k).alias("k"))
    to_balls = sums(each(full.unionByName(turned(full)), weight, "weight").unionByName(each(turned(half), copies, "copies")), "ball")
    single = third.select("a", "b")
    to_nodes = sums(each(half, weight, "weight").unionByName(each(single.unionByName(turned(single)), copies, "copies")), "node")

    own = lambda name: members.select(F.col("node").alias(name), F.col("ball").alias(f"{name}_ball"))
    edges = full.unionByName(half.join(own("a"), "a").select(F.col("a_ball").alias("a"), "b")).unionByName(single.join(own("a"), "a").join(own("b"), "b").select(F.col("a_ball").alias("a"), F.col("b_ball").alias("b")))
    labels = components(written(edges.distinct(), "edges"))
    named = whole.join(labels.withColumnRenamed("node", "ball"), "ball", "left").withColumn("root", F.coalesce("label", "ball"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    per_ball = written(named.join(lowest, "root").join(to_balls, "ball", "left").select("ball", "component_id", (F.col("weight") - 1 + F.coalesce("ball_links", F.lit(0))).alias("k")), "per_ball")
    per_node = members.join(per_ball, "ball").join(to_nodes, "node", "left").select("node", "component_id", (F.col("k") + F.coalesce("node_links", F.lit(0))).alias("n_links"))
    per_text = written(nodes.select("node", "label", "content").join(per_node, "node").select("label", "content", "n_links", "component_id"), "per_vector")
    out = valid.select("vec_id", "label", "content").join(per_text, ["label", "content"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_embedding_near_dedup": op12_embedding_near_dedup}
ORACLE = {
    "op12_embedding_near_dedup": """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) ON a = vec_id
"""
}
