"""Near-duplicate documents by Order MinHash.

A document's runs of five words are labelled with their occurrence (the second "a b c d e" differs from the first) and
hashed; the top bits deal them to BINS sketches, and each sketch is the LENGTH smallest hashes in text order. Equal
sketches make candidates: equal texts are one node first, and in each bucket every node is paired with two or three heads, so
buckets give about as many pairs as rows, whatever their size. A pair is decided by banded alignment of its labelled runs:
runs that match in order, over all runs of both. Order and repeats count, as in an edit similarity; for texts without
repeated or moved passages it is the Jaccard similarity of their sets of runs, which it never exceeds by multiset.
Buckets that still hold more than one class get new heads from outside their largest class, until a turn finds no link or the
exact join that follows would make few pairs for each of its rows anyway.
Heads only make the classes large early. What they leave is settled exactly: all nodes of buckets that still hold more than one
class are joined by the rarest of their labelled runs (a prefix filter), so no link between members of a bucket is missed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm import words as W
from atelier.llm.components import components
from atelier.llm.shared import table, written

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches, a power of two: at a similarity of 0.8 a pair shares none with a chance of (1 - 0.8^4)^32, 5e-8.
BINS = 32
#: Hashes in a sketch
LENGTH = 4
#: Pairs that the exact join may make for each of its rows before new heads are worth a turn.
FEW = 64


def runs(c: W.Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of the runs of words in text order; a row of fewer words is one run."""
    at = np.flatnonzero(c.valid(size))
    h, row = W.grams(c.hashes, size)[at], c.row[at]
    n = c.n_words
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole = np.array([np.bitwise_xor.reduce(W.mix(c.hashes[c.first[r] : c.first[r + 1]] + np.arange(n[r], dtype=np.uint64))) for r in short.tolist()], np.uint64)
        where = np.searchsorted(row, short)
        h, row = np.insert(h, where, whole), np.insert(row, where, short)
    return h, row


def labelled(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The hashes with their occurrence in the row mixed in."""
    order = np.lexsort((h, row))
    sh, sr = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])
    start = np.flatnonzero(new)
    rank = np.empty(len(h), np.uint64)
    rank[order] = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    return W.mix(h + rank * np.uint64(0x9E3779B97F4A7C15))


def sketches(c: W.Chunk, *, size: int = SHINGLE, bins: int = BINS, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, bins and hashes of the sketches that are not empty."""
    h, row = runs(c, size)
    if not len(h):
        return row, row, h
    own = labelled(h, row)
    order = np.lexsort((own, row))
    group = row[order] * bins + (own[order] >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    chosen = order[rank < length]  # of each bin, the smallest
    group = group[rank < length]
    text = np.lexsort((chosen, group))  # in text order
    chosen, group = chosen[text], group[text]
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    place = (np.arange(len(chosen)) - np.repeat(start, np.diff(np.append(start, len(chosen))))).astype(np.uint64)
    made = W.mix(np.add.reduceat(W.mix(own[chosen] + place), start))
    return group[start] // bins, group[start] % bins, made


def signatures(docs: DataFrame, *, size: int = SHINGLE) -> DataFrame:
    """(doc_id, content, sketch): content is the text's MD5, sketch an array of BINS hashes, null where empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), W.PLAIN):
                row, of, h = sketches(c, size=size)
                grid, there = np.zeros((c.hi - c.lo) * BINS, np.int64), np.zeros((c.hi - c.lo) * BINS, bool)
                grid[row * BINS + of], there[row * BINS + of] = h.view(np.int64), True
                offsets = pa.array(np.arange(c.hi - c.lo + 1, dtype=np.int32) * BINS)
                cut = [batch.column(x).slice(c.lo, c.hi - c.lo) for x in ("doc_id", "content")]
                yield pa.RecordBatch.from_arrays([*cut, pa.ListArray.from_arrays(offsets, pa.array(grid, mask=~there))], names=["doc_id", "content", "sketch"])

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.md5(text).alias("content")).mapInArrow(run, "doc_id long, content string, sketch array<long>")


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> int:
    """Matches of the best alignment of two sequences without repeats, inside the band that a share of `least` leaves."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0
    need = least * (len(a) + len(b)) / (1 + least)  # matches of a pair that is alike enough
    inside = (ib - ia <= len(b) - need) & (ia - ib <= len(a) - need)
    ia, ib = ia[inside], ib[inside]
    ends: list[int] = []
    for x in ib[np.argsort(ia)].tolist():
        at = bisect_left(ends, x)
        if at == len(ends):
            ends.append(x)
        else:
            ends[at] = x
    return len(ends)


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned runs over all runs of two sequences of labelled runs; 0 where it must be below `least`."""
    if min(len(a), len(b)) < least * max(len(a), len(b)) or not len(a):
        return 0.0
    n = aligned(a, b, least)
    return n / (len(a) + len(b) - n)


def candidates(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, packed): the texts of the given nodes, compressed. Both sides are shuffled at every size: texts of a whole corpus follow no broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstd.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([packer.compress(x.as_buffer()) for x in batch.column("text")], pa.binary())], names=["doc_id", "packed"])

    text = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = nodes.select(F.col("node").alias("doc_id")).distinct()
    return written(text.mapInArrow(run, "doc_id long, packed binary").join(ids.hint("merge"), "doc_id", "left_semi"), "candidates")


def verified(pairs: DataFrame, texts: DataFrame, *, size: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) of doc_ids whose texts are alike enough."""
    side = lambda name, text: texts.select(F.col("doc_id").alias(name), F.col("packed").alias(text)).hint("merge")
    both = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b")

    def prepared(column: pa.Array, unpacker: zstd.ZstdDecompressor) -> Iterator[np.ndarray]:
        for at in range(0, len(column), 64):
            few = pa.array([unpacker.decompress(x.as_buffer()) for x in column.slice(at, 64)], pa.large_binary())
            for c in W.chunks(few, W.PLAIN):
                h, row = runs(c, size)
                own, edges = labelled(h, row), np.searchsorted(row, np.arange(c.hi - c.lo + 1))
                for r in range(c.hi - c.lo):
                    yield own[edges[r] : edges[r + 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstd.ZstdDecompressor()
        for batch in batches:
            found = np.array([similarity(x, y, least) for x, y in zip(prepared(batch.column("left"), unpacker), prepared(batch.column("right"), unpacker), strict=True)], float)
            keep = pa.array(found >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(found).filter(keep)], names=["a", "b", "similarity"])

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long, similarity double")


def _pairs(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b) of each bucket's members with its heads, where both are not in one class yet.

    Heads are the node that shares most buckets with others (a text that many copies were made from), the least one by
    hash and, at first, the least one; later, they are drawn from what lies outside the bucket's largest class.
    """
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")) if turn else members.withColumn("label", F.col("node"))
    candidates = named
    if turn:
        per = named.groupBy("bin", "hash", "label").agg(F.count("*").alias("n"))
        largest = per.groupBy("bin", "hash").agg(F.count("*").alias("classes"), F.max_by("label", F.struct("n", "label")).alias("main")).where("classes > 1").drop("classes")
        named = written(named.join(largest, ["bin", "hash"]), "open")
        candidates = named.where("label <> main")
    one = F.struct("node", "label")
    chosen = [F.max_by(one, F.struct("popular", -F.col("node"))), F.min_by(one, F.xxhash64("node", F.lit(turn)))] + [F.min(one)] * (not turn)
    heads = candidates.groupBy("bin", "hash").agg(F.array_distinct(F.array(*chosen)).alias("heads"))
    met = named.join(heads, ["bin", "hash"]).select("node", "label", "bins", F.explode("heads").alias("head")).where("label <> head.label")
    times = met.groupBy(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).agg(F.count("*").alias("times"), F.min("bins").alias("bins"))
    # alike texts share 13 of 32 buckets on average; fewer than an eighth are mostly chance, and left to _rest
    return times.where(F.col("times") * 8 >= F.col("bins")).select("a", "b")


def _shingles(texts: DataFrame, *, size: int) -> DataFrame:
    """(node, n, token): the labelled runs of each text, n of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstd.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                few = pa.array([unpacker.decompress(x.as_buffer()) for x in batch.column("packed").slice(at, 64)], pa.large_binary())
                node = batch.column("doc_id").slice(at, 64)
                for c in W.chunks(few, W.PLAIN):
                    h, row = runs(c, size)
                    h = labelled(h, row)
                    n = np.bincount(row, minlength=c.hi - c.lo)
                    yield pa.RecordBatch.from_arrays([node.take(pa.array(row + c.lo)), pa.array(n[row].astype(np.int32)), W.signed(h)], names=["node", "n", "token"])

    return texts.mapInArrow(run, "node long, n int, token long")


def _prefixes(members: DataFrame, labels: DataFrame, texts: DataFrame, *, size: int, least: float) -> DataFrame:
    """(node, n, behind, token): the rarest labelled runs of the nodes whose buckets hold several classes.

    An alignment that is long enough shares enough labelled runs, whatever their order. Sets that do share one of their
    n - ceil(least * n) + 1 rarest runs, and the first that they share leaves room for enough others behind it. Runs of one open
    node alone come first in the order, and only their number counts. Classes that grow later leave all this as it is.
    """
    named = members.select("bin", "hash", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = named.groupBy("bin", "hash").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select("bin", "hash")
    nodes = named.join(several, ["bin", "hash"], "left_semi").select(F.col("node").alias("doc_id")).distinct()
    tokens = _shingles(written(texts.join(nodes.hint("merge"), "doc_id", "left_semi"), "open"), size=size)
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    room = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1 - (F.col("n") - F.size("own"))  # places of the prefix that are left for shared shingles
    own = tokens.join(common, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"))
    prefix = own.withColumn("room", room.cast("int")).where("room > 0").select("node", "n", (F.col("n") - F.size("own")).alias("alone"), F.posexplode(F.slice("own", F.lit(1), F.col("room"))).alias("at", "x"))
    # behind: shingles from this one on
    return written(prefix.select("node", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("behind"), F.col("x.token").alias("token")), "prefixes")


def _shared(prefixes: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, main, meetings): tokens in several classes, the class that holds most of their nodes, and how many pairs joining them makes at most."""
    per = prefixes.join(labels, "node", "left").groupBy("token", F.coalesce("label", "node").alias("label")).agg(F.count("*").alias("k"))
    both = per.groupBy("token").agg(F.count("*").alias("classes"), F.sum("k").alias("all"), F.max(F.struct("k", "label")).alias("most")).where("classes > 1")
    return written(both.select("token", F.col("most.label").alias("main"), (F.col("all") * (F.col("all") - F.col("most.k"))).alias("meetings")), "shared")


def _rest(members: DataFrame, labels: DataFrame, texts: DataFrame, *, size: int, least: float, prefixes: DataFrame | None = None, shared: DataFrame | None = None) -> DataFrame:
    """(a, b): a superset of all links between classes that share a bucket; _prefixes() and _shared() of these labels are made where they aren't given."""
    if prefixes is None:
        prefixes = _prefixes(members, labels, texts, size=size, least=least)
    if shared is None:
        shared = _shared(prefixes, labels)
    open_ = prefixes.join(shared.drop("meetings"), "token").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    outside = open_.where("label <> main").select("token", F.col("node").alias("other"), F.col("label").alias("other_label"), F.col("n").alias("m"), F.col("behind").alias("other_behind"))
    enough = F.least("behind", "other_behind") >= F.lit(least / (1 + least)) * (F.col("n") + F.col("m")) - 1e-9
    met = open_.drop("main").join(outside, "token").where((F.col("label") != F.col("other_label")) & enough)
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def classes(docs: DataFrame, *, size: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for each row of docs; class_id is the least doc_id of the class.

    Documents are linked if the similarity() of their `size`-word runs is `least` or more (a text of fewer
    words is one run), and classes are the components. Rows of equal text always share a class (null counts as
    empty), also those without a word, which are linked to nothing else. A null doc_id gets the class of an equal
    text that has one, else null. Other columns of docs are left out.
    """
    signed = written(signatures(docs, size=size), "signatures")
    nodes = signed.groupBy("content").agg(F.min("doc_id").alias("node"), F.any_value("sketch").alias("sketch")).where("node is not null")
    bins = F.size(F.array_compact("sketch")).alias("bins")
    dealt = nodes.select("node", bins, F.posexplode("sketch").alias("bin", "hash")).where("hash is not null")
    sizes = dealt.groupBy("bin", "hash").agg(F.count("*").alias("n")).where("n > 1")
    crowded = written(dealt.join(sizes, ["bin", "hash"]), "crowded")
    popular = crowded.groupBy("node").agg(F.sum("n").alias("popular"))
    members = written(crowded.drop("n").join(popular, "node"), "members")
    texts = candidates(docs, members)
    turn, tried, links, prefixes = 0, None, None, None
    labels = docs.sparkSession.createDataFrame([], "node long, label long")
    while True:
        pairs = _pairs(members, labels, turn)
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = written(verified(pairs, texts, size=size, least=least), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        none = found.isEmpty()
        if not none:
            links = found if links is None else links.unionByName(found)
            labels = components(links)
        if prefixes is None:
            prefixes = _prefixes(members, labels, texts, size=size, least=least)
        shared = _shared(prefixes, labels)
        cost = shared.agg(F.sum("meetings")).first()[0] or 0
        # heads only spare the join pairs; it is exact without them
        if none or cost <= FEW * prefixes.count():
            break
        turn += 1
    pairs = written(_rest(members, labels, texts, size=size, least=least, prefixes=prefixes, shared=shared).join(tried, ["a", "b"], "left_anti"), "pairs")
    found = written(verified(pairs, texts, size=size, least=least), "links")
    if not found.isEmpty():
        labels = components(found if links is None else links.unionByName(found))
    # every row takes the class of its text
    rows = signed.groupBy("content").agg(F.min("doc_id").alias("node")).join(labels, "node", "left").select("content", F.coalesce("label", "node").alias("class_id"))
    return signed.select("doc_id", "content").join(rows, "content").select("doc_id", "class_id")


def deduplicated(docs: DataFrame, *, size: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """The rows of docs whose doc_id is the least of their class, with all columns; rows without doc_id stay. Rows that repeat a kept doc_id stay, too."""
    gone = classes(docs, size=size, least=least).where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


QUERIES = {"op6_near_duplicates": op6_near_duplicates}
ORACLE: dict[str, str] = {}
