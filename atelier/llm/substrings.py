"""Substring deduplication with a compressed FM-index per shard.

A window of WINDOW words belongs to its anchor, the least hash of its GRAM-word runs, and neighbouring windows of one
anchor make a stretch. Anchors of a single document are dropped. Equal stretches become one, with the least and
the greatest doc_id that hold it, and the stretches of an anchor meet in one shard. Its FM-index is built of those that a
document before the anchor's last holds; those that one after the anchor's first holds are streamed through it. Backward search
gives their matching statistics, and the rows of each match of WINDOW words the least document that holds it.
An anchor of more than MOST stretches is split into its windows, which are grouped by digest instead: partial aggregates keep
the least document of each, so neither a shard nor a task grows with a hot passage. Anchors and windows are chosen by content, so equal windows always meet: the result is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm import words as W
from atelier.llm.fmindex import FMIndex
from atelier.llm.shared import table, written

WINDOW = 50
GRAM = 12
#: Windows in a stretch, at most: a periodic text is cut.
STRETCH = 256
#: Distinct stretches of an anchor that are indexed together, at most; windows are the way beyond it.
MOST = 4096
#: Words in an index, about.
SHARD = 300_000


def _stretches(c: W.Chunk, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First windows (as word numbers), windows, anchors and content hashes of the stretches of a chunk."""
    at = np.flatnonzero(c.valid(window))
    if not len(at):
        return at, at, c.hashes[:0], c.hashes[:0]
    anchor = W.sliding_min(W.grams(c.hashes, gram), window - gram + 1)[at]
    whole = W.grams(c.hashes, window)[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    start = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
    start = np.flatnonzero(new | (within % STRETCH == 0))
    n = np.diff(np.append(start, len(at)))
    within = (np.arange(len(at)) - np.repeat(start, n)).astype(np.uint64)
    return at[start], n, anchor[start], W.mix(np.add.reduceat(W.mix(whole + within), start) + n.astype(np.uint64))


_STRETCH = "doc_id long, content long, anchor long, hash long, start int, n int"


def stretches(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row a stretch of each document that has an id; content is the text's 64-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), W.PLAIN):
                at, n, anchor, h = _stretches(c, window, gram)
                row = pa.array(c.row[at] + c.lo)
                start = (at - c.first[c.row[at]]).astype(np.int32)
                columns = [batch.column("doc_id").take(row), batch.column("content").take(row), W.signed(anchor), W.signed(h), pa.array(start), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "content", "anchor", "hash", "start", "n"])

    return _keyed(docs).where("doc_id is not null").mapInArrow(run, _STRETCH)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("content"), text.alias("text"))


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, content, packed): texts compressed, for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstd.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([packer.compress(x.as_buffer()) for x in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), packed], names=["doc_id", "content", "packed"])

    return _keyed(docs).mapInArrow(run, "doc_id long, content long, packed binary")


def _slices(docs: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """(anchor, hash, at, doc_id, indexed, asked, words): the text of each chosen stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstd.ZstdDecompressor()
        for batch in batches:
            for doc_id, packed, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("packed"), batch.column("wanted").to_pylist(), strict=True):
                words = unpacker.decompress(packed.as_buffer()).split()
                rows = [(w["anchor"], w["hash"], 0, doc_id, w["indexed"], w["asked"], b" ".join(words[w["start"] : w["start"] + w["n"] + window - 1]).decode()) for w in wanted]
                columns = list(zip(*rows, strict=True)) or [()] * 7
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["anchor", "hash", "at", "doc_id", "indexed", "asked", "words"])

    return _wanted(docs, chosen).mapInArrow(run, "anchor long, hash long, at int, doc_id long, indexed boolean, asked boolean, words string")


def _wanted(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, packed, wanted): the compressed texts that hold chosen stretches, and these."""
    per = chosen.groupBy("doc_id", "content").agg(F.collect_list(F.struct("anchor", "hash", "start", "n", "indexed", "asked")).alias("wanted"))
    return _packed(docs).join(per, ["doc_id", "content"]).dropDuplicates(["doc_id", "content"]).select("doc_id", "packed", "wanted")


def _windows(docs: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """(anchor, hash, at, doc_id, digest): each window of the chosen stretches, by a digest of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstd.ZstdDecompressor()
        for batch in batches:
            for doc_id, packed, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("packed"), batch.column("wanted").to_pylist(), strict=True):
                words = unpacker.decompress(packed.as_buffer()).split()
                rows = [
                    (w["anchor"], w["hash"], i, doc_id, hashlib.blake2b(b" ".join(words[w["start"] + i : w["start"] + i + window]), digest_size=16).digest())
                    for w in wanted
                    for i in range(w["n"])
                ]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["anchor", "hash", "at", "doc_id", "digest"])

    return _wanted(docs, chosen).mapInArrow(run, "anchor long, hash long, at int, doc_id long, digest binary")


def grouped(windows: DataFrame) -> DataFrame:
    """As searched(), a row a window, by grouping equal digests."""
    least = windows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    return windows.join(least, "digest").select("anchor", "hash", F.col("at").alias("lo"), (F.col("at") + 1).alias("hi"), "least")


_FOUND = "anchor long, hash long, lo int, hi int, least long"


def searched(slices: DataFrame, *, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """(anchor, hash, lo, hi, least): for windows lo to hi (exclusive) of a stretch, the least doc_id that holds them."""

    def search(table_: pa.Table) -> pa.RecordBatch:
        c = next(W.chunks(table_.column("words").combine_chunks(), W.PLAIN, limit=1 << 62))
        indexed, asked = (np.flatnonzero(table_.column(x).to_numpy()) for x in ("indexed", "asked"))
        n = c.n_words
        # words as symbols from 1, a separator after each indexed slice
        inside = np.zeros(len(n), bool)
        inside[indexed] = True
        known, symbol = np.unique(c.hashes[inside[c.row]], return_inverse=True)
        begin = np.cumsum(n[indexed] + 1) - n[indexed] - 1
        text = np.zeros(int((n[indexed] + 1).sum()), np.int64)
        text[np.arange(len(symbol)) + np.repeat(np.arange(len(indexed)), n[indexed])] = symbol + 1
        index = FMIndex(text, window)
        at = np.minimum(np.searchsorted(known, c.hashes), len(known) - 1)
        where, lo, hi = index.matching(np.where(known[at] == c.hashes, at + 1, 0), c.first[asked], c.first[asked + 1])
        # least document of each interval of rows
        doc = table_.column("doc_id").to_numpy()[indexed]
        interval, which = np.unique(lo, return_inverse=True)
        size = np.zeros(len(interval), np.int64)
        size[which] = hi - lo
        first = np.cumsum(size) - size
        places = index.locate(np.arange(int(size.sum())) + np.repeat(interval - first, size))
        by_row = doc[np.searchsorted(begin, places, "right") - 1]
        least = (np.minimum.reduceat(by_row, first) if len(first) else by_row)[which]
        order = np.argsort(where)
        where, least = where[order], least[order]
        row = c.row[where]
        cut = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (where[1:] != where[:-1] + 1))) if len(where) else where
        at = where - c.first[row] + table_.column("at").to_numpy()[row]
        end = np.append(cut[1:], len(where)) - 1 if len(where) else where
        own = pa.array(row[cut])
        columns = [table_.column("anchor").combine_chunks().take(own), table_.column("hash").combine_chunks().take(own), pa.array(at[cut].astype(np.int32)), pa.array((at[end] + 1).astype(np.int32)), pa.array(least[cut])]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "hash", "lo", "hi", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            kept.append(batch)
            size += batch.column("words").nbytes // 6
            while size >= shard:
                # whole anchors: up to the last change of anchor in what has been read, in shards of about `shard` words
                rows = pa.Table.from_batches(kept)
                anchor = rows.column("anchor").to_numpy()
                change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
                if not len(change):
                    break
                words = np.cumsum(pa.compute.binary_length(rows.column("words")).to_numpy()) // 6
                good = change[words[change - 1] <= shard]
                at = int(good[-1] if len(good) else change[0])
                yield search(rows.slice(0, at))
                rest = rows.slice(at)
                kept, size = rest.to_batches(), int(words[-1] - words[at - 1])
        if kept and sum(b.num_rows for b in kept):
            yield search(pa.Table.from_batches(kept))

    return slices.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _FOUND)


def repeats(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(doc_id, content, ranges): word ranges lo to hi (exclusive) of the windows that a document of smaller doc_id holds, too."""
    every = written(stretches(docs, window=window, gram=gram), "stretches")
    anchors = every.groupBy("anchor").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).where("_a < _b")
    shared = written(every.join(anchors, "anchor"), "shared")
    distinct = shared.groupBy("anchor", "hash").agg(F.min(F.struct("doc_id", "content", "start", "n")).alias("s"), F.max("doc_id").alias("last"), F.any_value("_a").alias("_a"), F.any_value("_b").alias("_b"))
    distinct = distinct.select("anchor", "hash", "s.*", (F.col("s.doc_id") < F.col("_b")).alias("indexed"), (F.col("last") > F.col("_a")).alias("asked"))
    heavy = distinct.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > most).select("anchor")
    heavy = written(heavy, "heavy")
    found = searched(_slices(docs, distinct.join(heavy, "anchor", "left_anti"), window), window=window)
    if not heavy.isEmpty():
        found = found.unionByName(grouped(written(_windows(docs, distinct.join(heavy, "anchor", "left_semi"), window), "windows")))
    mine = shared.join(found, ["anchor", "hash"]).where(F.col("least") < F.col("doc_id"))
    ranges = F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + window - 1).alias("hi"))
    return mine.groupBy("doc_id", "content").agg(F.array_sort(F.collect_set(ranges)).alias("ranges"))


def deduplicated(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, most: int = MOST, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) for each row of docs.

    Windows are judged on the texts as they are, not on what is left. Null texts have no words; rows without doc_id
    neither lose nor take words; rows that share a doc_id are one document to each other, and each loses
    its own words; an empty table gives an empty table. Other columns of docs are left out.
    """
    ranges = written(repeats(docs, window=window, gram=gram, most=most), "ranges")
    joined = _packed(docs).join(ranges, ["doc_id", "content"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstd.ZstdDecompressor()
        for batch in batches:
            n, lost, digests, texts = [], [], [], []
            for packed, ranges in zip(batch.column("packed"), batch.column("ranges").to_pylist(), strict=True):
                words = unpacker.decompress(packed.as_buffer()).split()
                kept, at = [], 0
                for r in ranges or ():
                    if r["lo"] > at:
                        kept += words[at : r["lo"]]
                    at = max(at, r["hi"])
                kept += words[at:]
                text = b" ".join(kept)
                n.append(len(words))
                lost.append(len(words) - len(kept))
                digests.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    texts.append(text.decode())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * with_text, names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)

    return joined.select("doc_id", "packed", "ranges").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"), with_text=False)


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLE = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, s, array_to_string(w[s : s + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
f AS (SELECT md5(g) AS h, min(doc_id) AS least FROM v GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM v JOIN f ON md5(g) = h WHERE least < doc_id),
k AS (SELECT d.doc_id, w, list(p) FILTER (p IS NOT NULL) AS gone FROM d LEFT JOIN r USING (doc_id) GROUP BY ALL)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(len(gone), 0)::bigint AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM k
"""
}
