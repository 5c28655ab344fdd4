"""Benchmark decontamination by a prefix-filtered set join.

A window of an item occurs in a document only if all its shingles do (containment 1), so one shingle, the rarest over
all documents, is its necessary prefix; a window with a shingle that no document has can't occur. Documents give their
shingles that are some prefix, with the words around them; these join the prefixes, the prefix's place bounds where the
window lies, and every word of it is then compared. The benchmark may have any size: documents carry a sieve of 2^SIEVE bits,
and a table of windows is broadcast only if it has at most BROADCAST rows; beyond that it is shuffled by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm import words as W
from atelier.llm.shared import table, written

WINDOW = 10
SHINGLE = 3
#: Bits of the sieve, as a power of two: 8 MB.
SIEVE = 26
#: Rows of a table of windows (about 150 bytes each) that are broadcast, at most.
BROADCAST = 200_000


def windows(benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, window, n, keys): the distinct windows of each item, their words joined by a space, and the hashes of their shingles.

    An item of fewer than `window` words is one window; null and wordless items have none, nor have items without id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), W.FOLDED, lower=True):
                rows, texts, sizes, keys = [], [], [], []
                for r in range(c.hi - c.lo):
                    a, b = int(c.first[r]), int(c.first[r + 1])
                    words = [c.data[x:y].tobytes() for x, y in zip(c.starts[a:b], c.ends[a:b], strict=True)]
                    n = min(window, len(words))
                    width = min(shingle, n)
                    own = W.grams(c.hashes[a:b], width).view(np.int64) if n else []
                    found = {b" ".join(words[i : i + n]): own[i : i + n - width + 1] for i in range(len(words) - n + 1)} if n else {}
                    rows += [c.lo + r] * len(found)
                    texts += [x.decode("utf-8", "replace") for x in found]
                    sizes += [n] * len(found)
                    keys += found.values()
                columns = [batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "window", "n", "keys"])

    rows = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text")
    return rows.mapInArrow(cut, "item_id long, window string, n int, keys array<long>")


def sieve(keys: DataFrame) -> dict[int, np.ndarray]:
    """By width, which cells of 2^SIEVE the (width, key) fall into; its packed words are the rows that reach the driver, 2^(SIEVE - 6) a width at most."""
    cells = keys.select("width", F.shiftrightunsigned("key", 64 - SIEVE).alias("cell"))
    packed = cells.groupBy("width", F.shiftright("cell", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits"))
    rows = packed.toArrow()
    width, out = rows.column("width").to_numpy(), {}
    for s in np.unique(width).tolist():
        words = np.zeros(1 << SIEVE - 6, np.int64)
        words[rows.column("word").to_numpy()[width == s]] = rows.column("bits").to_numpy()[width == s]
        out[s] = words.view(np.uint64)
    return out


def _caught(c: W.Chunk, s: int, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a chunk's shingles of width s that fall into the sieve."""
    keys = W.grams(c.hashes, s)
    cell = keys >> np.uint64(64 - SIEVE)
    at = np.flatnonzero((cells[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool) & c.valid(s))
    return at, keys[at].view(np.int64)


def frequencies(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(width, key, n): how often each shingle occurs in all documents, in one scan; some that only fall into the sieve are among them."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve(keys))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), W.FOLDED, lower=True):
                for s, cells in shared.value.items():
                    key, n = np.unique(_caught(c, s, cells)[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), s, np.int32)), pa.array(key), pa.array(n)], names=["width", "key", "n"])

    return docs.select("text").mapInArrow(count, "width int, key long, n long").groupBy("width", "key").agg(F.sum("n").alias("n"))


def prefixes(docs: DataFrame, cut: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """(width, key, place, n, window): each window that may occur by its rarest shingle."""
    width = F.least("n", F.lit(shingle)).alias("width")
    distinct = cut.groupBy("window").agg(F.any_value("n").alias("n"), F.any_value("keys").alias("keys"))
    every = written(distinct.select("window", "n", width, F.posexplode("keys").alias("place", "key")), "shingles")
    counted = frequencies(docs, every).withColumnRenamed("n", "times")
    first = F.min(F.struct("times", "key", "place", "width", "n")).alias("x")
    met = every.join(counted, ["width", "key"], "left").groupBy("window").agg(first, F.count(F.when(F.col("times").isNull(), 1)).alias("missing"))
    return written(met.where("missing = 0").select("x.width", "x.key", "x.place", "x.n", "window"), "prefixes")


_NEAR = "array<struct<width: int, key: bigint, at: int, skip: int, words: string>>"


def candidates(docs: DataFrame, chosen: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(doc_id, _text, n_words, near): near has each shingle that may be a prefix: where it begins, and the words around it, `skip` of them before it."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve(chosen))
    kind = pa.list_(pa.struct([("width", pa.int32()), ("key", pa.int64()), ("at", pa.int32()), ("skip", pa.int32()), ("words", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), W.FOLDED, lower=True):
                near: list[list[dict]] = [[] for _ in range(c.hi - c.lo)]
                for s, cells in shared.value.items():
                    at, keys = _caught(c, s, cells)
                    row = c.row[at]
                    lo, hi = np.maximum(at - (window - s), c.first[row]), np.minimum(at + window, c.first[row + 1])
                    for i, key, r, a, b in zip(at.tolist(), keys.tolist(), row.tolist(), lo.tolist(), hi.tolist(), strict=True):
                        words = b" ".join(c.data[x:y].tobytes() for x, y in zip(c.starts[a:b].tolist(), c.ends[a:b].tolist(), strict=True))
                        near[r].append({"width": s, "key": key, "at": i - int(c.first[r]), "skip": i - a, "words": words.decode("utf-8", "replace")})
                cut = [batch.column(x).slice(c.lo, c.hi - c.lo) for x in ("doc_id", "_text")]
                yield pa.RecordBatch.from_arrays([*cut, pa.array(c.n_words, pa.int64()), pa.array(near, kind)], names=["doc_id", "_text", "n_words", "near"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("_text"), "text")
    return rows.mapInArrow(run, f"doc_id long, _text long, n_words long, near {_NEAR}")


def occurrences(found: DataFrame, chosen: DataFrame, *, broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, _text, begin, n, window) of each window that occurs; found: candidates(), chosen: prefixes()."""
    near = found.select("doc_id", "_text", F.explode("near").alias("x")).select("doc_id", "_text", "x.*")
    some = F.broadcast(chosen) if chosen.count() <= broadcast else chosen
    skip = F.col("skip") - F.col("place")  # words before the window
    words = F.slice(F.split("words", " "), F.greatest(skip, F.lit(0)) + 1, F.col("n"))
    met = near.join(some, ["width", "key"]).where((skip >= 0) & (F.array_join(words, " ") == F.col("window")))
    return met.select("doc_id", "_text", (F.col("at") - F.col("place")).alias("begin"), "n", "window")


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int, broadcast: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Windows of the items, candidates of the documents, and occurrences."""
    cut = written(windows(benchmark, window=window, shingle=shingle), "windows")
    chosen = prefixes(docs, cut, shingle=shingle)
    found = written(candidates(docs, chosen, window=window), "candidates")
    return cut, found, written(occurrences(found, chosen, broadcast=broadcast), "occurrences")


def clean(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE, broadcast: int = BROADCAST) -> DataFrame:
    """The rows of docs in which no window of an item occurs, with all their columns. Null and empty texts stay."""
    _, _, hit = _searched(docs, benchmark, window, shingle, broadcast)
    gone = hit.select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone["_d"]) & (F.xxhash64(docs["text"]) == gone["_t"])
    return docs.join(gone, same, "left_anti")


_SPANS = "array<struct<lo: bigint, hi: bigint>>"


def _merged(spans: DataFrame) -> DataFrame:
    """(_d, _t, spans) of rows with begins and ns: joined ranges of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for every in batch.column("every").to_pylist():
                lo, n = np.array([(x["begin"], x["n"]) for x in every], np.int64).T
                order = np.argsort(lo, kind="stable")
                lo, hi = lo[order], np.maximum.accumulate((lo + n)[order])
                first = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
                out.append([{"lo": a, "hi": b} for a, b in zip(lo[first].tolist(), hi[np.append(first[1:], len(lo)) - 1].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("_d"), batch.column("_t"), pa.array(out, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))], names=["_d", "_t", "spans"])

    return spans.mapInArrow(run, f"_d long, _t long, spans {_SPANS}")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE, broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, n_words, spans, items) for each row of docs: hit word ranges (end exclusive) and the ids of the items that occur.

    Null and empty texts have no words and no hits; repeated rows each get their result; a null doc_id stays null;
    an empty benchmark hits nothing. Other columns of docs are left out.
    """
    cut, found, hit = _searched(docs, benchmark, window, shingle, broadcast)
    hit = hit.withColumnsRenamed({"doc_id": "_d", "_text": "_t"})
    spans = _merged(hit.groupBy("_d", "_t").agg(F.collect_set(F.struct("begin", "n")).alias("every")))
    owners = cut.select("window", "item_id").distinct()
    owners = F.broadcast(owners) if cut.count() <= broadcast else owners
    items = hit.select("_d", "_t", "window").distinct().join(owners, "window").groupBy("_d", "_t").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    per = spans.join(items.withColumnsRenamed({"_d": "_d2", "_t": "_t2"}), F.col("_d").eqNullSafe(F.col("_d2")) & (F.col("_t") == F.col("_t2"))).select("_d", "_t", "spans", "items")
    both = found.select("doc_id", "_text", "n_words").join(per, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")), "left")
    return both.select("doc_id", "n_words", F.coalesce("spans", F.expr(f"cast(array() as {_SPANS})")).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<bigint>)")).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated")
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES = {"op4_benchmark_decontamination": op4_benchmark_decontamination}
ORACLE = {
    "op4_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k)),
m AS (SELECT doc_id, dw.k, s, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM m)) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
}
