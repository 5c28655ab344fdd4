"""A modified Kneser-Ney model of symbol n-grams, counted and estimated by Spark, stored in sorted hash arrays.

Symbols are code points (white space is one blank, digits are one digit), so an n-gram of ORDER reaches over word
ends, and the table has as many entries as the corpus has different n-grams: it grows with the corpus and has no fixed
size. Each language that occurs has a model of its own; keys hold the language, so one table serves them all.
Counts, continuation counts, discounts, probabilities and backoff weights are joins and aggregates by (language, n-gram).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm import words as W
from atelier.llm.shared import written

ORDER = 5
BEGIN = 2  # stands before a text, ORDER - 1 times

_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[:33] = 32
_FOLD[127] = 32
_FOLD[48:58] = 48
_C = np.random.default_rng(20250301).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Symbols:
    """A chunk's texts, each after ORDER - 1 marks of its beginning; at: where its own symbols stand; row: their rows."""

    padded: np.ndarray
    at: np.ndarray
    row: np.ndarray


def symbols(c: W.Chunk, order: int = ORDER) -> Symbols:
    lead = (c.data & 0xC0) != 0x80
    n = np.diff(np.append(0, np.cumsum(lead))[c.offsets])
    points = np.frombuffer(c.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != int(n.sum()):  # broken UTF-8: row by row
        texts = [c.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(c.offsets[:-1], c.offsets[1:], strict=True)]
        n = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(points)) + (row + 1) * (order - 1)
    padded = np.full(len(points) + len(n) * (order - 1), BEGIN, np.uint32)
    padded[at] = np.where(points < 128, _FOLD[points & 127], points)
    return Symbols(padded, at, row)


def salt(language: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(language.encode(), digest_size=8).digest(), "little"))


def keys(mixed: np.ndarray, at: np.ndarray, salts: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order, the keys of the n symbols that end at each place. mixed: W.mix of the symbols."""
    out, total = [], np.zeros(len(at), np.uint64)
    for j in range(order):
        total = total + mixed[at - j] * _C[j]
        out.append(total + salts * _C[32 + j])
    return out


def longest(mixed: np.ndarray, at: np.ndarray, salts: np.ndarray, order: int) -> np.ndarray:
    """The last of keys()."""
    total = salts * _C[31 + order]
    for j in range(order):
        total += mixed[at - j] * _C[j]
    return total


def mixed(points: np.ndarray) -> np.ndarray:
    return W.mix(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def salts(languages: list[str | None]) -> np.ndarray:
    known: dict[str, np.uint64] = {}
    return np.array([known[x] if x in known else known.setdefault(x, salt(x)) for x in ((v or "") for v in languages)], np.uint64)


def counts(docs: DataFrame, chosen, *, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each n-gram of `order` symbols ends in the rows of docs (lang, text) that chosen(chunk) marks.

    A task yields the counts of a megabyte at a time; Spark adds them up before and after the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column("lang")
            for c in W.chunks(batch.column("text"), W.PLAIN):
                s = symbols(c, order)
                own = np.flatnonzero(chosen(c)[s.row])
                if not len(own):
                    continue
                at, row = s.at[own], s.row[own] + c.lo
                # rows of one language share their keys; only the last order matters here
                key = longest(mixed(s.padded), at, salts(languages.to_pylist())[row], order)
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                window = np.ascontiguousarray(s.padded[at[first][:, None] + np.arange(1 - order, 1)])
                yield pa.RecordBatch.from_arrays([languages.take(pa.array(row[first])), pa.array(window.view(f"<U{order}").reshape(-1)), pa.array(n)], names=["lang", "gram", "n"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the counts of counts; 0.5, 1 and 1.5 where one of those is missing."""
    of = lambda i: F.sum((F.col("n") == i).cast("long")).alias(f"n{i}")
    c = level.groupBy("lang").agg(*(of(i) for i in (1, 2, 3, 4)), F.countDistinct(F.substr("gram", F.length("gram"))).alias("kinds"))
    n1, n2, n3, n4 = (F.col(f"n{i}") for i in (1, 2, 3, 4))
    whole = (n1 > 0) & (n2 > 0) & (n3 > 0) & (n4 > 0)
    y = n1 / (n1 + 2 * n2)
    d = lambda i, a, b, usual: F.when(whole, F.greatest(F.least(i - (i + 1) * y * b / a, F.lit(float(i))), F.lit(0.05))).otherwise(F.lit(usual))
    return c.select("lang", "kinds", d(1, n1, n2, 0.5).alias("d1"), d(2, n2, n3, 1.0).alias("d2"), d(3, n3, n4, 1.5).alias("d3"))


def estimate(counted: DataFrame, *, order: int = ORDER) -> DataFrame:
    """(kind, lang, gram, value): natural logs of probabilities (kind k: n-grams of k symbols; 0: an unseen symbol) and of backoff weights (kind -k: contexts of k - 1 symbols)."""
    levels = {order: written(counted, "ngrams")}
    for k in range(order - 1, 0, -1):
        shorter = levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        levels[k] = written(shorter, "ngrams")
    lower, found = None, []
    for k in range(1, order + 1):
        d = _discounts(levels[k])
        head = F.substring("gram", 1, k - 1)
        some = lambda i: F.sum((F.col("n") == i).cast("long") if i < 3 else (F.col("n") > 2).cast("long")).alias(f"m{i}")
        context = levels[k].groupBy("lang", head.alias("head")).agg(F.sum("n").alias("total"), some(1), some(2), some(3)).join(d, "lang")
        weight = (F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")
        context = written(context.select("lang", "head", "total", "kinds", "d1", "d2", "d3", weight.alias("weight")), "contexts")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        both = levels[k].withColumn("head", head).join(context, ["lang", "head"])
        if lower is None:
            below = F.col("weight") / (F.col("kinds") + 1)
            found.append(context.select(F.lit(0).alias("kind"), "lang", F.lit("").alias("gram"), F.log(below).alias("value")))
        else:
            both = both.withColumn("tail", F.substring("gram", 2, k - 1)).join(lower.withColumnRenamed("gram", "tail"), ["lang", "tail"])
            below = F.col("weight") * F.col("below")
            found.append(context.select(F.lit(-k).alias("kind"), "lang", F.col("head").alias("gram"), F.log("weight").alias("value")))
        lower = written(both.select("lang", "gram", ((F.col("n") - cut) / F.col("total") + below).alias("below")), "probabilities")
        found.append(lower.select(F.lit(k).alias("kind"), "lang", "gram", F.log("below").alias("value")))
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every


def hashed(estimated: DataFrame) -> DataFrame:
    """(kind, key, value), the keys being those of keys(); kind 0 has the key of its language alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            out = np.zeros(len(kind), np.uint64)
            own_salts = salts(batch.column("lang").to_pylist())
            grams = np.array(batch.column("gram").to_pylist(), dtype=str)
            width = np.where(kind > 0, kind, np.maximum(-kind - 1, 0))
            for k in np.unique(width).tolist():
                own = np.flatnonzero(width == k)
                if k:
                    points = np.ascontiguousarray(grams[own].astype(f"<U{k}")).view(np.uint32).reshape(len(own), k)
                    out[own] = longest(mixed(points.reshape(-1)), np.arange(len(own)) * k + k - 1, own_salts[own], k)
                else:
                    out[own] = own_salts[own]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), W.signed(out), batch.column("value")], names=["kind", "key", "value"])

    return estimated.select(F.col("kind").cast("int"), "lang", "gram", "value").mapInArrow(run, "kind int, key long, value double")


class Arrays:
    """Sorted keys with their values, and where each prefix of a key begins."""

    def __init__(self, key: np.ndarray, value: np.ndarray) -> None:
        order = np.argsort(key)
        self.keys, self.values = key[order], value[order].astype(np.float32)
        bits = max(1, len(key).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.keys = np.append(self.keys, np.full(1, ~np.uint64(0)))  # ends every search

    def find(self, key: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        at = self.starts[(key >> self.shift).astype(np.int64)].astype(np.int64)
        late = np.flatnonzero(self.keys[at] < key)
        while len(late):
            at[late] += 1
            late = late[self.keys[at[late]] < key[late]]
        return np.where((self.keys[at] == key) & (at < len(self.values)), at, -1)


class Model:
    """A whole table in memory, by kind."""

    def __init__(self, kind: np.ndarray, key: np.ndarray, value: np.ndarray, order: int) -> None:
        self.order = order
        self.kinds = {k: Arrays(key[kind == k], value[kind == k]) for k in range(-order, order + 1) if k != -1}

    def logs(self, s: Symbols, salts: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each symbol."""
        m, out = mixed(s.padded), np.zeros(len(s.at), np.float64)
        rest = np.arange(len(s.at))
        for k in range(self.order, 0, -1):
            found = self.kinds[k].find(longest(m, s.at[rest], salts[rest], k))
            seen = found >= 0
            out[rest[seen]] += self.kinds[k].values[found[seen]]
            rest = rest[~seen]
            if not len(rest):
                return out
            if k > 1:
                before = longest(m, s.at[rest] - 1, salts[rest], k - 1)
                found = self.kinds[-k].find(before)
                out[rest[found >= 0]] += self.kinds[-k].values[found[found >= 0]]
        found = self.kinds[0].find(salts[rest])
        out[rest] += np.where(found >= 0, self.kinds[0].values[found] if len(self.kinds[0].values) else 0, np.nan)
        return out


def loaded(table: DataFrame, *, order: int = ORDER) -> Model:
    """The table on the driver; the caller has checked its size."""
    rows = table.toArrow()
    return Model(rows.column("kind").to_numpy(), rows.column("key").to_numpy().view(np.uint64), rows.column("value").to_numpy(), order)


def joined(docs: DataFrame, table: DataFrame, *, row: str, order: int = ORDER) -> DataFrame:
    """(row, log): the sum of the symbols' logs for each row of docs (row, lang, text), for a table of any size.

    Each document's different windows, with how often they occur, are joined with the table from the longest n-gram down; those that an
    order knows leave, and the others take its backoff weight along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in W.chunks(batch.column("text"), W.PLAIN):
                s = symbols(c, order)
                own = salts(batch.column("lang").slice(c.lo, c.hi - c.lo).to_pylist())[s.row]
                m = mixed(s.padded)
                here, before = keys(m, s.at, own, order), keys(m, s.at - 1, own, order - 1) if len(s.at) else []
                _, first, n = np.unique(here[-1] + s.row.astype(np.uint64) * _C[63], return_index=True, return_counts=True)
                lists = [[x[first] for x in here], [own[first], *(x[first] for x in before)]] if len(first) else [[np.zeros(0, np.uint64)] * order] * 2
                offsets = pa.array(np.arange(len(first) + 1, dtype=np.int32) * order)
                columns = [pa.ListArray.from_arrays(offsets, W.signed(np.stack(x, 1).reshape(-1))) for x in lists]
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(s.row[first] + c.lo)), *columns, pa.array(n)], names=["row", "here", "before", "n"])

    rows = docs.select(F.col(row).alias("row"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    rest = rows.mapInArrow(run, "row long, here array<long>, before array<long>, n long").withColumn("log", F.lit(0.0))
    done = []
    of = lambda k: table.where(F.col("kind") == k).select("key", "value")
    for k in range(order, 0, -1):
        met = rest.withColumn("key", F.get("here", F.lit(k - 1))).join(of(k), "key", "left")
        met = written(met.drop("key"), "scored")
        done.append(met.where("value is not null").select("row", (F.col("n") * (F.col("log") + F.col("value"))).alias("log")))
        rest = met.where("value is null").drop("value")
        if k > 1:
            rest = rest.withColumn("key", F.get("before", F.lit(k - 1))).join(of(-k), "key", "left").withColumn("log", F.col("log") + F.coalesce("value", F.lit(0.0))).drop("key", "value")
    last = rest.withColumn("key", F.get("before", F.lit(0))).join(of(0), "key", "left")
    done.append(last.select("row", (F.col("n") * (F.col("log") + F.col("value"))).alias("log")))
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    return every.groupBy("row").agg(F.sum("log").alias("log"), F.count(F.when(F.col("log").isNull(), 1)).alias("unknown")).select(
        "row", F.when(F.col("unknown") == 0, F.col("log")).alias("log")
    )


