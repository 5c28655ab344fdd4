"""Quality by compression: zstandard dictionaries of good and of bad text.

A text is compressed with dictionaries of either kind, a pair for each of a few dictionary sizes: small ones hold what all texts of
a kind share, large ones what some share. The differences of the sizes over the text's length go through a logistic
calibration, with the mean compressed share and the length beside them. Dictionaries are built from labelled
rows of folds 0 and 1, the calibration from fold 3, fold being crc32(doc_id as text) mod 4; fold 2 is never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atelier.llm import words as W
from atelier.llm.shared import table

#: Bounds of what is learnt from: rows a class for a dictionary (texts of at most TEXT_BYTES, SAMPLE_BYTES together), rows for the calibration.
SAMPLE_ROWS = 1500
TEXT_BYTES = 1 << 20
SAMPLE_BYTES = 1 << 26
CALIBRATION_ROWS = 4000
DICTIONARY_BYTES = (1 << 11, 1 << 13, 1 << 15)
LEVEL = 3
THRESHOLD = 0.7
HELD_OUT = 2


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or plain text where there are too few samples to train one."""
    try:
        return zstd.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except zstd.ZstdError:
        return b"\n".join(texts)[-size:]


def _compressor(data: bytes) -> zstd.ZstdCompressor:
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not data:
        return zstd.ZstdCompressor(level=LEVEL, **options)
    made = zstd.ZstdCompressionDict(data)
    made.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(dict_data=made, level=LEVEL, **options)


def sizes(docs: DataFrame, bad: list[bytes], good: list[bytes]) -> DataFrame:
    """(doc_id, n, bad_<i>, good_<i>): bytes of each whole text, and compressed with each dictionary."""
    names = [f"{kind}_{i}" for i in range(len(bad)) for kind in ("bad", "good")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = [_compressor(x) for pair in zip(bad, good, strict=True) for x in pair]
        for batch in batches:
            data, offsets = W.raw(batch.column("text"))
            view, edges = memoryview(data), offsets.tolist()
            texts = [view[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            counts = [pa.array(x, pa.int64()) for x in (np.diff(offsets), *([len(c.compress(t)) for t in texts] for c in by))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts], names=["doc_id", "n", *names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "n", *names)))


@dataclass
class Model:
    bad: list[bytes] = field(default_factory=list)
    good: list[bytes] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self) -> F.Column:
        """Probability that a row of sizes() is good; 0.5 if nothing was learnt."""
        return 1 / (1 + F.exp(-sum((F.lit(w) * x for w, x in zip(self.weights, features(len(self.bad)), strict=False)), F.lit(0.0))))


def features(pairs: int) -> list:
    """1, the normalised difference of each pair, the same by length, the middle pair's mean compressed share (and squared), and the log length."""
    n = F.greatest(F.col("n"), F.lit(1))
    log = F.log1p(n.cast("double"))
    d = [(F.col(f"bad_{i}") - F.col(f"good_{i}")) / n for i in range(pairs)]
    share = F.least((F.col(f"bad_{pairs // 2}") + F.col(f"good_{pairs // 2}")) / (2 * n), F.lit(2.0))
    return [F.lit(1.0), *d, *(x * log for x in d), share, share * share, log]


def logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 1e-3, steps: int = 40) -> list[float]:
    """Weights for the columns of x (the first all 1) by Newton's method on standardised columns."""
    mean, dev = x.mean(0), x.std(0) + 1e-9
    mean[0], dev[0] = 0, 1
    z, w = (x - mean) / dev, np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.eye(len(w)), z.T @ (y - p) - ridge * len(y) * w)
    w = w / dev
    w[0] -= (w[1:] * mean[1:]).sum()
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns labels.quality from at most 2 * SAMPLE_ROWS + CALIBRATION_ROWS rows, those of the smallest hash of doc_id, and 2 * SAMPLE_BYTES of text."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    known = known.withColumns({"fold": fold(), "turn": F.xxhash64("doc_id")}).where(F.col("fold") != HELD_OUT)
    first = lambda rows, n: rows.orderBy("turn", "doc_id").limit(n).select("doc_id", "quality")
    for_words = known.where(F.col("fold") != 3)
    ids = first(for_words.where("quality = 0"), SAMPLE_ROWS).unionByName(first(for_words.where("quality = 1"), SAMPLE_ROWS))
    texts = docs.select(F.col("doc_id").cast("long"), "text").where(F.octet_length("text").between(1, TEXT_BYTES)).join(F.broadcast(ids), "doc_id")
    turn = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    # the driver gets texts of SAMPLE_BYTES a class at most; a doc_id that repeats is bounded with the rest
    held = texts.withColumns({"_bytes": F.sum(F.octet_length("text").cast("long")).over(turn), "_n": F.row_number().over(turn)}).where((F.col("_bytes") <= SAMPLE_BYTES) & (F.col("_n") <= SAMPLE_ROWS))
    got = held.orderBy("quality", "_n").select("quality", "text").collect()
    bad, good = ([dictionary([r["text"].encode() for r in got if r["quality"] == q], size) for size in DICTIONARY_BYTES] for q in (0, 1))
    chosen = first(known.where("fold = 3"), CALIBRATION_ROWS)
    rows = sizes(docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"), bad, good).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("quality", *(x.alias(f"x{i}") for i, x in enumerate(features(len(bad))))).toPandas()
    y = rows.pop("quality").to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(bad, good, [])
    order = np.lexsort(rows.to_numpy().T)
    return Model(bad, good, logistic(rows.to_numpy()[order], y[order]))


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    Null texts count as empty; they and empty texts get the score of their sizes. A null doc_id is not held out. Repeated
    rows get equal scores; an empty table gives an empty table; with no labels of both kinds every score is 0.5.
    """
    scored = sizes(docs, model.bad, model.good).withColumn("score", model.score())
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op2_quality_classifier": op2_quality_classifier}
ORACLE: dict[str, str] = {}
