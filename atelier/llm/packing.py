"""Best-two-fit packing of token sequences.

Only lengths decide a packing, and there are at most `capacity` of them. So the plan is made on the
histogram of lengths (one row a length, whatever the corpus): fill a bin greedily with the longest piece
that fits, then replace its smallest piece by the two unpacked pieces that fit the widened gap most
tightly; use the bin's pattern as often as the counts allow, and go on. Pieces find their place by their
rank among those of equal length. Ranks come from salted windows and a table of counts, so a length that
a third of all pieces have is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atelier.llm import bpe
from atelier.llm.shared import partitions, table, written

END_ID = 2


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, *, capacity: int = 1024, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a document's ids and END_ID, cut into pieces of `capacity` ids.

    Only the first piece may be shorter. Null and empty texts are one piece, END_ID alone. A null doc_id stays
    null; repeated rows give repeated pieces. Other columns of docs are left out.
    """
    path = path or vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ids, offsets in bpe.token_ids(batch.column("text"), path):
                ids = ids.astype("<u4", copy=False)
                n = np.diff(offsets) + 1
                count = -(-n // capacity)
                row = np.repeat(np.arange(hi - lo), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = n - (count - 1) * capacity
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                own = [ids[offsets[r] + s : min(offsets[r] + s + k, offsets[r + 1])] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
                last = piece == count[row] - 1
                end = np.array([END_ID], "<u4").tobytes()
                made = [x.tobytes() + end if z else x.tobytes() for x, z in zip(own, last.tolist(), strict=True)]
                columns = [
                    batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array([zlib.crc32(x) for x in made], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in made], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of a bin, times it is used)] that packs every counted piece."""
    left = {k: v for k, v in histogram.items() if v}
    have = sorted(left)
    out = []

    def most(gap: int) -> int:
        """Longest length with pieces left that fits, or 0."""
        i = bisect_left(have, gap + 1)
        return have[i - 1] if i else 0

    def take(x: int, n: int = 1) -> None:
        left[x] -= n
        if not left[x]:
            del left[x], have[bisect_left(have, x)]

    def give(x: int) -> None:
        if x not in left:
            insort(have, x)
        left[x] = left.get(x, 0) + 1

    while have:
        content, gap = [], capacity
        while x := most(gap):
            take(x)
            content.append(x)
            gap -= x
        if gap and len(content) > 1:
            small = content[-1]
            room, best = gap + small, (small, 0, 0)
            i, j = 0, bisect_left(have, room) - 1
            while i <= j:
                a, b = have[i], have[j]
                if a + b > room:
                    j -= 1
                elif i == j and left[a] < 2:
                    break
                else:
                    best = max(best, (a + b, a, b))
                    if a + b == room:
                        break
                    i += 1
            if best[1]:
                content.pop()
                give(small)
                take(best[1])
                take(best[2])
                content += best[1:]
        need = {x: content.count(x) for x in content}
        more = min(left.get(x, 0) // n for x, n in need.items())
        for x, n in need.items():
            if more:
                take(x, more * n)
        out.append((content, 1 + more))
    return out


def pack(rows: DataFrame, *, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to rows that have doc_id, piece, length (1 to capacity) and ids_crc32.

    Equal rows are ranked in any order, which changes nothing. An empty table gives an empty table.
    """
    spark = rows.sparkSession
    salts = partitions(spark)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places, sequence, used = [], 0, dict.fromkeys(histogram, 0)
    for content, times in plan(histogram, capacity):
        at = 0
        need = {x: content.count(x) for x in content}
        seen = dict.fromkeys(need, 0)
        for x in content:
            # the k-th piece of this length in the i-th bin of the pattern has rank used + i * need + k
            places.append((x, used[x], used[x] + times * need[x], need[x], seen[x], sequence, at))
            seen[x] += 1
            at += x
        for x, n in need.items():
            used[x] += times * n
        sequence += times
    slots = _slots(spark, places)
    ranked = (
        salted.withColumn("_in", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")))
        .join(before, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_in") - 1)
    )
    # a length's ranges follow each other: the last that starts at or before the rank holds it
    run = F.element_at(F.col("_runs"), F.size(F.filter(F.col("_runs"), lambda r: r["lo"] <= F.col("_rank"))))
    placed = ranked.join(F.broadcast(slots), "length").withColumn("_run", run)  # at most `capacity` rows
    turn = F.col("_rank") - F.col("_run.lo")
    placed = placed.withColumn("sequence_id", F.col("_run.sequence") + F.floor(turn / F.col("_run.need"))).withColumn(
        "offset", F.element_at(F.col("_run.offsets"), (turn % F.col("_run.need") + 1).cast("int"))
    )
    return placed.select(*rows.columns, "sequence_id", "offset")


def _slots(spark: SparkSession, places: list[tuple]) -> DataFrame:
    runs: dict[tuple, list] = {}
    for x, lo, _, need, k, sequence, at in places:
        runs.setdefault((x, lo, need, sequence), []).append((k, at))
    by: dict[int, list] = {}
    for (x, lo, need, sequence), offsets in runs.items():
        by.setdefault(x, []).append((lo, need, sequence, [at for _, at in sorted(offsets)]))
    return spark.createDataFrame([(x, sorted(r)) for x, r in by.items()], "length long, _runs array<struct<lo: long, need: long, sequence: long, offsets: array<long>>>")


def packed_documents(docs: DataFrame, *, capacity: int = 1024, path: str | None = None) -> DataFrame:
    """Every piece of docs with its place. Ids are made once: what pack() reads twice is written to the shared folder, without the ids."""
    return pack(written(pieces(docs, capacity=capacity, path=path), "pieces"), capacity=capacity)


def sequences(packed: DataFrame, with_ids: DataFrame, *, capacity: int = 1024) -> DataFrame:
    """(sequence_id, ids): the sequences themselves. with_ids: pieces(..., with_ids=True) of the same documents; doc_id must be unique and not null."""
    joined = packed.select("doc_id", "piece", "sequence_id", "offset").join(with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` ids
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
ORACLE: dict[str, str] = {}
