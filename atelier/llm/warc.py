"""Deterministic sharded WARC archives.

Pages are sorted by page_id in ranges whose bounds depend on the rows alone. A task writes a range, begins
another file when the compressed size reaches `roll_bytes`, and moves each finished file from a temporary
name to its own; a second attempt writes the same bytes under the same name. The manifest, written last,
commits: readers see only the files it lists. Every record is a gzip member with regenerated headers and
digests; equal payloads are stored once, later ones as revisits.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.shared import shared_dir, table

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_BUCKETS = 1 << 16
_MANIFEST = "file string, part long, records long, bytes long, sha256 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit holds the HTTP header alone, with the full payload's length and digest."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {target}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}"] if revisit else []),
        *([f"Page-Id: {page_id}"] if page_id is not None else []),
        *([f"Refers-To-Page-Id: {refers_to}"] if revisit and refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of one record; the digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest, revisit = fields["WARC-Payload-Digest"][5:], fields["WARC-Type"] == "revisit"
    if fields["WARC-Block-Digest"][5:] != base32_sha1(block) or not revisit and (digest != base32_sha1(payload) or length != len(payload)):
        raise ValueError(f"{fields['WARC-Record-ID']}: the digests do not fit the content")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("Page-Id"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("Refers-To-Page-Id"),
        "html": None if revisit else payload.decode(),
    }


def place(edges: np.ndarray) -> Callable:
    """Column function: how many of the sorted edges are at most the value; null counts as the largest."""

    @F.pandas_udf("long")
    def count(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), len(edges), np.searchsorted(edges, ids.fillna(0).to_numpy(np.int64), "right")))

    return count


def bounds(sizes: DataFrame, range_bytes: int | None) -> list[int]:
    """First page_ids of the ranges after the first; from (page_id, n) rows alone, whatever their partitioning.

    range_bytes None: a 64th of all, between 256 KiB and 512 MiB. Histograms of at most 65,536 buckets go to the driver.
    """
    sizes = sizes.where(F.col("page_id").isNotNull())
    lo, hi, total = sizes.agg(F.min("page_id"), F.max("page_id"), F.sum("n")).first()
    if lo is None:
        return []
    want = range_bytes or min(max(total // 64, 1 << 18), 1 << 29)
    spans = [(lo, hi + 1, total)]
    while heavy := [s for s in spans if s[2] > want // 2 and s[1] - s[0] > 1][: _BUCKETS // 8]:
        cuts: list[int] = []
        for a, b, n in heavy:
            parts = min(b - a, 4 * -(-n // want), max(2, _BUCKETS // len(heavy)))
            cuts += [a + (b - a) * i // parts for i in range(parts)] + [b]
        edges = np.unique(cuts)
        counted = {r["b"]: r["n"] for r in sizes.withColumn("b", place(edges)("page_id") - 1).groupBy("b").agg(F.sum("n").alias("n")).collect()}
        done = set(heavy)
        split = [(int(edges[i]), int(edges[i + 1]), n) for i, n in counted.items() if 0 <= i < len(edges) - 1 and any_in(edges[i], heavy)]
        spans = sorted([s for s in spans if s not in done] + split)
    out, have = [], 0
    for a, _, n in spans:
        if have and have + n > want:
            out.append(a)
            have = 0
        have += n
    return out


def any_in(x: int, spans: list[tuple[int, int, int]]) -> bool:
    i = int(np.searchsorted([s[0] for s in spans], x, "right")) - 1
    return i >= 0 and x < spans[i][1]


def write(pages: DataFrame, root: str, *, min_bytes: int = 0, range_bytes: int | None = None, roll_bytes: int = 1 << 30, level: int = 6, date: str = DATE) -> DataFrame:
    """Writes one record per row of pages (page_id, url, html) below root and returns the manifest.

    Null html is an empty payload; a null url is left out. Of rows with equal payloads of at least min_bytes bytes, that with the
    smallest page_id is the response (a null page_id counts as the largest); the others, repeated rows included, revisit
    it. No rows: an empty manifest. Other columns of pages are left out.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    hashed = rows.select("page_id", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").cast("long").alias("n"))
    starts = np.array(bounds(hashed, range_bytes), np.int64)
    large = hashed.where(F.col("n") >= min_bytes)
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    revisits = large.select("page_id", "digest").join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()

    marks = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to")
    both = rows.withColumns({"digest": F.lit(None).cast("string"), "refers_to": F.lit(None).cast("long")}).unionByName(marks)
    both = both.withColumn("part", place(starts)("page_id")).repartition(len(starts) + 1, "part")
    both = both.sortWithinPartitions("part", F.col("page_id").asc_nulls_last(), F.col("digest").asc_nulls_last(), "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        out: dict = {}

        def close() -> list[tuple]:
            out["stream"].close()
            store.move(out["tmp"], out["path"])
            return [(out["name"], out["part"], out["records"], out["bytes"], out["sha"].hexdigest())]

        now, seq, page, marked, seen, done = None, 0, object(), {}, set(), []
        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != now:
                    done += close() if out else []
                    out, now, seq = {}, r["part"], 0
                if r["page_id"] != page:
                    page, marked, seen = r["page_id"], {}, set()
                if r["html"] is None:
                    marked[r["digest"]] = r["refers_to"]
                    continue
                payload = r["html"].encode()
                digest = hashlib.sha1(payload).hexdigest()
                revisit = digest in marked or digest in seen and len(payload) >= min_bytes
                seen.add(digest)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record(page, r["url"], payload, marked.get(digest, page), revisit, date)) + packer.flush()
                if out and out["bytes"] + len(data) > roll_bytes:
                    done += close()
                    out, seq = {}, seq + 1
                if not out:
                    name = f"part-{now:06d}-{seq:05d}.warc.gz"
                    tmp = f"{base}/_temporary/{name}.{uuid.uuid4().hex}"
                    for d in ("_temporary", "data"):
                        store.create_dir(f"{base}/{d}", recursive=True)
                    out = {"name": name, "tmp": tmp, "path": f"{base}/data/{name}", "part": now, "records": 0, "bytes": 0, "sha": hashlib.sha256(), "stream": store.open_output_stream(tmp, compression=None)}
                out["stream"].write(data)
                out["sha"].update(data)
                out["records"] += 1
                out["bytes"] += len(data)
        done += close() if out else []
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("file", "part", "records", "bytes", "sha256"), x, strict=True)) for x in done],
            pa.schema([("file", pa.string()), ("part", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]),
        )

    both.mapInArrow(run, _MANIFEST).write.parquet(f"{root}/manifest")
    return pages.sparkSession.read.schema(_MANIFEST).parquet(f"{root}/manifest")


_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]
)


def read(spark: SparkSession, root: str, *, with_html: bool = True) -> DataFrame:
    """The records of the files that the manifest lists; a record at a time is in memory, and digests are checked."""
    schema = pa.schema([f for f in _READ if with_html or f.name != "html"])

    def members(stream: pa.NativeFile) -> Iterator[bytes]:
        unpacker, made, data = zlib.decompressobj(31), [], b""
        while data or (data := stream.read(1 << 18)):
            made.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(made)
                unpacker, made = zlib.decompressobj(31), []
        if any(made):
            raise ValueError("a file ends within a record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{base}/data/{name}", compression=None) as stream:
                    for data in members(stream):
                        rows.append(parsed(data))
                        size += len(data)
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest").select("file")
    types = {"int64": "long", "string": "string"}
    return files.repartition(max(1, files.count()), "file").mapInArrow(run, ", ".join(f"{f.name} {types[str(f.type)]}" for f in schema))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    elif root.startswith("file:/") and not root.startswith("file://"):
        root = f"file://{root[5:]}"
    write(table(spark, sf_dir, "pages"), root)
    return read(spark, root, with_html=False)


QUERIES = {"op7_warc": op7_warc}
ORACLE = {
    "op7_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id,
             array_to_string(list_transform(range(1, 41), lambda i: right(cast(cast(strpos('0123456789abcdef', substr(h, i, 1)) - 1 AS int)::bit AS varchar), 4)), '') AS bits FROM p)
SELECT page_id, url, strlen(html)::bigint AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           list_sum(list_transform(range(1, 6), lambda j: cast(substr(bits, 5 * i + j, 1) AS int) * (1 << (5 - j))))::bigint + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
}
