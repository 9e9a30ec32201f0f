"""Deterministic sharded WARC archives: writer, reader, revisit records."""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiered.llm import shared

SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def _header(lines: list[tuple[str, str | int | None]], block: bytes) -> bytes:
    """One gzip member with a whole record; the same bytes for the same record."""
    named = [f"{k}: {v}" for k, v in lines if v is not None]
    digest = hashlib.sha256(block).hexdigest()
    named += [f"WARC-Block-Digest: sha256:{digest}", f"Content-Length: {len(block)}"]
    head = "\r\n".join(["WARC/1.1", *named, "", ""]).encode()
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def _id(*parts: object) -> str:
    digest = hashlib.sha256(repr(parts).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def _page_record(
    page: int | None, url: str | None, payload: bytes, digest: str,
    again: int, refers: tuple[int | None] | None, date: str,
) -> bytes:
    """A response, or a revisit without payload if `refers` holds the response's page."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers is not None
    return _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _id("revisit" if revisit else "response", page, digest, again)),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else "".join(url.split()) or None),
            ("X-Page-ID", page),
            ("WARC-Profile", SAME_PAYLOAD if revisit else None),
            ("WARC-Refers-To", _id("response", refers[0], digest, 0) if revisit else None),
            ("X-Refers-To-Page-ID", refers[0] if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
        ],
        http if revisit else http + payload,
    )


class _File:
    """An archive under a temporary name until it is complete."""

    def __init__(self, folder: str, name: str, attempt: int, date: str) -> None:
        self.path = f"{folder}/{name}"
        self.system, inner = fs.FileSystem.from_uri(folder)
        self.system.create_dir(inner, recursive=True)
        self.final, self.temporary = f"{inner}/{name}", f"{inner}/.{name}-{attempt}"
        self.out = self.system.open_output_stream(self.temporary, compression=None)
        self.bytes = self.records = 0
        info = b"software: page archive writer\r\nformat: WARC file version 1.1\r\n"
        self.add(
            _header(
                [
                    ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _id("warcinfo", name)),
                    ("WARC-Date", date), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields"),
                ],
                info,
            )
        )
        self.records = 0

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> None:
        self.out.close()
        try:
            self.system.move(self.temporary, self.final)
        except OSError:
            # Another attempt of the task was first; its bytes are the same.
            if self.system.get_file_info(self.final).size != self.bytes:
                raise
            self.system.delete_file(self.temporary)


#: Bytes that a record counts besides its payload when records are dealt to parts.
HEAD_BYTES = 512


def _cuts(slim: DataFrame, part_bytes: int, least_parts: int) -> tuple[int, list[tuple]]:
    """Number of parts and the first (known key, key, digest) of each that is not empty.

    Records, ordered by key and digest, are cut where the running sum of their bytes passes
    a multiple of the share of a part. The sums are exact, so the cuts depend on the records
    alone and not on how the tasks that add them up are dealt.
    """
    dealt = shared.staged(
        slim.groupBy("key", "digest").agg(F.sum(F.col("bytes") + HEAD_BYTES).alias("size"))
        .repartitionByRange("key", "digest")
        .withColumn("range", F.spark_partition_id()),
        "ranges",
    )
    total = dealt.agg(F.sum("size")).first()[0] or 0
    parts = max(least_parts, -(-total // part_bytes))
    share = max(1, -(-total // parts))
    # One row a task of the sort: ordering them in one task is bounded.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("range").agg(F.sum("size").alias("bytes")).select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("range").orderBy("key", "digest")
    start = F.col("base") + F.sum("size").over(inside) - F.col("size")
    place = F.struct(
        F.col("key").isNotNull().alias("known"),
        F.coalesce("key", F.lit(0).cast("long")).alias("key"), "digest",
    )
    # At most `parts` rows: one for each share of the bytes.
    firsts = (
        dealt.join(F.broadcast(bases), "range")
        .withColumn("start", start)
        .select(F.expr(f"start div {share}").alias("part"), place.alias("place"))
        .groupBy("part").agg(F.min("place").alias("place"))
        .collect()
    )
    shared.dropped(dealt)
    return parts, sorted(tuple(r["place"]) for r in firsts)


def write_archives(
    pages: DataFrame,
    folder: str,
    roll_bytes: int = 1 << 28,
    least_bytes: int = 100,
    least_parts: int = 16,
    date: str = "2000-01-01T00:00:00Z",
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Writes one record a row, sorted by key, and returns the manifest.

    Of records with equal payloads of at least `least_bytes`, the one with the smallest key
    is a response and the others are revisits of it without payload. Digests meet their
    smallest key in a slim table without pages; the resulting marks are dealt together with
    the pages, so pages are shuffled once. Prefix sums of bytes over the sorted keys and
    digests cut the records into parts of four times `roll_bytes`, at least `least_parts`; a
    part is written by one task, which starts a new file when the compressed size reaches
    `roll_bytes`. Files are written under temporary names and renamed when complete, and the
    manifest (part, file, path, records, bytes) lists those of committed tasks. Names and
    bytes depend on the rows and these parameters alone: another run, another number of
    tasks or another order of the input writes the same files.

    A null page is an empty payload. Null keys sort first and never win over a known key;
    the record then has no page id. Of repeated rows with one key and payload, one is the
    response and the others revisit it; they are written by one task, while rows of one key
    with different payloads may be in several parts. An empty table has an empty manifest.
    Other columns are not read.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("html")
    )
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    slim = rows.select("key", "digest", F.octet_length("html").cast("long").alias("bytes"))
    parts, cuts = _cuts(slim, 4 * roll_bytes, least_parts)
    large = slim.where(F.col("bytes") >= least_bytes).select("key", "digest")
    firsts = (
        large.groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    marks = large.join(firsts, "digest").where(~F.col("key").eqNullSafe(F.col("first")))
    none = F.lit(None).cast("string")
    marked = marks.distinct().select(
        "key", "digest", F.lit(0).alias("kind"), none.alias("url"), none.alias("html"), "first"
    )
    both = marked.unionByName(
        rows.select(
            "key", "digest", F.lit(1).alias("kind"), "url", "html",
            F.lit(None).cast("long").alias("first"),
        )
    )
    # One short row for each part.
    held = pages.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def part_of(known: pd.Series, key: pd.Series, digest: pd.Series) -> pd.Series:
        first = held.value
        places = zip(known.tolist(), key.tolist(), digest.tolist())
        return pd.Series([max(0, bisect.bisect_right(first, p) - 1) for p in places], dtype="int32")

    both = both.withColumn(
        "part",
        part_of(F.col("key").isNotNull(), F.coalesce("key", F.lit(0).cast("long")), "digest"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        attempt = context.taskAttemptId()
        files: list[tuple[int, int, _File]] = []
        current: object = ()
        refers: dict[str, tuple[int | None]] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if row["key"] != current:
                        current, refers, seen = row["key"], {}, {}
                    if row["kind"] == 0:
                        refers[row["digest"]] = (row["first"],)
                        continue
                    data = row["html"].encode("utf-8", "surrogatepass")
                    digest, part = row["digest"], row["part"]
                    target = refers.get(digest)
                    again = seen.get(digest, 0)
                    seen[digest] = again + 1
                    if target is None and again and len(data) >= least_bytes:
                        target = (row["key"],)
                    of, number, file = files[-1] if files else (None, 0, None)
                    if of != part or file.bytes >= roll_bytes:
                        if file:
                            file.close()
                        number = number + 1 if of == part else 0
                        name = f"pages-{part:06d}-{number:04d}.warc.gz"
                        file = _File(folder, name, attempt, date)
                        files.append((part, number, file))
                    file.add(
                        _page_record(row["key"], row["url"], data, digest, again, target, date)
                    )
        if files:
            files[-1][2].close()
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([p for p, _, _ in files], pa.int32()),
                    "file": pa.array([n for _, n, _ in files], pa.int32()),
                    "path": [f.path for _, _, f in files],
                    "records": pa.array([f.records for _, _, f in files], pa.int64()),
                    "bytes": pa.array([f.bytes for _, _, f in files], pa.int64()),
                }
            )

    ordered = both.repartitionById(parts, "part").sortWithinPartitions(
        "part", "key", "digest", "kind", "url"
    )
    return shared.staged(
        ordered.mapInArrow(write, "part int, file int, path string, records long, bytes long"),
        "archives",
    )


def members(path: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one gzip member at a time."""
    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_stream(inner, compression=None) as source:
        member, parts, rest = zlib.decompressobj(31), [], b""
        while rest or (rest := source.read(chunk)):
            parts.append(member.decompress(rest))
            rest = member.unused_data if member.eof else b""
            if member.eof:
                yield b"".join(parts)
                member, parts = zlib.decompressobj(31), []
        if parts:
            raise ValueError(f"{path} ends inside a record")


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by name and the block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row a page record, from the files the manifest names.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to. The digest of a
    response is computed from its payload and must equal the header's; a revisit has the
    size and digest of the full payload in its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("record_type", pa.string()),
                ("refers_to", pa.int64()),
            ]
        )
        for batch in batches:
            for path in batch.column(0).to_pylist():
                out: list[dict] = []
                for record in members(path):
                    headers, block = parsed(record)
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and (
                        len(payload) != size or hashlib.sha256(payload).hexdigest() != digest
                    ):
                        raise ValueError(f"{path}: payload of {headers['WARC-Record-ID']}")
                    page, first = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                    out.append(
                        {
                            "page_id": page and int(page), "payload_bytes": size,
                            "payload_digest": digest, "record_type": kind,
                            "refers_to": first and int(first),
                        }
                    )
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
                yield pa.RecordBatch.from_pylist(out, schema)

    tasks = max(1, min(manifest.count(), 10_000))
    return manifest.select("path").repartition(tasks).mapInArrow(read, RECORD)
