"""Token-id files of patched frame-of-reference blocks: writer, reader, Spark jobs.

A file is `MAGIC`, then blocks, then a footer. A block is a header (minimum u32, values u16,
exceptions u16, width u8), the packed differences to the minimum, and the exception list
(positions u16, full differences u32). The width is that of the differences' percentile;
wider differences are exceptions. The footer is the offset of each block (u64), the id of
each document (i64), its null flag (u8) and its token count (u32), the three lengths
(blocks u64, documents u64, footer offset u64) and `MAGIC` again. All is little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiered.llm import shared, tokens

MAGIC = b"PFORIDS1"
BLOCK = 4096
HEADER = np.dtype([("low", "<u4"), ("n", "<u2"), ("out", "<u2"), ("width", "u1")])
#: Values packed or unpacked together, which bounds the memory of the bit matrix.
TOGETHER = 64 * BLOCK


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits that each number needs, at least one."""
    return np.maximum(1, np.frexp(x.astype(np.float64))[1]).astype(np.uint8)


def pack_blocks(values: np.ndarray, percentile: float) -> list[bytes]:
    """Blocks of at most BLOCK values each, the last one shorter."""
    out: list[bytes] = []
    for at in range(0, len(values), TOGETHER):
        part = values[at : at + TOGETHER]
        full = len(part) // BLOCK
        groups = [part[: full * BLOCK].reshape(full, BLOCK)] if full else []
        if len(part) > full * BLOCK:
            groups.append(part[full * BLOCK :].reshape(1, -1))
        for group in groups:
            n = group.shape[1]
            low = group.min(axis=1)
            over = group - low[:, None]
            rank = min(n - 1, int(np.ceil(percentile * n)) - 1)
            width = _widths(np.partition(over, rank, axis=1)[:, rank])
            packed: dict[int, bytes] = {}
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                some = np.ascontiguousarray(over[rows], "<u4").view(np.uint8)
                bits = np.unpackbits(some, axis=1, bitorder="little").reshape(len(rows), n, 32)
                bytes_ = np.packbits(
                    bits[:, :, :w].reshape(len(rows), -1), axis=1, bitorder="little"
                )
                packed |= {int(r): b.tobytes() for r, b in zip(rows, bytes_)}
            outliers = over >> width[:, None].astype(np.uint32) > 0
            for r in range(len(group)):
                where = np.flatnonzero(outliers[r])
                head = np.array([(low[r], n, len(where), width[r])], HEADER)
                out.append(
                    head.tobytes() + packed[r] + where.astype("<u2").tobytes()
                    + over[r, where].astype("<u4").tobytes()
                )
    return out


def unpack_block(block: bytes) -> np.ndarray:
    head = np.frombuffer(block, HEADER, 1)[0]
    n, w, out = int(head["n"]), int(head["width"]), int(head["out"])
    at = HEADER.itemsize
    size = (n * w + 7) // 8
    bits = np.unpackbits(
        np.frombuffer(block, np.uint8, size, at), count=n * w, bitorder="little"
    ).reshape(n, w)
    # Each value's bits as one little-endian 32-bit word.
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :w] = bits
    over = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()
    if out:
        where = np.frombuffer(block, "<u2", out, at + size)
        over[where] = np.frombuffer(block, "<u4", out, at + size + 2 * out)
    return over + head["low"]


class Writer:
    """One file, written in one go; blocks leave memory as they fill."""

    def __init__(self, path: str, percentile: float) -> None:
        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.path, self.percentile = path, percentile
        self.out = system.open_output_stream(inner)
        self.out.write(MAGIC)
        self.at, self.ids = len(MAGIC), 0
        self.offsets: list[int] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.open: list[bytes] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.ids += len(ids) // 4
        self.open.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= TOGETHER:
            self._blocks(self.waiting // BLOCK * BLOCK)

    def _blocks(self, count: int) -> None:
        values = np.frombuffer(b"".join(self.open), "<u4")
        for block in pack_blocks(values[:count], self.percentile):
            self.offsets.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.open = [values[count:].tobytes()]
        self.waiting = len(values) - count

    def close(self) -> None:
        self._blocks(self.waiting)
        for column in (
            np.array(self.offsets, "<u8"),
            np.array([d or 0 for d in self.docs], "<i8"),
            np.array([d is None for d in self.docs], "u1"),
            np.array(self.counts, "<u4"),
            np.array([len(self.offsets), len(self.docs), self.at], "<u8"),
        ):
            self.out.write(column.tobytes())
        self.out.write(MAGIC)
        self.out.close()


class Reader:
    """The index of one file; blocks are read when asked for."""

    def __init__(self, path: str) -> None:
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(24 + len(MAGIC), size - 24 - len(MAGIC))
        if tail[24:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is not a complete token file")
        blocks, docs, self.end = (int(x) for x in np.frombuffer(tail, "<u8", 3))
        index = self.file.read_at(8 * blocks + 13 * docs, self.end)
        self.offsets = np.frombuffer(index, "<u8", blocks)
        self.docs = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.null = np.frombuffer(index, "u1", docs, 8 * blocks + 8 * docs) > 0
        self.counts = np.frombuffer(index, "<u4", docs, 8 * blocks + 9 * docs)

    def block(self, k: int) -> np.ndarray:
        end = self.end if k + 1 == len(self.offsets) else int(self.offsets[k + 1])
        return unpack_block(self.file.read_at(end - int(self.offsets[k]), int(self.offsets[k])))

    def tokens(self, start: int, count: int) -> np.ndarray:
        """Any run of ids of the file, through the block index."""
        first, last = start // BLOCK, (start + max(count, 1) - 1) // BLOCK
        run = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return run[start - first * BLOCK :][:count]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(id, start in the file, tokens, crc32) of each document, block by block."""
        start = have = 0
        block, k = np.empty(0, np.uint32), 0
        for doc, null, count in zip(self.docs.tolist(), self.null.tolist(), self.counts.tolist()):
            crc, left = 0, count
            while left:
                if have == len(block):
                    block, have, k = self.block(k), 0, k + 1
                part = block[have : have + left]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                have += len(part)
                left -= len(part)
            yield None if null else doc, start, count, crc
            start += count


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 0,
    percentile: float = 0.95,
    file_ids: int = 1 << 26,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encodes all texts and writes their ids, in ascending key order, as token files.

    Rows are dealt by range of the key and sorted in each part, so parts in order hold the
    whole order. A task writes files of about `file_ids` ids; a file's name carries the task
    attempt, and the returned manifest (part, file, path, n_docs, n_ids) names the files of
    the attempts that Spark committed, so a lost or repeated task leaves only unnamed files.

    Null texts are the end id alone; null keys come first and are kept as null; repeated
    rows are all written. An empty table has an empty manifest. Other columns are not read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        files: list[Writer] = []
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for rows in tokens.slices(texts):
                for k, coded in zip(rows, encode([texts[k] for k in rows])):
                    if not files or files[-1].ids >= file_ids:
                        if files:
                            files[-1].close()
                        name = f"part-{part:06d}-{len(files):04d}-{attempt}.pfor"
                        files.append(Writer(f"{folder}/{name}", percentile))
                    files[-1].add(ids[k], coded + end)
        if files:
            files[-1].close()
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part] * len(files), pa.int32()),
                    "file": pa.array(range(len(files)), pa.int32()),
                    "path": [f.path for f in files],
                    "n_docs": pa.array([len(f.docs) for f in files], pa.int64()),
                    "n_ids": pa.array([f.ids for f in files], pa.int64()),
                }
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key")
    return shared.staged(
        ordered.mapInArrow(write, "part int, file int, path string, n_docs long, n_ids long"),
        "manifest",
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row a document, read back from the files: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before, over all files; it is a prefix sum over
    the manifest, which has a row for each file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                for found in batched(Reader(path).documents(), 10_000):
                    doc, start, count, crc = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc, pa.int64()),
                            pa.array([base + s for s in start], pa.int64()),
                            pa.array(count, pa.int64()),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )
    tasks = max(1, min(manifest.count(), 10_000))
    return files.repartition(tasks).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
