"""Best-fit packing of token runs with certified lower bounds and repacking rounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiered.llm import shared, tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PACKED = f"{PIECES}, sequence_id long, offset long, free int, open boolean"


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, from dual feasible functions.

    Three families over all their parameters, by a histogram of lengths: the sum of sizes;
    sizes above capacity - p count whole and those below p not at all, for each p up to half
    the capacity; and sizes rounded down to parts of k + 1, for k up to 50. The largest
    bound counts.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    n, mass = np.cumsum(count), np.cumsum(count * size)
    best = -(-int(mass[-1]) // capacity)
    p = np.arange(1, capacity // 2 + 1)
    if len(p):
        large = n[-1] - n[capacity - p]
        middle = mass[capacity - p] - mass[p - 1]
        best = max(best, int((large - (-middle // capacity)).max()))
    for k in range(1, 51):
        scaled = (k + 1) * size
        even = scaled % capacity == 0
        # In parts of k * capacity, to stay in whole numbers.
        value = np.where(even, k * size, scaled // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins. Lengths are 1 to capacity.

    Longest first, each into the fullest bin that has room; bins of equal room are taken
    last opened first. The set of rooms in use is one whole number's bits.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = used = 0
    for k, length in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, used
            used += 1
        bins[k], offsets[k] = bin_, capacity - room
        if left := room - length:
            with_room[left].append(bin_)
            rooms |= 1 << left
    return bins, offsets, used


def cut_documents(
    docs: DataFrame, capacity: int, vocabulary: str, end_id: int = 0,
    key: str = "doc_id", text: str = "text", remember: int = tokens.REMEMBER,
) -> DataFrame:
    """Pieces of at most `capacity` ids of each text with its end id.

    A document longer than `capacity` is cut into whole pieces of `capacity`, its first piece
    taking the rest. Each piece has a number `row` of its own, so repeated rows and null keys
    stay apart. A null text is the end id alone. Text is not shuffled. A worker process keeps
    the ids of about `remember` words, which changes no result.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.encoder(vocabulary, remember).encode, np.array([end_id], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in shared.lean(batches):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for rows in tokens.slices(texts):
                for k, ids in zip(rows, encode([texts[k] for k in rows])):
                    ids += end
                    total, at = len(ids) // 4, 0
                    size = total % capacity or capacity
                    for piece in range(-(-total // capacity)):
                        crc = zlib.crc32(ids[4 * at : 4 * (at + size)])
                        out.append((keys[k], piece, at, size, crc, row))
                        at, size, row = at + size, capacity, row + 1
            columns = list(zip(*out)) or [()] * 6
            types = (pa.int64(), pa.int32(), *[pa.int64()] * 4)
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def _pack_group(capacity: int, round_: int):
    """Packs one group; says which bins should exchange their documents."""

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        free = capacity - np.bincount(bins, lengths, minlength=used).astype(np.int64)
        if used > lower_bound(lengths, capacity):
            # The bins that hold nearly all of the waste, the emptiest first.
            order = np.argsort(-free, kind="stable")
            waste = np.cumsum(free[order])
            take = np.searchsorted(waste, 0.95 * waste[-1]) + 1
            open_ = np.zeros(used, bool)
            open_[order[:take]] = True
            open_ &= free > 0
        else:
            open_ = 2 * free >= capacity
        # Bins of each group and round have numbers of their own.
        first = (round_ << 58) | (key[0].as_py() << 28)
        for name, column in (
            ("sequence_id", pa.array(first + bins)),
            ("offset", pa.array(offsets)),
            ("free", pa.array(free[bins].astype(np.int32))),
            ("open", pa.array(open_[bins])),
        ):
            group = group.append_column(name, column)
        return group.drop_columns(["part"])

    return pack


def pack_pieces(
    pieces: DataFrame, capacity: int, group_rows: int = 50_000, rounds: int = 6
) -> DataFrame:
    """Packs pieces of 1 to `capacity` ids into sequences of at most `capacity`.

    A full piece is a sequence alone. The others are dealt by hash into groups of about
    `group_rows`, a bound that does not grow with the data, and each group is packed by
    best-fit decreasing. A dual-feasible-function bound certifies a group whose bin count
    cannot be beaten. The worst bins of other groups, and the nearly empty last bins of
    certified ones, exchange their documents over new groups and are packed again while that
    saves bins, up to `rounds` times. Returns the pieces with sequence_id and offset.
    """
    spark = pieces.sparkSession
    full = pieces.where(F.col("length") >= capacity).select(
        "*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    waiting = pieces.where(F.col("length") < capacity)
    done, bins_before, old = [full], None, None
    for round_ in range(rounds):
        count = waiting.count()
        if not count:
            break
        groups = -(-count // group_rows)
        part = F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(groups))
        packed = shared.staged(
            waiting.withColumn("part", part).groupBy("part").applyInArrow(
                _pack_group(capacity, round_), PACKED
            ),
            f"packed-{round_}",
        )
        bins = packed.where("offset = 0").count()
        if bins_before is not None and bins >= bins_before:
            break
        if old is not None:
            done.append(old.where(~F.col("open")))
        old = packed
        if groups == 1:
            break
        waiting = packed.where("open").select(pieces.columns)
        bins_before = packed.where("open and offset = 0").count()
    if old is not None:
        done.append(old)
    columns = [*pieces.columns, "sequence_id", "offset"]
    out = done[0].select(columns)
    for part in done[1:]:
        out = out.unionByName(part.select(columns))
    return out


def pack_documents(
    docs: DataFrame, capacity: int, vocabulary: str, end_id: int = 0,
    key: str = "doc_id", text: str = "text", remember: int = tokens.REMEMBER,
) -> DataFrame:
    """Pieces of all documents with their place in sequences: see the two steps above.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null texts and
    keys, empty texts and repeated rows are packed like any other; an empty table gives no
    rows; other columns are not read.
    """
    pieces = shared.staged(
        cut_documents(docs, capacity, vocabulary, end_id, key, text, remember), "pieces"
    )
    return pack_pieces(pieces, capacity).drop("row")
