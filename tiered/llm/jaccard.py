"""Jaccard self-join of shingle sets: R-trees over group counts inside shared-shingle lists.

Sets are spread over tasks by an exact rule: sort each set by one order common to all sets;
two sets that are similar enough share a shingle among their first few. Sets that share such
a shingle are a list. In a list, each set is a point: its shingles hashed into groups, the
more the larger the set, and counted. Two sets share at most the sum of the smaller counts of
each group, and a tree node's largest counts, folded to GROUPS groups, bound all sets below
it, so an R-tree join of the list leaves only the pairs that can reach the threshold; the
unfolded counts refuse most others, and what is left is compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiered.llm import shared
from tiered.llm.components import components
from tiered.llm.shingles import batches, mixed, shingle_sets

GROUPS = 128
#: Groups of the largest sets; smaller ones have a power of two, half their size at least.
MOST_GROUPS = 4096
LEAF = 32
FANOUT = 16
#: Sets of a list that one task compares at a time; longer lists are cut and their parts paired.
PART = 2048
#: Cells of the frequency sketch that orders shingles, and the shingles of a cell beyond which
#: a cell's lists are dealt over several tasks.
CELLS = 1 << 18
CELL_CHUNK = 1 << 14
HEAVY = 1 << 20
#: Shingles counted together before the repeated ones among them are told, the most of them
#: told, and the most that the order knows one by one. They decide about speed alone.
COUNTED = 1 << 21
TOLD = 1 << 15
COMMON = 1 << 20
#: Bits of the filter of wanted sets; when it fills up, more sets are sent than needed.
FILTER_BITS = 1 << 23
#: One in so many lists makes the first links, which spare the others most comparisons.
FIRST_ROUND = 16
#: Names of a set's first lists that travel with it, by which a pair found in several lists is
#: told. With more lists in common than these a pair may come twice, which changes no result.
FIRST_LISTS = 32
_NO_LIST = np.iinfo(np.int64).max


def group_points(hashes: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Group counts of sets that stand one after another; those over 255 are stored wide, with
    a byte more, so that both kinds have lengths of their own."""
    ends = np.cumsum(n)
    out = []
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        groups = min(MOST_GROUPS, max(GROUPS, 1 << max(0, (b - a - 1).bit_length() - 1)))
        counts = np.bincount((hashes[a:b] & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        wide = counts.max() > 255
        out.append(counts.astype("<u4").tobytes() + b"w" if wide else counts.astype(np.uint8).tobytes())
    return out


def _counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob[:-1], "<u4") if len(blob) % 2 else np.frombuffer(blob, np.uint8)


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts of fewer groups: both numbers are powers of two."""
    return counts.reshape(-1, groups).sum(axis=0, dtype=np.uint32)


def _vectors(blobs: list[bytes], groups: int = GROUPS) -> np.ndarray:
    """Counts of many sets in the same number of groups."""
    if all(len(b) == groups for b in blobs):
        return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, groups)
    out = np.empty((len(blobs), groups), np.uint32)
    for row, blob in zip(out, blobs):
        row[:] = _folded(_counts(blob), groups)
    return out.astype(np.uint16) if out.max(initial=0) < 1 << 16 else out


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    """How many leading shingles of a set of n must be shared with any similar set."""
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


class Tree:
    """R-tree over points, packed by size and then by leading counts."""

    def __init__(self, n: np.ndarray, points: np.ndarray, root: np.ndarray | None = None) -> None:
        self.order = tree_order(n, points)
        high, low_n, high_n = points[self.order], n[self.order], n[self.order]
        low_root = high_root = (np.arange(len(n)) if root is None else root)[self.order]
        self.levels = [(high, low_n, high_n, 1)]
        #: Least and largest class of each node of a level.
        self.roots = [(low_root, high_root)]
        for width in (LEAF, FANOUT, FANOUT):
            if len(high) == 1:
                break
            at = np.arange(0, len(high), width)
            high = np.maximum.reduceat(high, at)
            low_n, high_n = np.minimum.reduceat(low_n, at), np.maximum.reduceat(high_n, at)
            low_root = np.minimum.reduceat(low_root, at)
            high_root = np.maximum.reduceat(high_root, at)
            self.roots.append((low_root, high_root))
            self.levels.append((high, low_n, high_n, width))


def tree_order(n: np.ndarray, points: np.ndarray) -> np.ndarray:
    band = np.floor(np.log2(np.maximum(n, 1)) * 2.5)
    return np.lexsort((*points[:, 3::-1].T, band))


def possible(
    n_a: np.ndarray, n_b: np.ndarray, bound: np.ndarray, percent: int
) -> np.ndarray:
    """Whether sets of these least sizes with at most this overlap can be similar enough."""
    return (100 + percent) * bound >= percent * (n_a + n_b)


def tree_join(a: Tree, b: Tree, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entry numbers that the bound does not exclude, level by level from the top.

    Nodes whose sets are all of one class are not compared.
    """
    depth = min(len(a.levels), len(b.levels)) - 1
    i, j = (x.ravel() for x in np.indices((len(a.levels[depth][0]), len(b.levels[depth][0]))))
    if same:
        i, j = i[i <= j], j[i <= j]
    for level in range(depth, -1, -1):
        (high_a, low_a, top_a, _), (high_b, low_b, top_b, _) = a.levels[level], b.levels[level]
        sizes = (100 * top_a[i] >= percent * low_b[j]) & (100 * top_b[j] >= percent * low_a[i])
        least = np.minimum(a.roots[level][0][i], b.roots[level][0][j])
        apart = np.maximum(a.roots[level][1][i], b.roots[level][1][j]) != least
        i, j = i[sizes & apart], j[sizes & apart]
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 14):
            ii, jj = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            bound = np.minimum(high_a[ii], high_b[jj]).sum(axis=1, dtype=np.int64)
            keep[at : at + (1 << 14)] = possible(low_a[ii], low_b[jj], bound, percent)
        i, j = i[keep], j[keep]
        if level:
            width = a.levels[level][3]
            step_i, step_j = (x.ravel() for x in np.indices((width, width)))
            i = (i[:, None] * width + step_i).ravel()
            j = (j[:, None] * width + step_j).ravel()
            inside = (i < len(a.levels[level - 1][0])) & (j < len(b.levels[level - 1][0]))
            if same:
                inside &= i < j if level == 1 else i <= j
            i, j = i[inside], j[inside]
    if same and not depth:
        i, j = i[i < j], j[i < j]
    return a.order[i], b.order[j]


def finer_pairs(
    i: np.ndarray, j: np.ndarray, n: np.ndarray, blobs: list[bytes], percent: int
) -> np.ndarray:
    """Marks the pairs that all groups of the set with fewer of them do not exclude."""
    keep = np.ones(len(i), bool)
    groups = np.array([(len(b) // 4 if len(b) % 2 else len(b)) for b in blobs], np.int64)
    most = np.minimum(groups[i], groups[j])
    for level in np.unique(most[most > GROUPS]):
        # In steps of eight times the groups: most pairs fall at the first.
        for step in sorted({min(int(level), 8 * GROUPS), int(level)}):
            left = np.flatnonzero(keep & (most == level))
            sets, at = np.unique(np.concatenate([i[left], j[left]]), return_inverse=True)
            counts = _vectors([blobs[k] for k in sets.tolist()], step)
            of_i, of_j = at[: len(left)], at[len(left) :]
            some = max(1, (1 << 21) // step)
            for a in range(0, len(left), some):
                part = left[a : a + some]
                bound = np.minimum(counts[of_i[a : a + some]], counts[of_j[a : a + some]]).sum(
                    axis=1, dtype=np.int64
                )
                keep[part] = possible(n[i[part]], n[j[part]], bound, percent)
    return keep


def _small_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within runs of at most LEAF entries."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for m in np.unique(sizes):
        i, j = np.triu_indices(m, 1)
        at = starts[sizes == m][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    return np.concatenate(left), np.concatenate(right)


def _best(i: np.ndarray, j: np.ndarray, bound: np.ndarray, most: int) -> np.ndarray:
    """Marks, for each entry, its pairs with the highest bounds."""
    entry, pair = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
    order = np.lexsort((-np.tile(bound, 2), entry))
    entry, pair = entry[order], pair[order]
    rank = np.arange(len(entry)) - np.searchsorted(entry, entry)
    keep = np.zeros(len(i), bool)
    keep[pair[rank < most]] = True
    return keep


def _best_of_classes(i: np.ndarray, j: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Of the pairs between the same two classes, the number of the one with the highest bound."""
    low, high = np.minimum(i, j), np.maximum(i, j)
    order = np.lexsort((-bound, high, low))
    new = np.ones(len(order), bool)
    low, high = low[order], high[order]
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return order[new]


def listed(names: pa.Array) -> np.ndarray:
    """Names of each set's first lists, one row a set; rows are filled up with no list's name."""
    out = np.full((len(names), FIRST_LISTS), _NO_LIST)
    sizes = names.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = names.flatten().to_numpy()
    return out


def met_before(first: np.ndarray, i: np.ndarray, j: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Marks the pairs whose sets share a list that comes before the one of this name."""
    before = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 14):
        left = np.arange(at, min(at + (1 << 14), len(i)))
        # Sets with many lists in common share one of their very first.
        for k in range(first.shape[1]):
            one = first[i[left], k]
            left, one = left[one < name[left]], one[one < name[left]]
            if not len(left):
                break
            both = (first[j[left]] == one[:, None]).any(axis=1)
            before[left[both]] = True
            left = left[~both]
    return before


#: What a round emits: a few best pairs of each leaf, one pair of each two classes, all pairs.
LEAVES, CLASSES, ALL = "leaves", "classes", "all"


def _pairs_of_units(percent: int, emits: str):
    """Kernel over rows (unit, side, rep, root, n, point) sorted by unit: possible pairs.

    With a further column, the first lists of each set, a pair comes from the first list alone
    that its sets share.
    """

    def bounds(points: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        bound = np.empty(len(i), np.int64)
        for at in range(0, len(i), 1 << 14):
            part = slice(at, at + (1 << 14))
            bound[part] = np.minimum(points[i[part]], points[j[part]]).sum(axis=1, dtype=np.int64)
        return bound

    def small(name, first, rep, root, n, points, blobs, starts, sizes) -> pa.RecordBatch:
        i, j = _small_pairs(starts, sizes)
        fits = (root[i] != root[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j = i[fits], j[fits]
        bound = bounds(points, i, j)
        keep = possible(n[i], n[j], bound, percent)
        if first is not None:
            keep[keep] = ~met_before(first, i[keep], j[keep], name[i[keep]])
        i, j, bound = i[keep], j[keep], bound[keep]
        keep = finer_pairs(i, j, n, blobs, percent)
        i, j, bound = i[keep], j[keep], bound[keep]
        if emits == LEAVES:
            best = _best(i, j, bound, 2)
            i, j = i[best], j[best]
        elif emits == CLASSES:
            best = _best_of_classes(root[i], root[j], bound)
            i, j = i[best], j[best]
        return emit(rep[i], rep[j])

    def emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"]
        )

    def large(name, first, rep, root, n, points, blobs, side) -> pa.RecordBatch:
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        a = Tree(n[left], points[left], root[left])
        b = Tree(n[right], points[right], root[right]) if len(right) else a
        i, j = tree_join(a, b, not len(right), percent)
        i, j = left[i], right[j] if len(right) else left[j]
        if first is not None:
            keep = ~met_before(first, i, j, name[i])
            i, j = i[keep], j[keep]
        keep = finer_pairs(i, j, n, blobs, percent)
        i, j = i[keep], j[keep]
        if emits == CLASSES:
            best = _best_of_classes(root[i], root[j], bounds(points, i, j))
            i, j = i[best], j[best]
        return emit(rep[i], rep[j])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in _whole_units(rows):
            waiting = [batch]
            table = pa.Table.from_batches(waiting)
            unit = np.stack([table.column(k).to_numpy() for k in range(3)], axis=1)
            side, rep, root, n = (table.column(k).to_numpy() for k in range(3, 7))
            n = n.astype(np.int64)
            new = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[new, len(unit)])
            blobs = table.column(7).to_pylist()
            points = _vectors(blobs)
            name = unit[:, 0]
            first = listed(table.column(8).combine_chunks()) if table.num_columns > 8 else None
            tiny = sizes <= LEAF
            if emits == LEAVES:
                starts, lengths = [new[tiny]], [sizes[tiny]]
                order = np.arange(len(unit))
                for at, size in zip(new[~tiny], sizes[~tiny]):
                    order[at : at + size] = at + tree_order(
                        n[at : at + size], points[at : at + size]
                    )
                    cut = np.arange(at, at + size, LEAF)
                    starts.append(cut)
                    lengths.append(np.minimum(LEAF, at + size - cut))
                yield small(
                    name[order], None, rep[order], root[order], n[order], points[order], [blobs[k] for k in order],
                    np.concatenate(starts), np.concatenate(lengths),
                )
                continue
            # Both sides of a pair of parts are one unit: they are never small.
            tiny &= np.maximum.reduceat(side, new) == 0
            yield small(name, first, rep, root, n, points, blobs, new[tiny], sizes[tiny])
            for at, size in zip(new[~tiny], sizes[~tiny]):
                of = slice(at, at + size)
                yield large(
                    name[of], None if first is None else first[of], rep[of], root[of], n[of],
                    points[of], blobs[of], side[of],
                )

    return run


def _whole_units(rows: Iterator[pa.RecordBatch], least: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of at least `least` rows that end where a unit ends; a unit is bounded."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in rows:
        held.append(batch)
        count += batch.num_rows
        if count < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = [table.column(k)[-1].as_py() for k in range(3)]
        inside = np.ones(count, bool)
        for k in range(3):
            inside &= table.column(k).to_numpy() == last[k]
        cut = int(np.argmax(inside))
        if cut:
            yield table.slice(0, cut).combine_chunks().to_batches()[0]
        held, count = table.slice(cut).combine_chunks().to_batches(), count - cut
    if count:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


UNIT = ["list", "part", "other", "side", "rep", "root", "n", "point"]


def repeated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the shingles that stand more than once, and their counts."""
    token, count = np.unique(hashes, return_counts=True)
    order = np.lexsort((token, -count))[:TOLD]
    order = order[count[order] > 1]
    return token[order], count[order]


class Order:
    """How common shingles are: rare ones first, the commonest last.

    Common shingles are known one by one, with the counts that blocks of texts told of them;
    they rank after all others. The others rank by the count of their cell, less the common
    shingles in it, so that cells tell rare shingles apart although they also hold common ones.
    """

    def __init__(self, cells: np.ndarray, token: np.ndarray, count: np.ndarray) -> None:
        order = np.argsort(token)
        self.token = token[order]
        self.rank = 64 + np.frexp(count[order].astype(np.float64))[1].astype(np.uint8)
        rest = cells.astype(np.int64)
        np.subtract.at(rest, (token >> np.uint64(46)).astype(np.int64), count)
        self.cell_rank = np.frexp(np.maximum(rest, 0).astype(np.float64))[1].astype(np.uint8)
        self.shares = cells // HEAVY + 1

    def ranked(self, hashes: np.ndarray) -> np.ndarray:
        """One order for all sets: by rank, then by hash."""
        rank = self.cell_rank[(hashes >> np.uint64(46)).astype(np.int64)]
        if len(self.token):
            at = np.minimum(np.searchsorted(self.token, hashes), len(self.token) - 1)
            rank = np.where(self.token[at] == hashes, self.rank[at], rank)
        return (rank.astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))

    def split(self, tokens: np.ndarray) -> np.ndarray:
        """Over how many shares the list of a shingle is dealt."""
        return self.shares[(tokens >> np.uint64(46)).astype(np.int64)]


class Join:
    """The steps of one join; each leaves a table in the shared folder."""

    def __init__(self, docs: DataFrame, words: int, percent: int, key: str, text: str) -> None:
        self.spark, self.words, self.percent = docs.sparkSession, words, percent
        whole = F.col(text)
        # Two hashes with different seeds: equal only for equal texts.
        self.keyed = docs.select(
            F.col(key).cast("long").alias("doc_id"), whole.alias("text"),
            F.xxhash64(F.lit(1), whole).alias("k1"), F.xxhash64(F.lit(2), whole).alias("k2"),
        )
        # One row for each text and task goes into the shuffle, however many copies there are.
        first = Window.partitionBy("k1", "k2").orderBy(F.col("doc_id").asc_nulls_last())
        self.reps = shared.staged(
            self.keyed.where("text is not null")
            .withColumn("copy", F.row_number().over(first))
            .where("copy = 1")
            .drop("copy")
            .withColumn("rep", F.monotonically_increasing_id()),
            "texts",
        )
        #: Pairs of earlier rounds, which no later round compares again.
        self.compared: list[DataFrame] = []
        self._sign()
        self._list()

    def _sign(self) -> None:
        """Size and point of each set, and how common shingles are, in one pass."""
        words = self.words

        def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(CELLS, np.uint32)
            names = ["rep", "n", "point", "token", "seen"]
            waiting: list[np.ndarray] = []

            def row(rep: pa.Array, n: pa.Array, point: pa.Array) -> pa.RecordBatch:
                none = pa.nulls(len(n), pa.int64())
                return pa.RecordBatch.from_arrays([rep, n, point, none, none], names)

            def told() -> pa.RecordBatch:
                token, count = repeated(np.concatenate(waiting))
                waiting.clear()
                none = [pa.nulls(len(token), t) for t in (pa.int64(), pa.int32(), pa.binary())]
                return pa.RecordBatch.from_arrays(
                    [*none, pa.array(token.view(np.int64)), pa.array(count)], names
                )

            for batch in shared.lean(rows):
                reps, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                for of in batches(texts):
                    hashes, n = shingle_sets(texts[of.start : of.stop], words)
                    np.add.at(counts, hashes >> np.uint64(46), 1)
                    yield row(
                        pa.array(reps[of.start : of.stop]), pa.array(n, pa.int32()),
                        pa.array(group_points(hashes, n), pa.binary()),
                    )
                    waiting.append(hashes)
                    if sum(map(len, waiting)) >= COUNTED:
                        yield told()
            if waiting:
                yield told()
            chunks = counts.astype("<u8").reshape(-1, CELL_CHUNK)
            yield row(
                pa.nulls(len(chunks), pa.int64()),
                pa.array(range(len(chunks)), pa.int32()),
                pa.array([c.tobytes() for c in chunks]),
            )

        signed = shared.staged(
            self.reps.select("rep", "text").mapInArrow(
                sign, "rep long, n int, point binary, token long, seen long"
            ),
            "points",
        )
        self.points = signed.where("rep is not null").select("rep", "n", "point")
        cells = signed.where("rep is null and token is null").select(
            F.col("n").alias("chunk"), F.col("point")
        )
        found = shared.merged(cells, "<u8", np.add)
        counts = np.zeros((CELLS // CELL_CHUNK, CELL_CHUNK), np.uint64)
        for chunk, part in found.items():
            counts[chunk] = part
        # Levels are bit lengths of counts: as many of the highest as COMMON has room for.
        seen = shared.staged(
            signed.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
            .withColumn("level", F.length(F.bin("seen"))),
            "common",
        )
        least, room = 64, COMMON
        levels = {r["level"]: r["count"] for r in seen.groupBy("level").count().collect()}
        for level in sorted(levels, reverse=True):
            room -= levels[level]
            if room < 0:
                break
            least = level
        found = seen.where(F.col("level") >= least).select("token", "seen").toArrow()
        token, count = (found.column(k).to_numpy() for k in ("token", "seen"))
        shared.dropped(seen)
        # A number for each cell and at most COMMON shingles, whatever the number of documents.
        self.common = self.spark.sparkContext.broadcast(
            Order(counts.ravel(), token.view(np.uint64), count)
        )

    def _list(self) -> None:
        """Lists of the sets that share one of their leading shingles."""
        words, percent, common = self.words, self.percent, self.common
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = 4 * partitions

        def salts(tokens: np.ndarray, reps: np.ndarray) -> np.ndarray:
            """Which of a heavy cell's shares a set belongs to; 0 in all other cells."""
            shares = common.value.split(tokens)
            return np.where(shares > 1, mixed(reps.astype(np.uint64) ^ tokens) % shares, 0)

        def lead(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, np.ndarray]] = []
            count = 0

            def flush() -> pa.RecordBatch:
                tokens = np.concatenate([h[0] for h in held])
                reps = np.concatenate([h[1] for h in held])
                salt = salts(tokens, reps).astype(np.uint64)
                bucket = (mixed(tokens + salt) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                tokens, reps, bucket = tokens[order], reps[order], bucket[order]
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.r_[at[1:], len(bucket)]
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[at], pa.int32()),
                        pa.array([tokens[a:b].tobytes() for a, b in zip(at, ends)]),
                        pa.array([reps[a:b].tobytes() for a, b in zip(at, ends)]),
                    ],
                    ["bucket", "tokens", "reps"],
                )

            for batch in shared.lean(rows):
                reps, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                for of in batches(texts):
                    hashes, n = shingle_sets(texts[of.start : of.stop], words)
                    order = common.value.ranked(hashes)
                    most = prefix_sizes(n, percent)
                    ends = np.cumsum(n)
                    chosen = [
                        a + np.argsort(order[a:b], kind="stable")[:m]
                        for a, b, m in zip((ends - n).tolist(), ends.tolist(), most.tolist())
                    ]
                    tokens = hashes[np.concatenate(chosen)] if chosen else hashes[:0]
                    held.append((tokens, np.repeat(reps[of.start : of.stop], most)))
                    count += len(tokens)
                    if count >= 1 << 20:
                        yield flush()
                        held, count = [], 0
            if count:
                yield flush()

        def lists(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, held = None, []
            for batch in rows:
                for item in zip(*(c.to_pylist() for c in batch.columns)):
                    if item[0] != bucket and held:
                        yield bucket_lists(held)
                        held = []
                    bucket = item[0]
                    held.append(item[1:])
            if held:
                yield bucket_lists(held)

        def bucket_lists(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
            tokens = np.frombuffer(b"".join(h[0] for h in held), "<u8")
            reps = np.frombuffer(b"".join(h[1] for h in held), "<i8")
            salt = salts(tokens, reps)
            # Members in an order that differs between lists, so parts of lists overlap.
            order = np.lexsort((mixed(reps.astype(np.uint64) ^ tokens), salt, tokens))
            tokens, reps, salt = tokens[order], reps[order], salt[order]
            new = np.r_[True, (tokens[1:] != tokens[:-1]) | (salt[1:] != salt[:-1])]
            at = np.flatnonzero(new)
            size = np.diff(np.r_[at, len(tokens)])
            shares = common.value.split(tokens[at])
            several = (shares > 1) | (size > PART)
            # Lists of the same members have one name, whatever their shingle.
            members = np.add.reduceat(mixed(reps.astype(np.uint64)), at) + size.astype(np.uint64)
            name = np.where(several, mixed(tokens[at]), mixed(members))
            keep = np.flatnonzero((size > 1) | (shares > 1))
            _, once = np.unique(
                np.stack([name[keep], salt[at][keep].astype(np.uint64)]), axis=1, return_index=True
            )
            keep = keep[once]
            starts, ends, parts, which = [], [], [], []
            for k in keep.tolist():
                cuts = range(at[k], at[k] + size[k], PART)
                starts += cuts
                ends += [min(c + PART, at[k] + size[k]) for c in cuts]
                parts += [(int(salt[at[k]]) << 20) + p for p in range(len(cuts))]
                which += [k] * len(cuts)
            offsets = np.cumsum(np.r_[0, np.array(ends, int) - np.array(starts, int)])
            values = np.concatenate([reps[:0], *(reps[a:b] for a, b in zip(starts, ends))])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(name[which].view(np.int64) if which else [], pa.int64()),
                    pa.array(parts, pa.int64()),
                    pa.array(several[which] if which else [], pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                ],
                ["list", "part", "several", "members"],
            )

        posted = self.reps.select("rep", "text").mapInArrow(
            lead, "bucket int, tokens binary, reps binary"
        )
        found = shared.spread(posted, "bucket").sortWithinPartitions("bucket").mapInArrow(
            lists, "list long, part long, several boolean, members array<long>"
        )
        self.lists = shared.staged(found.dropDuplicates(["list", "part"]), "lists")

    def first_units(self) -> DataFrame:
        chosen = self.lists.where(F.pmod("list", F.lit(FIRST_ROUND)) == 0)
        member = chosen.select(
            "list", "part", F.col("part").alias("other"), F.lit(0).alias("side"),
            F.explode("members").alias("rep"),
        ).withColumn("root", F.col("rep"))
        return member.join(self.points, "rep").select(UNIT)

    def later_units(self, roots: DataFrame) -> DataFrame:
        """Lists, or pairs of parts of long lists, whose sets are not all one class yet."""
        member = (
            self.lists.select("list", "part", "several", F.explode("members").alias("rep"))
            .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("root", F.coalesce("root", "rep"))
        )
        spans = shared.staged(
            member.groupBy("list", "part", "several").agg(
                F.min("root").alias("low"), F.max("root").alias("high")
            ),
            "spans",
        )
        single = spans.where("not several and low <> high").select(
            "list", "part", F.col("part").alias("other")
        )
        long = spans.where("several")
        others = long.select(
            "list", F.col("part").alias("other"), F.col("low").alias("low2"),
            F.col("high").alias("high2"),
        )
        pairs = long.join(others, "list").where(
            "part <= other and (low <> high or low2 <> high2 or low <> low2)"
        ).select("list", "part", "other")
        units = single.union(pairs)
        own = member.join(units, ["list", "part"]).withColumn("side", F.lit(0))
        across = (
            member.withColumnRenamed("part", "other")
            .join(units.where("part <> other"), ["list", "other"])
            .withColumn("side", F.lit(1))
        )
        columns = ["list", "part", "other", "side", "rep", "root"]
        rows = shared.staged(own.select(columns).union(across.select(columns)), "units")
        # Every list that two sets of different classes share is a unit, so one of them is first.
        first = rows.groupBy("rep").agg(
            F.slice(F.array_sort(F.collect_set("list")), 1, FIRST_LISTS).alias("first")
        )
        sets = self.points.join(first, "rep")
        return rows.join(sets, "rep").select(*UNIT, "first")

    def links(self, units: DataFrame, emits: str) -> DataFrame:
        """Pairs of similar sets among the units, each compared in full."""
        kernel = _pairs_of_units(self.percent, emits)
        ordered = shared.spread(units, "list", "part", "other").sortWithinPartitions(
            "list", "part", "other", "side", "rep"
        )
        found = ordered.mapInArrow(kernel, "a long, b long").distinct()
        for done in self.compared:
            found = found.join(done, ["a", "b"], "left_anti")
        pairs = shared.staged(found, "possible")
        self.compared.append(pairs)
        sets = self._sets(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")))

        def compared(pairs: DataFrame, column: str, kernel: Callable, name: str) -> DataFrame:
            both = pairs.join(
                sets.select(F.col("rep").alias("a"), F.col(column).alias("of_a")), "a"
            ).join(sets.select(F.col("rep").alias("b"), F.col(column).alias("of_b")), "b")
            rows = both.select("a", "b", "of_a", "of_b")
            return shared.staged(rows.mapInArrow(kernel, "a long, b long"), name)

        # Fine points are an eighth of the sets and leave hardly a pair that is not similar.
        likely = compared(pairs, "fine", _finer(self.percent), "likely")
        similar = compared(likely, "shingles", _verify(self.percent), "similar")
        for table in (likely, sets):
            shared.dropped(table)
        return similar

    def _sets(self, wanted: DataFrame) -> DataFrame:
        """Shingles of the wanted sets, and of a few others that the filter lets through."""
        words, chunk = self.words, 1 << 19

        def bits_of(reps: np.ndarray) -> np.ndarray:
            return (mixed(reps.astype(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)

        def marked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(FILTER_BITS, bool)
            for batch in rows:
                bits[bits_of(batch.column(0).to_numpy())] = True
            parts = np.packbits(bits).reshape(-1, chunk // 8)
            some = np.flatnonzero(parts.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some])],
                ["chunk", "cells"],
            )

        found = shared.merged(wanted.mapInArrow(marked, shared.CHUNK_ROWS), "u1", np.bitwise_or)
        bits = np.zeros((FILTER_BITS // chunk, chunk // 8), np.uint8)
        for k, part in found.items():
            bits[k] = part
        # FILTER_BITS bits, whatever the number of documents.
        held = self.spark.sparkContext.broadcast(bits.tobytes())

        def sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.unpackbits(np.frombuffer(held.value, np.uint8)).view(bool)
            for batch in shared.lean(rows):
                some = batch.filter(pa.array(bits[bits_of(batch.column(0).to_numpy())]))
                reps, texts = some.column(0).to_numpy(), some.column(1).to_pylist()
                for of in batches(texts):
                    hashes, n = shingle_sets(texts[of.start : of.stop], words)
                    own = [hashes[b - m : b] for b, m in zip(np.cumsum(n), n)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reps[of.start : of.stop]),
                            pa.array([fine_point(x) for x in own], pa.binary()),
                            pa.array([x.tobytes() for x in own], pa.binary()),
                        ],
                        ["rep", "fine", "shingles"],
                    )

        return shared.staged(
            self.reps.select("rep", "text").mapInArrow(
                sets, "rep long, fine binary, shingles binary"
            ),
            "sets",
        )

    def answer(self, roots: DataFrame) -> DataFrame:
        classes = (
            self.reps.select("k1", "k2", "doc_id", "rep")
            .join(self.points.select("rep", "n"), "rep")
            .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("root", F.coalesce("root", "rep"))
        )
        least = classes.groupBy("root").agg(F.min("doc_id").alias("least"))
        named = classes.join(least, "root").select("k1", "k2", "n", "least")
        found = self.keyed.drop("text").join(named, ["k1", "k2"], "left")
        size = F.coalesce(F.col("n").cast("long"), F.lit(0).cast("long"))
        return found.select(
            "doc_id", size.alias("n_shingles"),
            F.when(size > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        )


def fine_point(hashes: np.ndarray) -> bytes:
    """Counts of a set in about as many groups as it has shingles, a power of two.

    Counts stop at 255, which no bound may rely on: a set with more in a group has no point.
    """
    groups = 1 << max(0, int(len(hashes) - 1).bit_length())
    counts = np.bincount((hashes % np.uint64(groups)).astype(np.int64), minlength=groups)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _finer(percent: int) -> Callable:
    """Keeps the pairs whose fine points can belong to similar sets."""

    def finer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yes = np.ones(batch.num_rows, bool)
            for k, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(s.as_py(), np.uint8) for s in (a, b))
                if not len(x) or not len(y):
                    continue
                # The finer of the two folds to the groups of the other.
                groups = min(len(x), len(y))
                x, y = (v.reshape(-1, groups).sum(axis=0, dtype=np.int64) for v in (x, y))
                yes[k] = possible(x.sum(), y.sum(), np.minimum(x, y).sum(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(yes))

    return finer


def _verify(percent: int) -> Callable:
    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yes = np.zeros(batch.num_rows, bool)
            for k, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(s.as_py(), "<u8") for s in (a, b))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                yes[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(yes))

    return verify


def link_documents(
    docs: DataFrame, words: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id of its class).

    Two documents link when 100 * shared shingles >= percent * all shingles of both. Copies
    of one text are one set. A sixteenth of the lists gives the first links, a few for each
    set. In all lists, then, only sets of different classes are compared: first the likeliest
    pair of each two classes, and after those have joined all pairs between classes. So a
    large group of near copies costs no comparison of all its pairs, and no pair of sets in
    different classes is left out: what the bound does not exclude is compared in full.

    Documents without text or words have no shingles and link with nothing. Texts of fewer
    words than a shingle are one shingle. Repeated rows are copies. Null ids stay null and
    name no class that has a known id. An empty table gives no rows. Other columns are not read.
    """
    join = Join(docs, words, percent, key, text)
    links = join.links(join.first_units(), LEAVES)
    roots = shared.staged(components(links), "classes")
    for emits in (CLASSES, ALL):
        links = join.links(join.later_units(roots), emits)
        if links.isEmpty():
            continue
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = shared.staged(components(known.union(links)), "classes")
    for table in (join.lists, *join.compared):
        shared.dropped(table)
    return join.answer(roots)
