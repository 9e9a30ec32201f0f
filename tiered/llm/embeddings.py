"""Near-duplicate vectors by PCA-ordered tiles with suffix-norm bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiered.llm import shared
from tiered.llm.components import components

#: Bounds are taken this much wider than the threshold, so rounding drops no pair.
SLACK = 1e-9
TILE = (
    "label string, width int, tile long, low double, high double, n int, rows binary, "
    "vectors binary"
)


def usable(vector: str, label: str) -> F.Column:
    """Vectors that can link: a label, no null or non-finite component, and not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & finite & some, F.lit(False))


def basis_of(rows: DataFrame, dims: int) -> np.ndarray:
    """Principal directions of all unit vectors, the strongest first: dims x dims numbers."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    unit = F.transform("vector", lambda x: x / F.sqrt(square))
    padded = F.concat(unit, F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vector")))
    vectors = rows.select(array_to_vector(padded).alias("v"))
    # Spark needs two rows for a covariance; the basis may be any rotation.
    if len(vectors.take(2)) < 2:
        return np.eye(dims)
    model = PCA(k=dims, inputCol="v", outputCol="p").fit(vectors)
    basis = model.pc.toArray()
    whole = np.isfinite(basis).all() and np.allclose(basis.T @ basis, np.eye(dims), atol=1e-8)
    return basis if whole else np.linalg.qr(np.nan_to_num(basis) + np.eye(dims))[0]


def linked(
    a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float,
    same: bool, step: int = 16,
) -> np.ndarray:
    """Which rows of unit vectors `a` and `b` reach the cosine, as a matrix.

    `ra`, `rb` are the same vectors in principal coordinates. Products of leading
    coordinates are summed first; what the rest can add is at most the product of the norms
    of the rest, and a pair is left as soon as that cannot reach the threshold. Pairs that
    stay are decided by the whole product of `a` and `b`.
    """
    dims = ra.shape[1]
    tail_a = np.sqrt(np.cumsum(ra[:, ::-1] ** 2, axis=1)[:, ::-1])
    tail_b = np.sqrt(np.cumsum(rb[:, ::-1] ** 2, axis=1)[:, ::-1])
    least = threshold - SLACK
    at = min(step, dims)
    partial = ra[:, :at] @ rb[:, :at].T
    bound = partial + np.outer(tail_a[:, at], tail_b[:, at]) if at < dims else partial
    alive = bound >= least
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    sums = partial[i, j]
    found = np.zeros(alive.shape, bool)
    for lo in range(0, len(i), 1 << 16):
        ii, jj, s = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)], sums[lo : lo + (1 << 16)]
        for start in range(at, dims, step):
            stop = min(start + step, dims)
            s = s + np.einsum("ij,ij->i", ra[ii, start:stop], rb[jj, start:stop])
            if stop < dims:
                keep = s + tail_a[ii, stop] * tail_b[jj, stop] >= least
                ii, jj, s = ii[keep], jj[keep], s[keep]
        yes = np.einsum("ij,ij->i", a[ii], b[jj]) >= threshold
        found[ii[yes], jj[yes]] = True
    return found


def link_vectors(
    vectors: DataFrame, threshold: float, tile_rows: int = 1024,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row a vector with its links and its class.

    Vectors are compared when labels are equal and not null and lengths are equal. They are
    dealt by range of (label, length, first principal coordinate), so a label of any size is
    spread over tasks, and cut into tiles of `tile_rows`. Pairs of tiles of a label whose
    first coordinates are too far apart for the cosine are never made; each other pair is
    one row of a distributed join, compared in memory that depends on `tile_rows` alone.
    A pair of tiles gives, for each vector, the number of its links and its smallest linked
    class there, at most two rows a vector; no list of links exists.

    Returns vec_id, n_links (other vectors linked directly), component_id (smallest vec_id
    reachable, itself included), kept (vec_id = component_id). Vectors that are null, zero,
    or hold null or non-finite components, and those with a null label, link with nothing.
    Repeated rows are vectors of their own and link. Null ids stay, with the smallest known
    id of their class; alone they have a null class and are kept. An empty table gives no
    rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = shared.staged(
        vectors.select(
            F.col(key).cast("long").alias("vec_id"),
            F.col(label).cast("string").alias("label"),
            F.col(vector).cast("array<double>").alias("vector"),
            usable(vector, label).alias("usable"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    good = rows.where("usable")
    dims = good.agg(F.max(F.size("vector"))).first()[0] or 0
    if not dims:
        return _answer(rows, None, None)
    # dims x dims numbers, whatever the number of vectors.
    basis = spark.sparkContext.broadcast(basis_of(good, dims))
    step = min(16, dims)

    def coordinates(block: np.ndarray) -> np.ndarray:
        return block @ basis.value[: block.shape[1]]

    def unit(block: np.ndarray) -> np.ndarray:
        scaled = block / np.abs(block).max(axis=1, keepdims=True)
        return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)

    def first_coordinate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            first, blobs = np.empty(len(sizes)), [b""] * len(sizes)
            for width in np.unique(sizes):
                of = np.flatnonzero(sizes == width)
                block = flat[(ends[of] - width)[:, None] + np.arange(width)]
                first[of] = coordinates(unit(block))[:, 0]
                for k, line in zip(of, block):
                    blobs[k] = line.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int32()),
                    pa.array(first), pa.array(blobs, pa.binary()),
                ],
                ["row", "label", "width", "first", "blob"],
            )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        group: list[tuple] = []

        def tile() -> pa.RecordBatch:
            nonlocal number
            number += 1
            return pa.RecordBatch.from_pydict(
                {
                    "label": [group[0][1]], "width": pa.array([group[0][2]], pa.int32()),
                    "tile": [number], "low": [group[0][3]], "high": [group[-1][3]],
                    "n": pa.array([len(group)], pa.int32()),
                    "rows": [np.array([g[0] for g in group], "<i8").tobytes()],
                    "vectors": [b"".join(g[4] for g in group)],
                }
            )

        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns)):
                if group and (len(group) == tile_rows or item[1:3] != group[0][1:3]):
                    yield tile()
                    group = []
                group.append(item)
        if group:
            yield tile()

    cut = shared.staged(
        good.select("row", "label", "vector")
        .mapInArrow(
            first_coordinate, "row long, label string, width int, first double, blob binary"
        )
        .repartitionByRange("label", "width", "first", "row")
        .sortWithinPartitions("label", "width", "first", "row")
        .mapInArrow(tiles, TILE),
        "tiles",
    )
    # Unit vectors with this cosine are at most that far apart in any coordinate.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    left = cut.select("label", "width", "low", "high", F.col("tile").alias("left_tile"))
    right = left.select(
        "label", "width", F.col("low").alias("low2"), F.col("high").alias("high2"),
        F.col("left_tile").alias("right_tile"),
    )
    near = (
        left.join(right, ["label", "width"])
        .where("left_tile <= right_tile")
        .where((F.col("low2") - F.col("high") <= reach) & (F.col("low") - F.col("high2") <= reach))
        .select("left_tile", "right_tile", "width")
    )
    side = lambda name: cut.select(
        F.col("tile").alias(f"{name}_tile"), F.col("rows").alias(f"{name}_rows"),
        F.col("vectors").alias(f"{name}_vectors"),
    )
    pairs = near.join(side("left"), "left_tile").join(side("right"), "right_tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                pair = batch.slice(at, 1).to_pylist()[0]
                width, same = pair["width"], pair["left_tile"] == pair["right_tile"]
                blocks = [
                    unit(np.frombuffer(pair[f"{s}_vectors"], "<f8").reshape(-1, width))
                    for s in ("left", "right")
                ]
                a, b = blocks
                hit = linked(a, b, coordinates(a), coordinates(b), threshold, same, step)
                ids = [np.frombuffer(pair[f"{s}_rows"], "<i8") for s in ("left", "right")]
                if same:
                    hit |= hit.T
                    counts, nodes = hit.sum(axis=1), ids[0]
                else:
                    counts = np.concatenate([hit.sum(axis=1), hit.sum(axis=0)])
                    nodes = np.concatenate(ids)
                some = counts > 0
                root = _roots(hit, ids[0], ids[1], same)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes[some]), pa.array(counts[some].astype(np.int64)),
                        pa.array(root[some]),
                    ],
                    ["row", "links", "root"],
                )

    found = shared.staged(
        pairs.mapInArrow(compare, "row long, links long, root long"), "tile-links"
    )
    counts = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    classes = components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    return _answer(rows, counts, classes)


def _roots(hit: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> np.ndarray:
    """The smallest row of each row's class within the two tiles."""
    far = np.iinfo(np.int64).max
    a = left.copy()
    b = a if same else right.copy()
    i, j = np.nonzero(hit)
    while True:
        before = (a.copy(), b.copy())
        np.minimum.at(a, i, b[j])
        np.minimum.at(b, j, a[i])
        if (a == before[0]).all() and (b == before[1]).all():
            return a if same else np.minimum(np.concatenate([a, b]), far)


def _answer(rows: DataFrame, counts: DataFrame | None, classes: DataFrame | None) -> DataFrame:
    ids = rows.select("vec_id", "row")
    if counts is None or classes is None:
        own = ids.withColumn("n_links", F.lit(0).cast("long"))
        own = own.withColumn("component_id", F.col("vec_id"))
    else:
        member = ids.join(counts, "row", "left").join(
            classes.withColumnRenamed("node", "row"), "row", "left"
        )
        member = member.withColumn("root", F.coalesce("root", "row"))
        # Partial minima on the map side: a class of any size is one row a task.
        least = member.groupBy("root").agg(F.min("vec_id").alias("component_id"))
        own = member.join(least, "root").withColumn(
            "n_links", F.coalesce("n_links", F.lit(0).cast("long"))
        )
    return own.select(
        "vec_id", "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
