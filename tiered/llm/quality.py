"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tiered.llm import shared

#: The decision threshold of the returned score.
ACCEPT = 0.7
#: Preference pairs in memory at a time.
BLOCK = 4096
#: Distance of the places of scores at which texts are summed, and the places next to a score
#: that stand for it.
STEP = 1 / 8
NODES = 8
#: Texts whose features are in memory at a time.
RUN = 512
#: Steps in which scores are counted for the cut.
STEPS = 1 << 16
_CLASSES = {
    "upper": r"[A-ZÀ-Þ]", "lower": r"[a-zß-ɏ]", "digit": r"[0-9]",
    "stop": r"[.!?]", "comma": r"[,;:]", "bang": r"!", "sign": r"[#$%&*|~^<>{}\[\]\\/=+_@]",
    "wide": r"[^\x00-\x7f]",
}
_SENTENCE = re.compile(r"[.!?]+\s")
FEATURES = [
    "chars", "words", "word_mean", "word_spread", "short_words", "long_words", "distinct",
    "top_word", "top_ten", "same_next", "longest_run", "pairs_distinct", "top_pair",
    "lines", "line_mean", "lines_again", "short_lines", "sentences", "packed",
    "capital_words", "upper_words", "signed_words", "numbers",
    *(f"share_{k}" for k in _CLASSES),
]
_BYTE_CLASS = {
    k: np.array([bool(re.match(p, chr(c))) for c in range(0x250)]) for k, p in _CLASSES.items()
}


def features(text: str | None) -> np.ndarray:
    """Numbers that describe the shape of a whole text; an empty text has zeros."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = np.minimum(codes, 0x24F)
    held = np.bincount(letters, minlength=0x250)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, n - 1)
    breaks = np.flatnonzero(np.r_[True, ~same, True])
    lines = [line for line in text.split("\n") if line.strip()]
    top = [c for _, c in counts.most_common(10)]
    data = text.encode("utf-8", "surrogatepass")
    starts = [w[0] for w in words]
    values = [
        np.log1p(len(text)), np.log1p(n), lengths.mean(), lengths.std(),
        (lengths <= 2).mean(), (lengths >= 12).mean(),
        len(counts) / n ** 0.8, top[0] / n, sum(top) / n,
        same.mean() if n > 1 else 0.0, np.log1p(np.diff(breaks).max()),
        len(pairs) / max(1, n - 1), max(pairs.values(), default=0) / n,
        np.log1p(len(lines)), np.log1p(len(text) / len(lines)),
        1 - len(set(lines)) / len(lines), sum(len(x) < 20 for x in lines) / len(lines),
        np.log1p(n / (1 + len(_SENTENCE.findall(text)))),
        len(zlib.compress(data, 1)) / len(data),
        sum(c.isupper() for c in starts) / n, sum(w.isupper() for w in words) / n,
        sum(not (c.isalnum()) for c in (w[-1] for w in words)) / n,
        sum(c.isdigit() for c in starts) / n,
    ]
    values += [held[table].sum() / len(codes) for table in _BYTE_CLASS.values()]
    return np.array(values, float)


class Model:
    """Weights over standardised features with their squares, and the calibrated cut."""

    def __init__(
        self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float, slope: float
    ) -> None:
        self.mean, self.scale, self.weights = mean, scale, weights
        self.cut, self.slope = cut, slope

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the learned score, and ACCEPT at the cut."""
        worth = design(x, self.mean, self.scale) @ self.weights
        odds = np.log(ACCEPT / (1 - ACCEPT)) + self.slope * (worth - self.cut)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate([z, np.minimum(z * z, 9), np.abs(z) > 2.5], axis=1)


def bradley_terry(
    z: np.ndarray, good: np.ndarray, bad: np.ndarray, l2: float, rounds: int = 40
) -> np.ndarray:
    """Weights w that make sigmoid(w . (z[good] - z[bad])) likely, by Newton steps.

    BLOCK pairs are in memory at a time.
    """
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        gradient, hessian = l2 * w, l2 * np.eye(len(w))
        for a in range(0, len(good), BLOCK):
            d = z[good[a : a + BLOCK]] - z[bad[a : a + BLOCK]]
            p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))
            gradient += d.T @ (p - 1)
            hessian += (d * (p * (1 - p))[:, None]).T @ d
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def around(worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The NODES places next to each score, and what the score gives to each of them.

    A smooth function of a score is the sum of its values at the places by these shares.
    """
    below = np.floor(worth / STEP).astype(np.int64)
    offset = worth / STEP - below
    near = np.arange(NODES) - (NODES // 2 - 1)
    shares = np.ones((len(worth), NODES))
    for k, a in enumerate(near):
        for b in near[near != a]:
            shares[:, k] *= (offset - b) / (a - b)
    return below[:, None] + near, shares


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and features of bounded runs of rows (y, x)."""
    for batch in shared.lean(batches):
        y = batch.column(0).to_numpy()
        x = batch.column(1).flatten().to_numpy().reshape(len(y), -1)
        for a in range(0, len(y), RUN):
            yield y[a : a + RUN], x[a : a + RUN]


def _summed(texts: DataFrame, parts: Callable) -> dict[int, np.ndarray]:
    """Adds up what `parts(y, x)` yields of each run of rows: a number and an array of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for y, x in _rows(batches):
            for chunk, cells in parts(y, x):
                whole[chunk] = whole[chunk] + cells if chunk in whole else cells
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(whole, pa.int32()), pa.array([w.tobytes() for w in whole.values()], pa.binary()),
                pa.array([task] * len(whole), pa.int32()),
            ],
            ["chunk", "cells", "task"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(cells)
                whole[chunk] = whole[chunk] + part if chunk in whole else part
        if whole:
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole, pa.int32()), pa.array([w.tobytes() for w in whole.values()])],
                ["chunk", "cells"],
            )

    # Added in the order of the tasks, so that equal runs give equal sums.
    found = shared.spread(
        texts.select("y", "x").mapInArrow(run, "chunk int, cells binary, task int"), "chunk"
    ).sortWithinPartitions("chunk", "task").mapInArrow(add, shared.CHUNK_ROWS).collect()
    return {r["chunk"]: np.frombuffer(r["cells"]) for r in found}


class Sums:
    """Of each label, at the places that scores by some weights meet: texts, and their sums of z."""

    def __init__(self, texts: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> None:
        def parts(y: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            z = design(x, mean, scale)
            places, shares = around(z @ w)
            for label in (0, 1):
                mine = np.flatnonzero(y == label)
                met, at = np.unique(places[mine], return_inverse=True)
                given = np.zeros((len(mine), len(met)))
                given[np.arange(len(mine))[:, None], at.reshape(-1, NODES)] = shares[mine]
                sums = given.T @ np.column_stack([np.ones(len(mine)), z[mine]])
                yield from zip((2 * met + label).tolist(), sums)

        found = _summed(texts, parts)
        order = sorted(found)
        self.bad, self.good = (np.array([k // 2 for k in order if k % 2 == y]) for y in (0, 1))
        bad, good = (np.array([found[k] for k in order if k % 2 == y]) for y in (0, 1))
        self.n_bad, self.z_bad = bad[:, 0], bad[:, 1:]
        self.n_good, self.z_good = good[:, 0], good[:, 1:]

    def pairs(self) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Over all pairs: loss, gradient, and of the Hessian what pairs of texts give, and the
        weight of each good and of each bad text's own square, at the places."""
        loss, width = 0.0, self.z_bad.shape[1]
        gradient, cross = np.zeros(width), np.zeros((width, width))
        own_good, own_bad = np.zeros(len(self.good)), np.zeros(len(self.bad))
        for a in range(0, len(self.good), RUN):
            of = slice(a, a + RUN)
            gap = STEP * (self.bad - self.good[of, None])
            p = 1 / (1 + np.exp(-np.clip(gap, -500, 500)))
            q = p * (1 - p)
            loss += self.n_good[of] @ np.logaddexp(0, gap) @ self.n_bad
            gradient += (self.n_good[of] @ p) @ self.z_bad - (p @ self.n_bad) @ self.z_good[of]
            cross += self.z_good[of].T @ (q @ self.z_bad)
            own_good[of] = q @ self.n_bad
            own_bad += self.n_good[of] @ q
        return float(loss), gradient, cross, own_good, own_bad


def all_pairs(
    texts: DataFrame, mean: np.ndarray, scale: np.ndarray, weight: float, l2: float, rounds: int = 40
) -> np.ndarray:
    """What `bradley_terry` gives for all pairs of a good and a bad text, each of some weight.

    A pair counts by the gap of two scores alone, so the texts of a label are summed at places
    of the scores, from which sums over pairs follow (to about nine digits). A round is two
    passes; a step that raises the loss is halved.
    """
    w = np.zeros(3 * len(mean))
    sums = Sums(texts, mean, scale, w)
    loss, gradient, *curve = sums.pairs()
    for _ in range(rounds):
        cross, *own = curve
        places = np.append(2 * sums.bad, 2 * sums.good + 1)
        order = np.argsort(places)
        places, own = places[order], np.append(own[1], own[0])[order]

        def squares(
            y: np.ndarray, x: np.ndarray, w: np.ndarray = w, places: np.ndarray = places,
            own: np.ndarray = own,
        ) -> Iterator[tuple[int, np.ndarray]]:
            z = design(x, mean, scale)
            at, shares = around(z @ w)
            each = (own[np.searchsorted(places, 2 * at + y[:, None])] * shares).sum(1)
            yield 0, ((z * each[:, None]).T @ z).ravel()

        square = _summed(texts, squares)[0].reshape(len(w), len(w))
        hessian = weight * (square - cross - cross.T) + l2 * np.eye(len(w))
        step = np.linalg.solve(hessian, weight * gradient + l2 * w)
        before = weight * loss + l2 / 2 * w @ w
        while np.abs(step).max() >= 1e-6:
            sums = Sums(texts, mean, scale, w - step)
            loss, gradient, *curve = sums.pairs()
            after = weight * loss + l2 / 2 * (w - step) @ (w - step)
            if after <= before + 1e-9 * abs(before):
                break
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learned(texts: DataFrame, share_bad: float, pairs: int, l2: float) -> Model | None:
    """Fits the model on rows (y, x) of all texts; `share_bad` is that of all labelled rows.

    All pairs together weigh as `pairs` of them against `l2`. None without rows.
    """
    found = _summed(
        texts, lambda y, x: [(k, np.append((y == k).sum(), x[y == k].sum(0))) for k in (0, 1)]
    )
    if not found:
        return None
    size = found[0][0], found[1][0]
    mean = (found[0][1:] + found[1][1:]) / sum(size)
    scale = np.sqrt(_summed(texts, lambda y, x: [(0, ((x - mean) ** 2).sum(0))])[0] / sum(size))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if not all(size):
        # One class only: every text scores as that class.
        return Model(mean, scale, np.zeros(3 * len(mean)), -9.0 if size[1] else 9.0, 1.0)
    w = all_pairs(texts, mean, scale, pairs / (size[0] * size[1]), l2)

    # Scores are counted in steps between the least and the largest.
    ends = _summed(texts, lambda y, x: _ends(design(x, mean, scale) @ w))
    low, high = (STEP * f(ends) for f in (min, max))
    step = (high + STEP - low) / STEPS

    def counts(y: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        at = ((design(x, mean, scale) @ w - low) / step).astype(np.int64)
        for label in (0, 1):
            yield label, np.bincount(at[y == label], minlength=STEPS).astype(float)

    held = _summed(texts, counts)
    worth = np.tile(low + step * (np.arange(STEPS) + 0.5), 2)
    y = np.repeat([0, 1], STEPS)
    # The score below which the share of bad rows lies, classes weighted as in all rows.
    weight = np.append(held[0] * share_bad / size[0], held[1] * (1 - share_bad) / size[1])
    worth, y, weight = (v[weight > 0] for v in (worth, y, weight))
    order = np.argsort(worth, kind="stable")
    reached = np.searchsorted(np.cumsum(weight[order]), share_bad - 1e-12)
    # The end of that step: the texts in it lie below.
    cut = float(worth[order][min(reached, len(order) - 1)] + step / 2)
    base = np.log(ACCEPT / (1 - ACCEPT))
    slopes = np.geomspace(0.05, 20, 60)
    fit = [
        (weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (base + s * (worth - cut)))).sum()
        for s in slopes
    ]
    return Model(mean, scale, w, cut, float(slopes[int(np.argmin(fit))]))


def _ends(worth: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places below the least and the largest score."""
    for place in {int(np.floor(worth.min() / STEP)), int(np.floor(worth.max() / STEP))}:
        yield place, np.zeros(1)


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int | None = None, pairs: int = 60_000,
    l2: float = 10.0, key: str = "doc_id", text: str = "text", label: str = "quality",
) -> Model:
    """Learns from all labelled documents.

    Features are taken where the texts lie; one short row a text is shuffled and stored, and
    read by every pass. Preferences are all pairs of a good and a bad text; together they weigh
    as `pairs` of them against `l2`. Labels other than 0 and 1, null labels and keys, and labels
    of unknown documents are left out; repeated labels count as often as they stand in the
    shares of the labels and once beside a text. Without labels all texts are accepted.
    `per_class` is for callers who want less: that many texts of each label, those of the
    smallest hashes.
    """
    # A key hashes alike on both sides only as one type.
    kind = docs.select(key).union(labels.select(key)).schema[0].dataType
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).cast(kind).alias("key"), F.col(label).cast("int").alias("y")
    )
    sizes = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    whole = sizes.get(0, 0) + sizes.get(1, 0)
    share_bad = sizes.get(0, 0) / whole if whole else 0.0
    marks = marks.distinct()
    if per_class is not None:
        first = Window.partitionBy("y").orderBy(F.xxhash64("key"), "key")
        marks = marks.withColumn("rank", F.row_number().over(first)).where(
            F.col("rank") <= per_class
        ).select("key", "y")
    wanted = shared.may_have(marks.select(F.xxhash64("key")))
    rows = docs.select(
        F.col(key).cast(kind).alias("key"), F.xxhash64(F.col(key).cast(kind), text).alias("draw"),
        F.col(text).alias("text"),
    ).where(F.col("key").isNotNull()).where(wanted(F.xxhash64("key")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.lean(batches):
            found = [features(t.as_py()).tolist() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))],
                ["key", "draw", "x"],
            )

    schema = StructType(
        [
            StructField("key", kind), StructField("draw", LongType()),
            StructField("x", ArrayType(DoubleType())),
        ]
    )
    met = rows.mapInArrow(measure, schema).join(marks, "key").select("y", "draw", "x")
    if per_class is not None:
        again = Window.partitionBy("y").orderBy("draw")
        met = met.withColumn("rank", F.row_number().over(again)).where(
            F.col("rank") <= per_class
        ).drop("rank")
    texts = shared.staged(shared.spread(met, "draw").sortWithinPartitions("draw", "y"), "features")
    model = learned(texts, share_bad, pairs, l2)
    shared.dropped(texts)
    if model is None:
        zero = np.zeros(len(FEATURES))
        return Model(zero, zero + 1, np.zeros(3 * len(FEATURES)), -9.0, 1.0)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` and score (0 to 1), predicted (1 from ACCEPT on).

    Null, empty and blank texts have the features of no words and a score like any other
    text. Rows are independent; a clashing column of `docs` is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.lean(batches):
            texts = batch.column(kept.index(text))
            found = np.array([features(t.as_py()) for t in texts]).reshape(-1, len(FEATURES))
            scores = held.value.score(found)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(scores),
                    pa.array((scores >= ACCEPT).astype(np.int32)),
                ],
                [*kept, "score", "predicted"],
            )

    rows = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
