"""Toxicity scores by a convolutional text classifier over hashed word embeddings.

A word's embedding is the mean of rows of a hashed table: one for the word, one for each
run of SIZES characters of it, its ends included, so words of one stem share rows. Filters
of several widths run over a whole text's embeddings; the maximum of each over the text,
or 0, enters a logistic output. The net is trained in numpy by Adagrad; column 0 of the
table starts as the log odds of a piece between the labels, so that the first filters start
at words that tell. The threshold is calibrated for each language, which is told from the
words of the text alone.
"""

from __future__ import annotations

import io
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tiered.llm import shared
from tiered.llm.shingles import mixed

ACCEPT = 0.5
ROWS = 1 << 16
DEPTH = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
SIZES = (3, 5)
#: Hashed words of the language profiles, and the languages that have one at most.
PROFILE = 1 << 12
LANGUAGES = 64
#: Word places that meet the filters at a time.
STEP = 1 << 16
#: Distinct words whose rows are in memory at a time.
MEET = 20_000
#: Words whose rows a process keeps: the first that it meets, the frequent ones among them.
REMEMBER = 1 << 17
#: Rows of a word that are added for all words at once; few words have more.
USUAL = 64
#: Texts that move one copy of the net in a round, and the rounds, whatever the number of shares.
SHARE = 8192
ROUNDS = 5
#: Rows of the table that travel together.
TABLE_CHUNK = 4096
#: Steps to a unit by which logits are counted, and the logit beyond which all count as equal.
STEPS = 256
LIMIT = 30
_WORD = re.compile(r"\w+")
_OPEN, _CLOSE = "\x02", "\x03"
_TAG = np.random.default_rng(13).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


class Words:
    """Words of texts: `ids` of all, one after another, each text's `count`, and the rows
    (`pieces`, from `first` on) of each distinct word. Word 0 stands for none."""

    def __init__(self, texts: list[str | None]) -> None:
        number = _KNOWN.index.__getitem__
        met = [0]
        self.count = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            found = _WORD.findall(text.lower()) if text else []
            self.count[k] = len(found)
            met += map(number, found)
        every = np.array(met, np.int64)
        # Words are numbered as they come in these texts, whatever a process has met before.
        place = np.full(len(_KNOWN.index), -1)
        place[every[::-1]] = np.arange(len(every))[::-1]
        distinct = every[np.sort(place[place >= 0])]
        place[distinct] = np.arange(len(distinct))
        self.ids = place[every[1:]]
        self.first, self.pieces, self.bucket = _KNOWN.rows(distinct)

    def embedded(self, table: np.ndarray) -> np.ndarray:
        sizes = np.diff(self.first)
        # Words of many rows first: those that have a further row are a prefix.
        order = np.argsort(-sizes, kind="stable")
        means = np.empty((len(sizes), table.shape[1]), np.float32)
        for a in range(0, len(order), MEET):
            of = order[a : a + MEET]
            at, size = self.first[of], sizes[of]
            sums = table.take(self.pieces[at], axis=0)
            further = np.arange(1, min(size[0], USUAL))
            for k, n in zip(further, len(of) - np.searchsorted(size[::-1], further, "right")):
                sums[:n] += table.take(self.pieces[at[:n] + k], axis=0)
            for k in np.flatnonzero(size > USUAL):
                sums[k] += table.take(self.pieces[at[k] + USUAL : at[k] + size[k]], axis=0).sum(0)
            means[of] = sums / size[:, None]
        means[0] = 0
        return means


class Known:
    """Numbers, rows and profile buckets of words; those of the first REMEMBER words are kept."""

    def __init__(self) -> None:
        # A new word has the number of words before it.
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[""]
        self.held = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def rows(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds, table rows and profile bucket of each of some words; numbers that are not
        kept end here."""
        first, pieces, bucket = self.held
        new = list(islice(self.index, len(bucket), None))
        if new:
            parts = [rows_of(new[a : a + MEET]) for a in range(0, len(new), MEET)]
            sizes = [np.diff(first), *(np.diff(p[0]) for p in parts)]
            kept = min(len(self.index), max(REMEMBER, len(bucket)))
            more = kept > len(bucket)
            first = np.append(0, np.cumsum(np.concatenate(sizes)))
            pieces = np.concatenate([pieces, *(p[1] for p in parts)])
            bucket = np.concatenate([bucket, *(p[2] for p in parts)])
            if more:
                self.held = first[: kept + 1].copy(), pieces[: first[kept]].copy(), bucket[:kept].copy()
            while len(self.index) > kept:
                self.index.popitem()
        sizes = np.diff(first)[numbers]
        pieces = pieces.take(np.repeat(first[numbers], sizes) + _counted(sizes))
        return np.append(0, np.cumsum(sizes)), pieces, bucket[numbers]


#: A worker process keeps one: what it holds serves later tasks too.
_KNOWN = Known()


def rows_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds, table rows and profile bucket of each word; every word has a row at least."""
    written = _OPEN + (_CLOSE + _OPEN).join(words) + _CLOSE
    codes = np.frombuffer(written.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - starts[owner]
    letters = mixed(codes * _TAG[0] + place.astype(np.uint64) * _TAG[1])
    whole = mixed(np.add.reduceat(letters, starts))
    hashes, owners = [whole], [np.arange(len(words))]
    for size in SIZES:
        n = len(codes) - size + 1
        if n > 0:
            inside = place[:n] + size <= sizes[owner[:n]]
            run = sum(codes[k : n + k] * _TAG[2 + k] for k in range(size))
            hashes.append(mixed(run[inside]))
            owners.append(owner[:n][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    rows = (np.concatenate(hashes) % np.uint64(ROWS)).astype(np.int32)[order]
    first = np.searchsorted(owner[order], np.arange(len(words) + 1))
    return first, rows, (whole % np.uint64(PROFILE)).astype(np.int32)


class Net:
    """Table, filters, their bias, output weights; Adagrad keeps a sum of squares beside each."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.parts = {"table": draw(ROWS, DEPTH), "out": draw(len(WIDTHS) * FILTERS), "base": np.zeros(1, np.float32)}
        for w in WIDTHS:
            self.parts[f"filter{w}"] = draw(w, DEPTH, FILTERS)
            self.parts[f"bias{w}"] = np.zeros(FILTERS, np.float32)

    def start(self, odds: np.ndarray) -> None:
        self.parts["table"][:, 0] = odds
        for k, w in enumerate(WIDTHS):
            self.parts[f"filter{w}"][:, 0, 0] = 1
            self.parts["out"][k * FILTERS] = 1

    def pooled(self, words: Words, which: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Largest value of each filter in each text (0 at least), its place, and embeddings."""
        texts = len(words.count)
        found = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
        place = np.full(found.shape, -1, np.int64) if which else None
        embedded = words.embedded(self.parts["table"])
        padded, at = _padded(words)
        owner = np.repeat(np.arange(texts), words.count)
        for k, w in enumerate(WIDTHS):
            cut = slice(k * FILTERS, (k + 1) * FILTERS)
            ready = [embedded @ self.parts[f"filter{w}"][j] for j in range(w)]
            for a in range(0, len(at), STEP):
                here = at[a : a + STEP]
                value = ready[0].take(padded[here], axis=0)
                for j in range(1, w):
                    value += ready[j].take(padded[here + j], axis=0)
                value += self.parts[f"bias{w}"]
                who = owner[a : a + STEP]
                edges = np.flatnonzero(np.diff(who, prepend=-1))
                best = np.maximum.reduceat(value, edges, axis=0)
                if which:
                    for edge, end, text, top in zip(edges, [*edges[1:], len(who)], who[edges], best):
                        better = top > found[text, cut]
                        spot = here[edge + value[edge:end].argmax(0)]
                        place[text, cut] = np.where(better, spot, place[text, cut])
                found[who[edges], cut] = np.maximum(found[who[edges], cut], best)
        return found, place, embedded

    def logits(self, words: Words) -> np.ndarray:
        return self.pooled(words)[0] @ self.parts["out"] + self.parts["base"][0]

    def gradient(
        self, words: Words, y: np.ndarray, weight: np.ndarray | float = 1.0
    ) -> dict[str, np.ndarray | tuple]:
        """Gradient of the mean logistic loss; that of the table as rows and their values."""
        found, place, embedded = self.pooled(words, True)
        logit = found @ self.parts["out"] + self.parts["base"][0]
        error = ((1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * weight / len(y)).astype(np.float32)
        steps = {"out": found.T @ error, "base": np.array([error.sum()], np.float32)}
        back = error[:, None] * self.parts["out"]
        padded, _ = _padded(words)
        to_words = np.zeros_like(embedded)
        for k, w in enumerate(WIDTHS):
            cut = slice(k * FILTERS, (k + 1) * FILTERS)
            text, column = np.nonzero(place[:, cut] >= 0)
            spot, g = place[:, cut][text, column], back[:, cut][text, column]
            steps[f"bias{w}"] = np.bincount(column, g, FILTERS).astype(np.float32)
            steps[f"filter{w}"] = np.zeros_like(self.parts[f"filter{w}"])
            for j in range(w):
                ids = padded[spot + j]
                np.add.at(steps[f"filter{w}"][j].T, column, embedded[ids] * g[:, None])
                np.add.at(to_words, ids, self.parts[f"filter{w}"][j].T[column] * g[:, None])
        to_words[0] = 0
        moved = np.flatnonzero(np.abs(to_words).sum(1))
        sizes = np.diff(words.first)[moved]
        flat = np.repeat(words.first[moved], sizes) + _counted(sizes)
        rows, inverse = np.unique(words.pieces[flat], return_inverse=True)
        values = np.empty((len(rows), DEPTH), np.float32)
        owner = np.repeat(np.arange(len(moved)), sizes)
        for k, column in enumerate((to_words[moved] / sizes[:, None]).T):
            values[:, k] = np.bincount(inverse, column.take(owner), len(rows))
        steps["table"] = (rows, values)
        return steps


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _padded(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the widest filter's overhang of word 0 after each text, and the words' places."""
    gap = max(WIDTHS) - 1
    at = np.arange(len(words.ids)) + gap * np.repeat(np.arange(len(words.count)), words.count)
    padded = np.zeros(len(words.ids) + gap * len(words.count), np.int64)
    padded[at] = words.ids
    return padded, at


def _only(words: Words, texts: np.ndarray) -> Words:
    """Some of the texts, with the distinct words that they have."""
    part = object.__new__(Words)
    ends = np.cumsum(words.count)
    part.count = words.count[texts]
    ids = words.ids[np.repeat(ends[texts] - part.count, part.count) + _counted(part.count)]
    kept, part.ids = np.unique(np.append(ids, 0), return_inverse=True)
    part.ids = part.ids[:-1]
    sizes = np.diff(words.first)[kept]
    part.pieces = words.pieces[np.repeat(words.first[kept], sizes) + _counted(sizes)]
    part.first = np.append(0, np.cumsum(sizes))
    part.bucket = words.bucket[kept]
    return part


def _pieces_of_texts(words: Words) -> Iterator[np.ndarray]:
    """The distinct rows that each text holds."""
    sizes = np.diff(words.first)
    ends = np.cumsum(words.count)
    for a, b in zip(ends - words.count, ends):
        ids = np.unique(words.ids[a:b])
        flat = np.repeat(words.first[ids], sizes[ids]) + _counted(sizes[ids])
        hit = np.zeros(ROWS, bool)
        hit[words.pieces[flat]] = True
        yield np.flatnonzero(hit)


class Learner:
    """A net that learns by Adagrad, and what it has moved since it began."""

    def __init__(self, parts: dict[str, np.ndarray], squares: dict[str, np.ndarray], seed: int) -> None:
        self.began, self.squared = parts, squares
        self.net = Net()
        self.net.parts = {k: p.copy() for k, p in parts.items()}
        self.squares = {k: p.copy() for k, p in squares.items()}
        self.rng = np.random.default_rng(seed)

    def learn(
        self, words: Words, y: np.ndarray, weight: np.ndarray, batch: int = 64, rate: float = 0.1,
        hide: float = 0.3,
    ) -> None:
        """One pass over some texts; it hides a share of the words, so that no single one has to tell."""
        order = self.rng.permutation(len(y))
        for pick in np.array_split(order, max(1, round(len(order) / batch))):
            part = _only(words, pick)
            part.ids[self.rng.random(len(part.ids)) < hide] = 0
            for name, step in self.net.gradient(part, y[pick], weight[pick]).items():
                own, square = self.net.parts[name], self.squares[name]
                if name == "table":
                    rows, step = step
                    square[rows] += step * step
                    own[rows] -= rate * step / np.sqrt(square[rows])
                else:
                    square += step * step
                    own -= rate * step / np.sqrt(square)

    def moved(self) -> Iterator[tuple[int, bytes]]:
        """Chunks of the table (moves, growth of the squares, whether a row moved), then the rest."""
        step = self.net.parts["table"] - self.began["table"]
        grown = self.squares["table"] - self.squared["table"]
        hit = grown.any(axis=1).astype(np.float32)
        for k, a in enumerate(range(0, ROWS, TABLE_CHUNK)):
            of = slice(a, a + TABLE_CHUNK)
            yield k, np.concatenate([step[of].ravel(), grown[of].ravel(), hit[of]]).tobytes()
        small = [n for n in self.began if n != "table"]
        rest = [(self.net.parts[n] - self.began[n]).ravel() for n in small]
        rest += [(self.squares[n] - self.squared[n]).ravel() for n in small]
        yield ROWS // TABLE_CHUNK, np.concatenate([*rest, np.ones(1, np.float32)]).tobytes()


def averaged(
    parts: dict[str, np.ndarray], squares: dict[str, np.ndarray], sums: dict[int, np.ndarray]
) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Parts and squares after the mean move of the shares; a row's is that of those that moved it."""
    parts, squares = ({k: p.copy() for k, p in x.items()} for x in (parts, squares))
    cells = TABLE_CHUNK * DEPTH
    for k in range(ROWS // TABLE_CHUNK):
        if k in sums:
            of = slice(k * TABLE_CHUNK, (k + 1) * TABLE_CHUNK)
            by = np.maximum(sums[k][2 * cells :], 1)[:, None]
            parts["table"][of] += (sums[k][:cells].reshape(-1, DEPTH) / by).astype(np.float32)
            squares["table"][of] += (sums[k][cells : 2 * cells].reshape(-1, DEPTH) / by).astype(np.float32)
    rest = sums.get(ROWS // TABLE_CHUNK)
    at = 0
    for held in (parts, squares) if rest is not None else ():
        for name in held:
            if name != "table":
                size = held[name].size
                move = rest[at : at + size].reshape(held[name].shape) / rest[-1]
                held[name] = (held[name] + move).astype(np.float32)
                at += size
    return parts, squares


class Model:
    """A net, word profiles of languages, and each language's threshold; `plain` is a fixed
    score where there was nothing to learn from."""

    def __init__(self, plain: float | None = None) -> None:
        self.plain = plain
        self.net, self.slope = Net(), 1.0
        self.names, self.profile, self.cuts = [""], np.zeros((PROFILE, 1), np.float32), np.zeros(1)

    def languages(self, words: Words) -> np.ndarray:
        """Number of the language whose profile makes a text's words likeliest; none: the first."""
        found = np.zeros((len(words.count), len(self.names)))
        known = self.profile[words.bucket]
        ends = np.cumsum(words.count)
        for k, (a, b) in enumerate(zip(ends - words.count, ends)):
            for low in range(a, b, STEP):
                found[k] += known[words.ids[low : min(b, low + STEP)]].sum(0)
        return found.argmax(1)

    def scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Score, 0.5 at a language's threshold, and the language's number."""
        spoken = self.languages(words)
        if self.plain is not None:
            return np.full(len(spoken), self.plain), spoken
        odds = self.slope * (self.net.logits(words) - self.cuts[spoken])
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60))), spoken

    def written(self) -> bytes:
        held = io.BytesIO()
        np.savez(
            held, names=np.array(self.names), profile=self.profile, cuts=self.cuts,
            slope=self.slope, **{f"net_{k}": v for k, v in self.net.parts.items()},
        )
        return held.getvalue()

    @classmethod
    def read(cls, data: bytes) -> Model:
        held, model = np.load(io.BytesIO(data)), cls()
        model.names = held["names"].tolist()
        model.profile, model.cuts, model.slope = held["profile"], held["cuts"], float(held["slope"])
        model.net.parts = {k[4:]: held[k] for k in held.files if k.startswith("net_")}
        return model


def best_cut(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The threshold of the largest F1 of label 1, half-way to the next lower value."""
    order = np.argsort(-logit, kind="stable")
    z, hit = logit[order], np.cumsum((weight * y)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * y).sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2 if k + 1 < len(z) else z[k] - 1)


def _labelled(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[int, Words, np.ndarray, list[str | None]]]:
    """Share, words, labels and languages of bounded runs of rows (share, y, text, spoken)."""
    for batch in shared.lean(batches):
        shares = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(shares)) + 1).tolist(), len(shares)]
        for a, b in zip(edges[:-1], edges[1:]):
            run = batch.slice(a, b - a)
            for of in spans(pa.compute.utf8_length(run.column(2)).to_pylist()):
                part = run.slice(of.start, len(of))
                yield (
                    int(shares[a]), Words(part.column(2).to_pylist()), part.column(1).to_numpy(),
                    part.column(3).to_pylist(),
                )


def _counts(texts: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold a row by label, of those the net learns from; words of all by bucket and language."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, ROWS), np.int64)
        profile = np.zeros((len(names), PROFILE), np.int64)
        number = {name: k for k, name in enumerate(names)}
        # The share of a text kept for the thresholds is -1.
        for share, words, y, spoken in _labelled(rows):
            ends = np.cumsum(words.count)
            for name, a, b in zip(spoken, ends - words.count, ends):
                if name in number:
                    np.add.at(profile[number[name]], words.bucket[words.ids[a:b]], 1)
            if share >= 0:
                for label, pieces in zip(y, _pieces_of_texts(words)):
                    held[label, pieces] += 1
        cells = [*held, *profile]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(cells)), pa.int32()), pa.array([c.tobytes() for c in cells])],
            ["chunk", "cells"],
        )

    found = shared.merged(texts.mapInArrow(count, shared.CHUNK_ROWS), "<i8", np.add)
    none = np.zeros(PROFILE, np.int64)
    profile = np.array([found.get(2 + k, none) for k in range(len(names))])
    return np.array([found[0], found[1]]), profile


def _trained(texts: DataFrame, net: Net, weights: np.ndarray, rounds: int) -> Net:
    """Rounds of one pass over all texts: each share moves a copy of the net, moves are averaged."""
    parts, squares = net.parts, {k: np.full_like(p, 1e-4) for k, p in net.parts.items()}
    for turn in range(rounds):
        held = texts.sparkSession.sparkContext.broadcast((parts, squares))

        def learn(rows: Iterator[pa.RecordBatch], turn: int = turn, held=held) -> Iterator[pa.RecordBatch]:
            def told(learner: Learner) -> pa.RecordBatch:
                chunk, cells = zip(*learner.moved())
                share = pa.array([now] * len(chunk), pa.int64())
                return pa.RecordBatch.from_arrays(
                    [pa.array(chunk, pa.int32()), pa.array(cells), share], ["chunk", "cells", "share"]
                )

            now, learner = None, None
            for share, words, y, _ in _labelled(rows):
                if share != now and learner is not None:
                    yield told(learner)
                if share != now:
                    now, learner = share, Learner(*held.value, seed=(turn << 32) + share)
                learner.learn(words, y, weights[y])
            if learner is not None:
                yield told(learner)

        def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in rows:
                for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    move = np.frombuffer(cells, "<f4").astype(np.float64)
                    sums[chunk] = sums[chunk] + move if chunk in sums else move
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sums, pa.int32()), pa.array([x.tobytes() for x in sums.values()])],
                    ["chunk", "cells"],
                )

        moves = texts.mapInArrow(learn, "chunk int, cells binary, share long")
        # Added in the order of the shares, so that equal runs give equal sums.
        done = shared.spread(moves, "chunk").sortWithinPartitions("chunk", "share").mapInArrow(
            add, shared.CHUNK_ROWS
        ).collect()
        sums = {r["chunk"]: np.frombuffer(r["cells"], np.float64) for r in done}
        parts, squares = averaged(parts, squares, sums)
    net.parts = parts
    return net


def _calibrated(texts: DataFrame, model: Model, share: float, few: int) -> None:
    """Sets thresholds and slope from counts of all texts by language, label and logit in steps."""
    held = texts.sparkSession.sparkContext.broadcast(model)

    def logits(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, y, _ in _labelled(rows):
            steps = np.round(np.clip(held.value.net.logits(words), -LIMIT, LIMIT) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.value.languages(words)), pa.array(steps), pa.array(y, pa.int32())],
                ["language", "step", "y"],
            )

    # At most LANGUAGES * 2 * (2 * LIMIT * STEPS + 1) rows, whatever the number of texts.
    found = texts.mapInArrow(logits, "language long, step long, y int").groupBy(
        "language", "step", "y"
    ).count().orderBy("language", "step", "y").toArrow()
    language, step, label, count = (c.to_numpy() for c in found.columns)
    logit = step / STEPS
    weight = count * (np.where(label == 1, share, 1 - share) / np.bincount(label, count, 2)[label])
    model.cuts = np.full(len(model.names), best_cut(logit, label, weight))
    for k in range(len(model.names)):
        mine = language == k
        if np.bincount(label[mine], count[mine], 2).min() >= few:
            model.cuts[k] = best_cut(logit[mine], label[mine], weight[mine])
    slopes = np.geomspace(0.05, 20, 60)
    odds = np.where(label == 1, -1, 1) * (logit - model.cuts[language])
    model.slope = float(slopes[np.argmin([(weight * np.logaddexp(0, s * odds)).sum() for s in slopes])])


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int | None = None, key: str = "doc_id",
    text: str = "text", language: str = "lang", label: str = "toxic", few: int = 8,
) -> Model:
    """Learns from all labelled documents, in passes over one table of their texts.

    The first pass counts the pieces of each label and the words of each language, the next
    ones train the net, the last one counts logits for the thresholds. Keys are dealt by hash
    to shares of about SHARE; in a round each share moves a copy of the net, one mini-batch
    after another, and the mean of the moves is the next round's net. Every fifth text is kept
    from the net for the thresholds, or none where that leaves fewer than `few` of a label:
    then the net's own texts serve. A language with fewer than `few` of a label has the
    threshold of all. A task holds nets and a bounded run of texts, whatever keys repeat.

    `language` (null allowed) only names the word profiles by which thresholds are chosen;
    scores are of texts alone. A key with several labels counts as 1 if one of them is; labels
    other than 0 and 1, null labels and keys, and labels of unknown documents are left out.
    Without labels, or with one label only, every text gets the fixed score 0, or that label.
    `per_class` is for callers who want less: the texts of that many keys a label.
    """
    # A key hashes alike on both sides only as one type.
    kind = docs.select(key).union(labels.select(key)).schema[0].dataType
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(
        F.col(key).cast(kind).alias("key")
    ).agg(F.max(F.col(label).cast("int")).alias("y"))
    sizes = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Model(float(next(iter(sizes), 0)))
    part = sizes[1] / (sizes[0] + sizes[1])
    if per_class is not None:
        first = Window.partitionBy("y").orderBy(F.xxhash64("key"), "key")
        marks = marks.withColumn("rank", F.row_number().over(first)).where(
            F.col("rank") <= per_class
        ).drop("rank")
    shares = -(-sum(sizes.values()) // SHARE)
    # Only texts that may have a label are shuffled, once: their labels go to the same shares.
    wanted = shared.may_have(marks.select(F.xxhash64("key")))
    rows = docs.select(
        F.col(key).cast(kind).alias("key"), F.lit(None).cast("int").alias("y"), F.col(text).alias("text"),
        F.col(language).cast("string").alias("spoken"), F.lit(True).alias("is_text"),
    ).where(F.col("key").isNotNull()).where(wanted(F.xxhash64("key")))
    marked = marks.select(
        "key", "y", F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(False)
    )
    dealt = shared.spread(
        rows.union(marked).withColumn("share", F.pmod(F.xxhash64("key"), F.lit(shares))), "share"
    )
    met = dealt.withColumn("y", F.max("y").over(Window.partitionBy("share", "key"))).where(
        "is_text and y is not null"
    ).select(
        "share", "y", "text", "spoken", (F.pmod(F.xxhash64("text", "key"), F.lit(5)) == 4).alias("kept")
    )
    texts = shared.staged(
        # By hash, so that a mini-batch holds texts of all kinds.
        met.sortWithinPartitions("share", "kept", F.xxhash64("text"), "text", "y", "spoken"),
        "labelled",
    )
    held = {(r["kept"], r["y"]): r["count"] for r in texts.groupBy("kept", "y").count().collect()}
    if min(held.get((True, y), 0) for y in (0, 1)) < few:
        texts = texts.withColumn("kept", F.lit(False))
        held = {(False, y): held.get((False, y), 0) + held.get((True, y), 0) for y in (0, 1)}
    size = np.array([held.get((False, y), 0) for y in (0, 1)])
    if not size.all():
        return Model(0.0)
    model = Model()
    spoken = texts.where("spoken is not null").groupBy("spoken").count()
    names = spoken.orderBy(F.desc("count"), "spoken").limit(LANGUAGES).collect()
    model.names = [r["spoken"] for r in names] or [""]
    columns = ["share", "y", "text", "spoken"]
    known = F.when(F.col("kept"), -1).otherwise(F.col("share")).alias("share")
    seen, words = _counts(texts.select(known, *columns[1:]), model.names)
    chance = (seen + 1) / (size + 2)[:, None]
    odds = np.clip(np.log(chance[1] / chance[0]), -2, 2).astype(np.float32)
    profile = words.T + 1.0
    model.profile = np.log(profile / profile.sum(0)).astype(np.float32)
    net = Net()
    net.start(odds)
    model.net = _trained(
        texts.where("not kept").select(columns), net, size.sum() / (2 * size), ROUNDS
    )
    told = texts.where("kept") if any(kept for kept, _ in held) else texts
    _calibrated(told.select(columns), model, part, few)
    shared.dropped(texts)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` and score (0 to 1), predicted (1 from 0.5 on), language.

    Null, empty and wordless texts have the score of no words, in the commonest language.
    Rows are independent; columns of these names in `docs` are replaced, all others kept.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = ("score", "predicted", "language")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    schema = StructType(
        [
            *rows.schema, StructField("score", DoubleType()),
            StructField("predicted", IntegerType()), StructField("language", StringType()),
        ]
    )
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.lean(batches):
            texts = batch.column(names.index(text))
            sizes = pa.compute.utf8_length(texts).to_pylist()
            for some in spans(sizes):
                part = batch.slice(some.start, len(some))
                found, spoken = held.value.scores(Words(part.column(names.index(text)).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, pa.array(found), pa.array((found >= ACCEPT).astype(np.int32)),
                        pa.array([held.value.names[k] for k in spoken], pa.string()),
                    ],
                    names,
                )

    return rows.mapInArrow(run, schema)


def spans(sizes: list[int | None], size: int = 1 << 20) -> Iterator[range]:
    """Row ranges of about `size` characters; a longer text is a range of its own."""
    first = total = 0
    for k, chars in enumerate(sizes):
        total += chars or 0
        if total >= size or k == len(sizes) - 1:
            yield range(first, k + 1)
            first, total = k + 1, 0
