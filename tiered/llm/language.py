"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiered.llm import shared

DIMS = 4096
ORDERS = (1, 2, 3)
#: Texts counted together: bounds the dense block of counts.
ROWS = 512
CHARS = 1 << 20
_BMP: list[np.ndarray] = []
_STEP = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if not _BMP:
        _BMP.append(np.array([chr(c).isalpha() for c in range(1 << 16)]))
    known = _BMP[0][np.minimum(codes, 0xFFFF)]
    for code in np.unique(codes[codes > 0xFFFF]):
        known[codes == code] = chr(code).isalpha()
    return known


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """Hashed counts of letter n-grams of whole texts, words apart by one space, lower case."""
    coded = [(t or "").lower().encode("utf-32-le", "surrogatepass") for t in texts]
    gap = " ".encode("utf-32-le")
    codes = np.frombuffer(gap.join([*coded, b""]), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(c) // 4 + 1 for c in coded])
    letter = _letters(codes)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes, owner, letter = codes[keep], owner[keep], letter[keep]
    codes = np.where(letter, codes, np.uint32(0x20))
    total = np.zeros(len(texts) * DIMS, np.int64)
    for order in ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            break
        hashed = np.full(n, order, np.uint32)
        for k in range(order):
            hashed = (hashed ^ codes[k : k + n]) * _STEP[k]
            hashed ^= hashed >> np.uint32(15)
        some = owner[:n] == owner[order - 1 :]
        if order == 1:
            some &= letter
        cell = owner[:n][some] * DIMS + (hashed[some] & np.uint32(DIMS - 1))
        total += np.bincount(cell, minlength=len(total))
    return total.reshape(-1, DIMS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors with dampened counts; a text without letters is zero."""
    x = np.log1p(counts).astype(np.float32) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norm > 0, norm, 1)[:, None]


def blocks(texts: list[str | None]) -> Iterator[range]:
    first = total = 0
    for k, text in enumerate(texts):
        total += len(text or "")
        if total >= CHARS or k + 1 - first == ROWS or k == len(texts) - 1:
            yield range(first, k + 1)
            first, total = k + 1, 0


def centroids(x: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart first members; each row's centroid."""
    mean = x.mean(axis=0)
    chosen = [int((x @ mean).argmax())]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    middle = x[chosen]
    for _ in range(rounds):
        of = (x @ middle.T).argmax(axis=1)
        middle = np.stack(
            [x[of == c].sum(axis=0) if (of == c).any() else middle[c] for c in range(len(middle))]
        )
        middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    return middle, (x @ middle.T).argmax(axis=1)


class Model:
    """Centroids with their languages and the least cosine of their own members."""

    def __init__(
        self, idf: np.ndarray, langs: list[str], middle: np.ndarray, reach: np.ndarray
    ) -> None:
        self.idf, self.langs, self.middle, self.reach = idf, langs, middle, reach

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine, and whether the text is too far from its centroid."""
        out: list[tuple[str, float, bool]] = []
        for of in blocks(texts):
            counts = gram_counts(texts[of.start : of.stop])
            some = counts.any(axis=1)
            if not self.langs:
                out += [("und", 0.0, True)] * len(of)
                continue
            near = vectors(counts, self.idf) @ self.middle.T
            best = near.argmax(axis=1)
            score = np.clip(near[np.arange(len(best)), best].astype(np.float64), 0, 1)
            far = score < self.reach[best]
            out += [
                (self.langs[b], float(s), bool(f)) if any_ else ("und", 0.0, True)
                for b, s, f, any_ in zip(best, score, far, some)
            ]
        return out


def drawn(rows: DataFrame, per_language: int, most_languages: int) -> DataFrame:
    """Of rows (lang, text, draw) the `per_language` of each language with the smallest draws.

    Adds rank, from 1. Draws alone are ranked first, so that of the texts only those up to the
    last draw of their language are shuffled. Equal draws go by text; equal rows share a draw
    and are cut at the bound like any others. More languages than `most_languages` raise.
    """
    smallest = Window.partitionBy("lang").orderBy("draw")
    last = (
        rows.select("lang", "draw")
        .withColumn("rank", F.row_number().over(smallest))
        .where(F.col("rank") <= per_language)
        .groupBy("lang").agg(F.max("draw").alias("last"))
        .limit(most_languages + 1)
        .collect()
    )
    if len(last) > most_languages:
        raise ValueError(f"more than {most_languages} languages: fit on fewer, or raise the bound")
    # At most `most_languages` rows of two values.
    bounds = rows.sparkSession.createDataFrame(last, "lang string, last long")
    return (
        rows.join(F.broadcast(bounds), "lang")
        .where("draw <= last")
        .withColumn("rank", F.row_number().over(smallest.orderBy("draw", "text")))
        .where(F.col("rank") <= per_language)
        .select("lang", "text", "rank")
    )


def fit(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = 1000, clusters: int = 4, tail: float = 0.005, most_languages: int = 2000,
) -> Model:
    """Learns from rows with a language.

    Document frequencies cover all rows. Centroids are fitted on at most `per_language` whole
    texts of each language, those of the smallest hashes of key and text, one language a
    task; repeated or null keys and repeated rows cannot make the sample larger. A centroid's reach is the cosine that all but the share `tail` of its members have.
    The model has at most `most_languages` x `clusters` centroids; more languages raise. Rows
    without a language or text are left out; without rows the model knows no language.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("draw"),
    )
    sample = drawn(rows, per_language, most_languages)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for of in blocks(texts):
                have[:DIMS] += (gram_counts(texts[of.start : of.stop]) > 0).sum(axis=0)
                have[DIMS] += len(of)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array([have.tobytes()])], ["chunk", "cells"]
        )

    found = shared.merged(
        rows.select("text").mapInArrow(frequencies, shared.CHUNK_ROWS), "<i8", np.add
    )
    have = found.get(0, np.zeros(DIMS + 1, np.int64))
    idf = (np.log((1 + have[DIMS]) / (1 + have[:DIMS])) + 1).astype(np.float32)

    def cluster(_: tuple, group: pa.Table) -> pa.Table:
        texts = group.sort_by("rank").column("text").to_pylist()
        x = np.concatenate(
            [vectors(gram_counts(texts[of.start : of.stop]), idf) for of in blocks(texts)]
        )
        x = x[x.any(axis=1)]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "middle": pa.array([], pa.binary()),
                             "reach": pa.array([], pa.float64())})
        middle, of = centroids(x, clusters)
        near = np.einsum("ij,ij->i", x, middle[of])
        used = np.unique(of)
        return pa.table(
            {
                "lang": [group.column("lang")[0].as_py()] * len(used),
                "middle": [middle[c].astype("<f4").tobytes() for c in used],
                "reach": [float(np.quantile(near[of == c], tail)) for c in used],
            }
        )

    fitted = sorted(
        sample.groupBy("lang")
        .applyInArrow(cluster, "lang string, middle binary, reach double")
        .collect(),
        key=lambda r: (r["lang"], r["middle"]),
    )
    middle = np.array([np.frombuffer(r["middle"], "<f4") for r in fitted]).reshape(-1, DIMS)
    return Model(idf, [r["lang"] for r in fitted], middle, np.array([r["reach"] for r in fitted]))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` and lang_pred, score (cosine, 0 to 1), rejected.

    `und` with score 0 stands for a null text, a text without letters, and any text if the
    model has no language. `rejected` marks texts farther from their centroid than its reach;
    their nearest language is still named. A clashing column of `docs` is replaced. Rows are
    independent: repeated rows get the same answer.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = held.value.predict(batch.column(kept.index(text)).to_pylist())
            langs, scores, far = zip(*found) if found else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()), pa.array(far, pa.bool_()),
                ],
                [*kept, *added],
            )

    rows = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")
