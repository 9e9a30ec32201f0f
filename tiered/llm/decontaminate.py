"""Benchmark decontamination: one automaton over normalised item windows, one scan of texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiered.llm import shared

# Bytes of words after lower-casing A-Z: digits, a-z and all of any other character's bytes.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
SPANS = "array<struct<start:long,end:long>>"


def normalised(text: str | None) -> str:
    """Words in lower case with single spaces around each, a character for each byte."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    words = data.split()
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""


def item_windows(text: str | None, window: int) -> set[str]:
    words = normalised(text).split(" ")[1:-1]
    last = max(1, len(words) - window + 1) if words else 0
    return {" " + " ".join(words[k : k + window]) + " " for k in range(last)}


class Automaton:
    """Aho-Corasick automaton whose patterns are item windows between spaces."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int) -> None:
        found: dict[str, set[str]] = {}
        for item, text in items:
            for pattern in item_windows(text, window):
                found.setdefault(pattern, set()).add("" if item is None else str(item))
        self.machine = ahocorasick.Automaton()
        for pattern, names in found.items():
            # A window of n words has n + 1 spaces.
            self.machine.add_word(pattern, (len(pattern), pattern.count(" ") - 1, names))
        self.empty = not found
        if found:
            self.machine.make_automaton()

    def scan(self, text: str | None) -> tuple[int, set[str], list[tuple[int, int]]]:
        """Words of a text, items with a window in it, and merged runs of hit words."""
        plain = normalised(text)
        n_words = max(0, plain.count(" ") - 1)
        if self.empty or not plain:
            return n_words, set(), []
        items: set[str] = set()
        runs: list[tuple[int, int]] = []
        word = at = 0
        for end, (size, words, names) in self.machine.iter(plain):
            # Ends come in order, so spaces are counted once over the text.
            word += plain.count(" ", at, end)
            at = end
            items |= names
            runs.append((word - words, word))
        merged: list[tuple[int, int]] = []
        for start, stop in sorted(runs):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
            else:
                merged.append((start, stop))
        return n_words, items, merged


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point offsets, end exclusive, of word runs in the text as it was."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data)]
    # Characters before a byte: all bytes but those that continue a character.
    out, at, chars = [], 0, 0
    for start, stop in runs:
        ends = []
        for byte in (places[start][0], places[stop - 1][1]):
            chars += sum(1 for b in data[at:byte] if b & 0xC0 != 0x80)
            at = byte
            ends.append(chars)
        out.append((ends[0], ends[1]))
    return out


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    bound_chars: int = 1 << 26,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Rows of `docs` with what each contains of the items.

    Adds n_words, n_hit (words inside any occurrence of a window), n_items, items_sha256
    and spans (start and end in the original text, code points) to all columns of `docs`; a
    clashing column of `docs` is replaced. The test set is broadcast, at most `bound_chars`
    characters of it, beyond which a ValueError says so: a test set does not grow with the
    corpus, and larger ones are split by the caller into calls over parts of the items.

    Null and wordless texts have no words and no hits; null or wordless items have no
    window; null item ids count as one item with an empty name. Repeated items count once by
    id; repeated documents are separate rows. Empty tables give no hits or no rows.
    """
    bench = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text"))
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > bound_chars:
        raise ValueError(f"the items hold {size} characters; split them, {bound_chars} at most")
    held = docs.sparkSession.sparkContext.broadcast(
        [(r["item"], r["text"]) for r in bench.collect()]
    )
    added = ["n_words", "n_hit", "n_items", "items_sha256", "spans"]
    kept = [c for c in docs.columns if c not in added]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(held, window)
        for batch in shared.lean(batches):
            out: list[tuple] = []
            for value in batch.column(kept.index(text)):
                original = value.as_py()
                n_words, found, runs = machine.scan(original)
                digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                spans = original_spans(original, runs) if runs else []
                hit = sum(b - a for a, b in runs)
                out.append((n_words, hit, len(found), digest, spans))
            words, hits, counts, digests, spans = zip(*out) if out else [()] * 5
            long = pa.int64()
            pairs = pa.array(
                [[{"start": a, "end": b} for a, b in s] for s in spans],
                pa.list_(pa.struct([("start", long), ("end", long)])),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(words, long), pa.array(hits, long),
                    pa.array(counts, long), pa.array(digests, pa.string()), pairs,
                ],
                [*kept, *added],
            )

    rows = docs.select(*kept)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        + ["n_words long, n_hit long, n_items long, items_sha256 string", f"spans {SPANS}"]
    )
    return rows.mapInArrow(scan, schema)


_MACHINES: dict[tuple, Automaton] = {}


def _machine(held, window: int) -> Automaton:
    """The automaton of a broadcast test set, built once a worker process."""
    name = (tuple(held.value), window)
    if name not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[name] = Automaton(held.value, window)
    return _MACHINES[name]
