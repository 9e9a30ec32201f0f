"""Sets of word shingles of whole texts, as sorted 64-bit numbers, in whole-array steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: White space that parts words.
_SPACES = [0x20, *range(0x09, 0x0E)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[_SPACES] = True
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 64, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose words are hashed together; a longer word is a step of its own.
SEGMENT = 1 << 17
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash: each bit of the result depends on all of `x`."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_POWERS.get("up", ()))
    if have < n:
        _POWERS.clear()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            powers = np.full(max(n, SEGMENT), base)
            powers[0] = 1
            _POWERS[name] = np.multiply.accumulate(powers, out=powers)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def batches(texts: list[str | None], size: int = 1 << 20) -> Iterator[range]:
    """Row ranges of about `size` characters; a longer text is a range of its own."""
    first = total = 0
    for k, text in enumerate(texts):
        total += len(text or "")
        if total >= size or k == len(texts) - 1:
            yield range(first, k + 1)
            first, total = k + 1, 0


def hashed_words(
    coded: list[bytes], gap: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, first and end byte (in its text) of each word of UTF-8 texts.

    A word is a run of bytes that `gap` does not mark, a space being a gap always; A-Z count
    as a-z.
    """
    data = np.frombuffer(b" ".join([b"", *coded, b""]), np.uint8)
    # Each text begins after one space.
    begins = np.cumsum([1, *(len(c) + 1 for c in coded)])[: len(coded)]
    between = gap[data]
    edges = np.flatnonzero(between[1:] != between[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    doc = np.searchsorted(begins, starts, "right") - 1
    word = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        # A hash does not depend on where its word stands, so any run of words can be a step.
        a = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, a + SEGMENT, "right")))
        size = ends[last - 1] - a
        up, down = _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[data[a : a + size]]] * up, out=sums[1:])
        begin, end = starts[first:last] - a, ends[first:last] - a
        word[first:last] = mixed((sums[end] - sums[begin]) * down[begin])
        first = last
    return word, doc, starts - begins[doc], ends - begins[doc]


def shingle_sets(texts: list[str | None], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after another, and each set's size.

    A-Z count as a-z; words are runs of characters other than white space. A text of fewer
    words than a shingle is one shingle, unlike any full one; without words it has none.
    """
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    word, doc, _, _ = hashed_words(coded, _IS_SPACE)
    count = np.bincount(doc, minlength=len(texts))
    # A shingle begins at each word with enough words of its text after it, or at the first.
    left = np.cumsum(count)[doc] - np.arange(len(doc))
    first = np.diff(doc, prepend=-1) != 0
    head = np.flatnonzero((left >= words) | (first & (left < words)))
    hashes = np.zeros(len(head), np.uint64)
    length = np.minimum(left[head], words)
    for k in range(words):
        has = length > k
        hashes[has] += word[head[has] + k] * _PLACE[k]
    hashes = mixed(hashes + length.astype(np.uint64) * _PLACE[-1])
    owner = doc[head]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(texts))
