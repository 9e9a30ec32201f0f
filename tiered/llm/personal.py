"""Personal data: direct identifiers by pattern, and terms that disclose them by co-occurrence.

A term discloses a protected entity when seeing it tells nearly as much as the entity would:
the pointwise mutual information of the two, over the information content of the entity,
exceeds a threshold. Both are estimated from all distinct texts of the corpus, over whole
texts. An entity is the value of an identifier, a coarser part of it (mail domain, first
digits) or its kind. A term that stands nowhere without the entity can disclose it by a
single text: the share is shrunk towards chance by a fraction of a text, and what chance
alone would bring about is left out. A term that also stands in other texts, which would be
altered too, must be beyond what chance brings about in any of all tested pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiered.llm import shared
from tiered.llm.shingles import batches, hashed_words

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the spans that the method adds, after the ones above.
ADDED = ("removed", "general")
#: Rows of one pass over the texts: counts of terms, entities of texts, words beside them.
TERM, ENTITY, HELD = range(3)
SEEN = "what byte, key long, value long, terms array<long>"
#: The most common terms that are dropped before a shuffle where they are too common; others
#: are dropped after it.
COMMON = 4096
SPANS = "array<struct<kind:string,start:long,end:long>>"
#: Words of texts that a task holds before it counts them and hands them on.
PAIRS = 1 << 20
#: Texts handled together.
SOME_ROWS = 256
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can only begin where a run of digits does: nothing is tried twice in a long run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_GAP = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for match in _DOMAIN.finditer(text):
        at = start = match.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = match.end()
            yield start, last


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of direct identifiers, leftmost without overlap in a kind."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return sorted(out)
    for m in _IP.finditer(text):
        # Longer than any part that can be at most 255 without leading zeros.
        if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _number(name: str) -> int:
    coded = name.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(coded, digest_size=8).digest(), "little", signed=True)


def entities(text: str, span: tuple[int, int, int]) -> set[int]:
    """Numbers for the value of a span, for a coarser part of it and for its kind."""
    value = text[span[0] : span[2]].lower()
    if span[1] == 0:
        part = value.rpartition("@")[2]
    elif span[1] == 1:
        part = ".".join(value.split(".")[:2])
    else:
        value = "".join(_DIGIT.findall(value))
        part = value[:6] if span[1] == 2 else value[:-7]
    return {_number(f"{span[1]}:{name}") for name in (f"value:{value}", f"part:{part}", "kind")}


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (code points) of each word of a text."""
    data = text.encode("utf-8", "surrogatepass")
    word, _, start, end = hashed_words([data], _GAP)
    chars = np.concatenate(
        [[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
    )
    return word.view(np.int64), chars[start], chars[end]


def _free(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that no span touches."""
    free = np.ones(len(start), bool)
    for a, _, b in spans:
        free &= (end <= a) | (start >= b)
    return free


Rows = Iterator[pa.RecordBatch]


def _few(rows: Rows) -> Rows:
    """The same rows in batches of few, so that a task holds little at once."""
    for batch in shared.lean(rows):
        for at in range(0, batch.num_rows, SOME_ROWS):
            yield batch.slice(at, SOME_ROWS)


def _that(place: int, held: Broadcast, wanted: bool) -> Callable[[Rows], Rows]:
    """Keeps the rows whose key a filter may hold, or the others, in batches of few rows."""

    def chosen(rows: Rows) -> Rows:
        for batch in _few(rows):
            own = shared.passes(batch.column(place).to_numpy(), held.value) == wanted
            if own.any():
                yield batch.filter(pa.array(own))

    return chosen


def _once(texts: DataFrame, keys: DataFrame, run: Callable[[Rows], Rows], schema: str) -> DataFrame:
    """`run` over each distinct text once; only texts that may have copies are shuffled."""
    held = shared.key_filter(keys.where("n > 1").select("text_key"))
    single, copied = _that(0, held, False), _that(0, held, True)
    again = texts.mapInArrow(copied, texts.schema).dropDuplicates(["text_key"])
    return texts.mapInArrow(lambda rows: run(single(rows)), schema).unionByName(
        again.mapInArrow(lambda rows: run(_few(rows)), schema)
    )


def _coded(values: list[str | None]) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Ranges of texts, and the hash and text number in the range of each of their words."""
    for of in batches(values):
        coded = [(t or "").encode("utf-8", "surrogatepass") for t in values[of.start : of.stop]]
        word, doc, _, _ = hashed_words(coded, _GAP)
        yield of, word.view(np.int64), doc


def _seen(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of distinct texts: (TERM, term, texts), (ENTITY, entity, text), (HELD, text, its terms)."""

    def out(
        what: int, key: np.ndarray, value: np.ndarray, terms: list[np.ndarray] | None = None
    ) -> pa.RecordBatch:
        kind = pa.array(np.full(len(key), what, np.int8))
        lists = pa.array(terms or [None] * len(key), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [kind, pa.array(key), pa.array(value), lists], ["what", "key", "value", "terms"]
        )

    waiting: list[np.ndarray] = []
    count = 0
    for batch in rows:
        keys, values = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        named = []
        for key, text in zip(keys.tolist(), values):
            spans = base_spans(text)
            if spans:
                named += [(e, key) for e in set().union(*(entities(text, s) for s in spans))]
                word, start, end = words_of(text)
                free = np.unique(word[_free(start, end, spans)])
                one = np.array([key], np.int64)
                yield out(HELD, one, np.array([len(free)], np.int64), [free])
        if named:
            yield out(ENTITY, *np.array(named, np.int64).T)
        for _, word, doc in _coded(values):
            order = np.lexsort((doc, word))
            word, doc = word[order], doc[order]
            new = np.ones(len(word), bool)
            new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
            waiting.append(word[new])
            count += len(waiting[-1])
            if count > PAIRS:
                yield out(TERM, *np.unique(np.concatenate(waiting), return_counts=True))
                waiting, count = [], 0
    if waiting:
        yield out(TERM, *np.unique(np.concatenate(waiting), return_counts=True))


def disclosing_terms(
    texts: DataFrame, general: float, removed: float, prior: float, chance: float
) -> DataFrame:
    """(text_key, terms) of the texts with a disclosing term; terms are (term, kind) pairs.

    `texts` has text_key and text; rows with one key are one text, however often it stands.
    """
    keys = shared.staged(
        texts.groupBy("text_key").agg(F.count("*").alias("n")), "text_keys"
    )
    total = float(keys.count())
    seen = shared.staged(_once(texts, keys, _seen, SEEN), "seen")
    frequency = (
        seen.where(F.col("what") == TERM).groupBy(F.col("key").alias("term"))
        .agg(F.sum("value").alias("n_term"))
    )
    # Entities of the very same texts tell the same: a list of many addresses is one group.
    occurs = seen.where(F.col("what") == ENTITY).select(
        F.col("key").alias("entity"), F.col("value").alias("text_key")
    )
    mark = F.xxhash64(F.lit(1), "text_key")
    groups = occurs.groupBy("entity").agg(
        F.count("*").alias("n_entity"), F.bit_xor("text_key").alias("a"), F.bit_xor(mark).alias("b")
    )
    share = F.col("n_entity") / total
    # The most texts a term may stand in and still tell the share `general` of an entity.
    most = (F.col("n_entity") + prior * share) * F.pow(share, general - 1) - prior + 1e-9
    groups = groups.where(F.col("n_entity") < total).select(
        "entity", F.xxhash64("n_entity", "a", "b").alias("group"), "n_entity"
    )
    protected = shared.staged(
        occurs.join(groups, "entity").select("group", "n_entity", "text_key").distinct(),
        "protected",
    )
    limit = protected.agg(F.max(most)).first()[0]
    if limit is None:
        return protected.selectExpr(
            "text_key", "cast(null as array<struct<term:long,kind:string>>) as terms"
        ).limit(0)
    held = seen.where(F.col("what") == HELD).select(
        F.col("key").alias("text_key"), F.col("value").alias("n_terms"), "terms"
    )
    # As many pairs are tested at most: every term beside every entity of its text.
    tested = held.join(protected, "text_key").agg(F.sum("n_terms")).first()[0] or 1
    # Where a third of the texts holds an identifier, so do as many rows hold a common word.
    common = (
        frequency.where(F.col("n_term") > limit).orderBy(F.desc("n_term"), "term").limit(COMMON)
    )
    pairs = (
        held.join(protected, "text_key")
        .select("group", "n_entity", F.explode("terms").alias("term"))
        .join(F.broadcast(common.select("term")), "term", "left_anti")
        .join(frequency.where(F.col("n_term") <= limit), "term")
        .where(F.col("n_term") <= most)
        .groupBy("term", "n_term", "group", "n_entity")
        .agg(F.count("*").alias("n_both"))
    )
    content = -F.log(share)
    # How often the term comes with the entity, shrunk by `prior` texts as chance has them.
    often = (F.col("n_both") + prior * share) / (F.col("n_term") + prior)
    rate = F.col("n_both") / F.col("n_term")
    apart = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    # Bounds the logarithm of the chance that unrelated ones meet so often (Chernoff).
    unlikely = -F.col("n_term") * (rate * F.log(rate / share) + apart)
    sure = F.when(rate < 1, float(np.log(chance / tested))).otherwise(float(np.log(chance)))
    told = shared.staged(
        pairs.where((rate > share) & (unlikely <= sure + 1e-9))
        .groupBy("term")
        .agg(F.max(1 + F.log(often) / content).alias("told"))
        .where(F.col("told") >= general)
        .select("term", F.when(F.col("told") >= removed, ADDED[0]).otherwise(ADDED[1]).alias("kind")),
        "told",
    )
    # What the filter lets through by mistake does not meet a term in the join below.
    wanted = shared.key_filter(told.select("term"))

    def holding(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for few in _few(rows):
            keys = few.column(0).to_numpy()
            for of, word, doc in _coded(few.column(1).to_pylist()):
                some = shared.passes(word, wanted.value)
                both = np.stack([word[some], keys[of.start : of.stop][doc[some]]], axis=1)
                both = np.unique(both, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1])], ["term", "text_key"]
                )

    return shared.staged(
        texts.mapInArrow(holding, "term long, text_key long")
        .distinct()
        .join(told, "term")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("term", "kind")).alias("terms")),
        "disclosing",
    )


def all_spans(text: str, terms: dict[int, str]) -> list[tuple[int, int, int]]:
    """Base spans and those of disclosing terms outside them, by start and then kind."""
    spans = base_spans(text)
    if terms:
        word, start, end = words_of(text)
        hit = np.flatnonzero(np.isin(word, np.fromiter(terms, np.int64, len(terms))))
        hit = hit[_free(start[hit], end[hit], spans)]
        kinds = (*KINDS, *ADDED)
        spans = sorted(
            spans
            + [(int(start[k]), kinds.index(terms[int(word[k])]), int(end[k])) for k in hit]
        )
    return spans


def cleaned(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the name of its first kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            name = (*KINDS, *ADDED)[kind]
            out += [text[at:start], "" if name == "removed" else f"[{name.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame, general: float = 0.9, removed: float = 0.98, prior: float = 0.25,
    chance: float = 0.01, text: str = "text",
) -> DataFrame:
    """All columns of `docs` with the text sanitised, and the column pii_spans.

    Direct identifiers (email, ip, card, phone) are found by pattern in each whole text. A
    word anywhere in a text with an identifier is generalised wherever it occurs if its mutual
    information with the identifier's value, coarser part or kind reaches the share `general`
    of that entity's information content, and removed from the share `removed` on. The share
    counts `prior` more texts in which the two meet as chance has it, and what chance alone
    brings about with probability above `chance` is left out. One text is enough if texts
    with the entity are rarer than `chance` and the word stands in no text without it. For a
    word that does, `chance` holds for all tested pairs of words and entities together
    (Bonferroni), so that texts without identifiers are not altered by accident.
    Copies of a text count once. Spans are code
    points of the original text, end exclusive, by start and then kind; identifiers become
    their kind in brackets, generalised words [GENERAL], removed words nothing.

    A null text stays null and has no spans; an empty one stays empty. Repeated rows get the
    same answer; an empty table gives no rows; a column named pii_spans is replaced.
    """
    kept = [c for c in docs.columns if c != "pii_spans"]
    key, found_terms = shared.free("__text_key", kept), shared.free("__terms", kept)
    keyed = docs.select(*kept).withColumn(key, F.xxhash64(F.col(text)))
    texts = keyed.where(F.col(text).isNotNull()).select(
        F.col(key).alias("text_key"), F.col(text).alias("text")
    )
    told = disclosing_terms(texts, general, removed, prior, chance)
    # Only texts that may hold such a word are shuffled; one with very many copies is split.
    held = shared.key_filter(told.select("text_key"))
    place = keyed.columns.index(key)
    without, within = _that(place, held, False), _that(place, held, True)
    some = keyed.mapInArrow(within, keyed.schema).join(
        told.select(F.col("text_key").alias(key), F.col("terms").alias(found_terms)),
        key, "left",
    ).select(*kept, found_terms)

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = kept.index(text)
        for batch in batches_:
            texts_, found = [], []
            last = batch.column(len(kept))
            disclosing = last if pa.types.is_list(last.type) else [pa.scalar(None)] * len(last)
            for value, terms in zip(batch.column(at), disclosing):
                value, terms = value.as_py(), terms.as_py()
                named = {t["term"]: t["kind"] for t in terms or ()}
                spans = all_spans(value, named) if value else []
                texts_.append(cleaned(value, spans) if spans else value)
                found.append(
                    [
                        {"kind": (*KINDS, *ADDED)[k], "start": a, "end": b}
                        for a, k, b in spans
                    ]
                )
            columns = list(batch.columns[: len(kept)])
            columns[at] = pa.array(texts_, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, _SPAN)], [*kept, "pii_spans"]
            )

    schema = StructType([*some.schema[:-1], *StructType.fromDDL(f"pii_spans {SPANS}")])
    plain = keyed.mapInArrow(lambda rows: run(without(rows)), schema)
    return plain.unionByName(some.mapInArrow(lambda rows: run(_few(rows)), schema))
