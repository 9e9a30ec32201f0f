"""Operators on hand-made rows: nulls, blanks, long texts, ties, repeats, empty tables."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import edges
from tiered.llm import (
    archives,
    decontaminate,
    embeddings,
    jaccard,
    language,
    packing,
    personal,
    quality,
    sharding,
    shared,
    token_files,
    tokens,
)
from tiered.llm.components import components
from tiered.llm.shingles import shingle_sets

VOCABULARY = tokens.default_vocabulary()


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- components ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    links += [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 240)]
    rng.shuffle(links)
    got = components(spark.createDataFrame([*links, (None, 3), (5, None)], "a long, b long"))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in got.collect()} == classes(links, nodes)
    assert got.count() == len(nodes)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ----------------------------------------------------------------------


def test_decontamination_edges(spark):
    items = spark.createDataFrame(
        [(1, "Quick brown FOX, jumps"), (10, "quick brown fox jumps"), (2, None), (3, "--"),
         (4, "one two"), (None, "lazy dog and runs"), (4, "one two")],
        "item_id long, text string",
    )
    docs = edges.documents(spark)
    got = decontaminate.decontaminate(docs, items)
    rows = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert got.count() == len(edges.ROWS)
    assert (rows[1].n_words, rows[1].n_hit, rows[1].n_items) == (15, 8, 3)
    assert [edges.PLAIN[a:b] for a, b in rows[1].spans] == [
        "quick brown fox jumps", "lazy dog and runs"
    ]
    assert (rows[2].n_words, rows[3].n_words, rows[4].n_words, rows[9].n_words) == (0, 0, 0, 0)
    assert (rows[8].n_hit, rows[8].n_items) == (2, 1)
    assert rows[5].n_words == 36_000 and rows[5].n_hit == 0
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, items, bound_chars=5)


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab é.\n", max_size=60), st.text(alphabet="ab é.", max_size=9))
def test_windows_against_a_plain_search(text, item):
    window = 3
    machine = decontaminate.Automaton([(1, item)], window)
    n, items, runs = machine.scan(text)
    words = decontaminate.normalised(text).split(" ")[1:-1]
    own = decontaminate.normalised(item).split(" ")[1:-1]
    size = min(window, len(own))
    grams = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
    hit = {
        p for k in range(len(words) - size + 1) if own and tuple(words[k : k + size]) in grams
        for p in range(k, k + size)
    }
    assert n == len(words) and bool(items) == bool(hit)
    assert {p for a, b in runs for p in range(a, b)} == hit
    for (a, b), (x, y) in zip(runs, decontaminate.original_spans(text, runs)):
        assert decontaminate.normalised(text[x:y]).split(" ")[1:-1] == words[a:b]


# --- embeddings ---------------------------------------------------------------------------


def test_embedding_links_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(220):
        base = rng.normal(size=24) if k % 4 == 0 or not rows else np.array(rows[-1][1])
        rows.append((k, (base + rng.normal(size=24) * 0.11).tolist(), int(rng.integers(0, 2))))
    rows += [
        (300, None, 1), (301, [0.0] * 24, 1), (302, [float("nan"), *[1.0] * 23], 1),
        (303, [None, *[1.0] * 23], 1), (304, rows[3][1], None), (305, rows[3][1], rows[3][2]),
        (305, rows[3][1], rows[3][2]), (306, [1.0] * 5, 0), (307, [2.0] * 5, 0), (308, [], 0),
        (309, [1e300] * 24, 1), (310, [float("inf")] * 24, 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumnsRenamed({}).selectExpr("*", "1 as row", "2 as links", "3 as root")
    for tile in (7, 1024):
        got = sorted(tuple(r) for r in embeddings.link_vectors(df, 0.98, tile).collect())
        good = [
            k for k, (_, v, lab) in enumerate(rows)
            if v and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ]
        unit = {k: np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in good}
        unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
        links = [
            (a, b) for a, b in itertools.combinations(good, 2)
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
            and unit[a] @ unit[b] >= 0.98
        ]
        of = classes(links, range(len(rows)))
        count = np.bincount(np.array(links).ravel(), minlength=len(rows))
        want = sorted(
            (r[0], int(count[k]), rows[of[k]][0], r[0] == rows[of[k]][0])
            for k, r in enumerate(rows)
        )
        assert got == want
    assert embeddings.link_vectors(df.limit(0), 0.98).count() == 0
    assert embeddings.link_vectors(df.where("vec_id = 300"), 0.98).count() == 1


# --- Jaccard ------------------------------------------------------------------------------


def plain_join(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        hashes, n = shingle_sets([text])
        sets[k] = set(hashes.tolist())
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    of = classes(links, sets)
    least = {}
    for k, root in of.items():
        known = [i for i in (rows[k][0], least.get(root)) if i is not None]
        least[root] = min(known, default=None)
    return sorted(
        ((rows[k][0], len(sets[k]), least[of[k]] if sets[k] else rows[k][0]) for k in sets),
        key=repr,
    )


def variants(seed: int, families: int, members: int, change: float):
    """Families whose members drift apart, and a line that many texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    line = " ".join(word() for _ in range(12))
    rows = []
    for _ in range(families):
        words = [word() for _ in range(rng.randrange(8, 90))]
        for _ in range(members):
            words = [word() if rng.random() < change else w for w in words]
            text = " ".join(words)
            rows.append((len(rows), f"{line}\n{text}" if rng.random() < 0.5 else text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rows",
    [edges.ROWS, variants(1, 12, 12, 0.012), variants(2, 1, 150, 0.01), variants(3, 80, 1, 0)],
    ids=["edges", "families", "one", "apart"],
)
def test_jaccard_against_all_pairs(spark, rows):
    got = jaccard.link_documents(edges.documents(spark, rows).repartition(3))
    assert edges.table(got, "doc_id", "n_shingles", "component_id") == plain_join(rows)


def test_jaccard_with_small_parts(spark, monkeypatch):
    """Long lists cut into parts and heavy cells dealt over shares lose no link."""
    monkeypatch.setattr(jaccard, "PART", 5)
    monkeypatch.setattr(jaccard, "HEAVY", 20)
    rows = variants(4, 3, 40, 0.012)
    got = jaccard.link_documents(edges.documents(spark, rows).repartition(2))
    assert edges.table(got, "doc_id", "n_shingles", "component_id") == plain_join(rows)


def test_jaccard_with_common_shingles(spark, monkeypatch):
    """Whatever the order knows of common shingles, no link is lost or added."""
    rows = variants(5, 6, 20, 0.012)
    docs = edges.documents(spark, rows).repartition(3)
    for told, common, counted in [(1 << 15, 1 << 20, 50), (7, 1 << 20, 50), (1 << 15, 4, 1 << 21)]:
        monkeypatch.setattr(jaccard, "TOLD", told)
        monkeypatch.setattr(jaccard, "COMMON", common)
        monkeypatch.setattr(jaccard, "COUNTED", counted)
        got = jaccard.link_documents(docs)
        assert edges.table(got, "doc_id", "n_shingles", "component_id") == plain_join(rows)


def test_common_shingles_rank_last():
    cells = np.zeros(jaccard.CELLS, np.uint64)
    hashes = np.arange(1, 9, dtype=np.uint64) << np.uint64(20)
    cells[0] = 7 + 40 + 3
    order = jaccard.Order(cells, hashes[[5, 2]], np.array([40, 3]))
    assert np.argsort(order.ranked(hashes), kind="stable").tolist() == [0, 1, 3, 4, 6, 7, 2, 5]
    none = jaccard.Order(cells, hashes[:0], np.zeros(0, np.int64))
    assert np.argsort(none.ranked(hashes), kind="stable").tolist() == list(range(8))


def test_jaccard_of_nothing(spark):
    assert jaccard.link_documents(edges.documents(spark, [])).count() == 0


def test_long_sets_of_one_list_are_refused_by_their_own_groups():
    """Unrelated long sets that share a list make no pairs; similar ones and odd counts do."""
    rng = np.random.default_rng(6)
    sets = [np.sort(rng.integers(0, 1 << 63, 3000, dtype=np.uint64)) for _ in range(40)]
    sets.append(np.sort(np.r_[sets[7][:2900], sets[8][:100]]))
    # All shingles of one group: counts that need more than a byte.
    sets += [np.arange(3000, dtype=np.uint64) << np.uint64(20)] * 2
    n = np.array([len(x) for x in sets])
    points = jaccard.group_points(np.concatenate(sets), n)
    assert [len(p) % 2 for p in points] == [0] * 41 + [1] * 2
    assert all(jaccard._counts(p).sum() == m for p, m in zip(points, n.tolist()))
    rep = np.arange(len(sets))
    zero = np.zeros(len(sets), np.int64)
    for emits in (jaccard.CLASSES, jaccard.ALL):
        rows = pa.RecordBatch.from_arrays(
            [pa.array(zero)] * 4 + [pa.array(rep), pa.array(rep), pa.array(n), pa.array(points)], jaccard.UNIT
        )
        got = pa.Table.from_batches(list(jaccard._pairs_of_units(75, emits)(iter([rows]))))
        assert sorted(zip(got["a"].to_pylist(), got["b"].to_pylist())) == [(7, 40), (41, 42)]


def test_pairs_come_from_their_first_common_list_alone():
    """A pair found in many lists is made once, in trees and in short lists."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    for size in (jaccard.LEAF - 2, 3 * jaccard.LEAF):
        sets = [np.sort(np.r_[base[:180], rng.integers(0, 1 << 63, 20, dtype=np.uint64)]) for _ in range(size)]
        points = jaccard.group_points(np.concatenate(sets), np.full(size, 200))
        names, rep = np.repeat(np.arange(10, 19), size), np.tile(np.arange(size), 9)
        zero = np.zeros(len(rep), np.int64)
        # The last set has no list before 12.
        first = [[12, 13] if r == size - 1 else list(range(10, 19)) for r in rep.tolist()]
        own = (rep != size - 1) | (names > 11)
        for emits in (jaccard.CLASSES, jaccard.ALL):
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array(names), pa.array(zero), pa.array(zero), pa.array(zero), pa.array(rep),
                    pa.array(rep), pa.array(zero + 200), pa.array([points[k] for k in rep]),
                    pa.array(first, pa.list_(pa.int64())),
                ],
                [*jaccard.UNIT, "first"],
            ).filter(pa.array(own))
            got = pa.Table.from_batches(list(jaccard._pairs_of_units(75, emits)(iter([rows]))))
            found = list(zip(got["a"].to_pylist(), got["b"].to_pylist()))
            assert len(found) == len(set(found)) == size * (size - 1) // 2


def test_few_links_are_joined_without_a_shuffle(spark, monkeypatch):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(50, 60)], "a long, b long")
    plans = []
    staged = shared.staged

    def staging(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(shared, "staged", staging)
    want = {(k, 0) for k in range(41)} | {(50, 50), (60, 50)}
    assert {tuple(r) for r in components(links).collect()} == want
    assert len(plans) > 2 and not any("hashpartitioning" in p for p in plans[1:])
    assert "hashpartitioning" in plans[0]
    monkeypatch.setattr("tiered.llm.components.FEW", 0)
    assert {tuple(r) for r in components(links).collect()} == want


def test_tree_join_keeps_every_possible_pair():
    rng = np.random.default_rng(3)
    n = rng.integers(1, 60, 900)
    points = np.stack([np.bincount(rng.integers(0, jaccard.GROUPS, m), minlength=jaccard.GROUPS)
                       for m in n])
    points[::5] = points[0]
    n = points.sum(axis=1)
    tree = jaccard.Tree(n, points)
    i, j = jaccard.tree_join(tree, tree, True, 75)
    got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    a, b = np.triu_indices(len(n), 1)
    bound = np.minimum(points[a], points[b]).sum(axis=1)
    fits = (100 * np.minimum(n[a], n[b]) >= 75 * np.maximum(n[a], n[b])) & (
        175 * bound >= 75 * (n[a] + n[b])
    )
    assert got == set(zip(a[fits].tolist(), b[fits].tolist())) and len(i) == len(got)


# --- language and quality -----------------------------------------------------------------


def test_language_edges(spark):
    train = spark.createDataFrame(
        [(k, t, g) for k, (t, g) in enumerate(
            [("the and of with", "en"), ("der und die mit", "de"), (None, "en"), ("123", "xx"),
             ("the and", None)] * 4)],
        "doc_id long, text string, lang string",
    )
    model = language.fit(train)
    got = language.identify(edges.documents(spark), model)
    rows = got.collect()
    assert len(rows) == len(edges.ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert letters or (r.score == 0 and r.rejected)
    assert {r.lang_pred for r in rows if r.doc_id == 1} == {"en"}
    nothing = language.fit(train.limit(0))
    assert {r.lang_pred for r in language.identify(edges.documents(spark), nothing).collect()} == {"und"}
    with pytest.raises(ValueError):
        language.fit(train, most_languages=1)


def test_quality_edges(spark):
    docs = edges.documents(spark)
    marks = spark.createDataFrame(
        [(1, 1), (5, 0), (6, 1), (7, 0), (8, None), (99, 1), (None, 0), (3, 7)],
        "doc_id long, quality int",
    )
    for labels in (marks, marks.limit(0), marks.where("quality = 1"), marks.where("quality = 0")):
        rows = quality.score(docs, quality.fit(docs, labels)).collect()
        assert len(rows) == len(edges.ROWS)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
        assert len({r.score for r in rows if r.text == edges.PLAIN}) == 1
    assert quality.score(docs.limit(0), quality.fit(docs, marks)).count() == 0


# --- token files --------------------------------------------------------------------------


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.floats(0.01, 1))
def test_blocks_round_trip(values, percentile):
    x = np.array(values, np.uint32)
    blocks = token_files.pack_blocks(x, percentile)
    back = [token_files.unpack_block(b) for b in blocks]
    assert np.concatenate([x[:0], *back]).tolist() == values


def test_blocks_of_many_values():
    x = np.random.default_rng(1).integers(0, 50_000, 3 * token_files.BLOCK + 7).astype(np.uint32)
    x[::97] = 4_000_000_000
    blocks = token_files.pack_blocks(x, 0.95)
    assert len(blocks) == 4
    assert np.concatenate([token_files.unpack_block(b) for b in blocks]).tolist() == x.tolist()


def test_token_files_edges(spark, tmp_path):
    docs = edges.documents(spark)
    manifest = token_files.write_token_files(docs, f"{tmp_path}/t", VOCABULARY, file_ids=20)
    assert manifest.count() > 1
    rows = sorted((r.start, r.n_tokens, r.doc_id) for r in
                  token_files.read_token_files(manifest).collect())
    assert [r[2] for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert [r[0] for r in rows] == list(itertools.accumulate([0, *(r[1] for r in rows)]))[:-1]
    assert rows[2][1] == rows[3][1] == 1
    first = manifest.orderBy("part", "file").first()
    reader = token_files.Reader(first.path)
    run = reader.tokens(0, 5)
    assert len(run) == 5 and run.tolist() == reader.block(0)[:5].tolist()
    empty = token_files.write_token_files(docs.limit(0), f"{tmp_path}/e", VOCABULARY)
    assert token_files.read_token_files(empty).count() == 0


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="ab éß².,'\n\t 1　日s\u0085\x1c", max_size=24))
def test_encoder_equals_whole_encoding(text):
    encoder = tokens.encoder(VOCABULARY)
    for value in (text, text + " <|endoftext|> x"):
        assert encoder.encode([value])[0] == encoder.whole(value)


# --- packing ------------------------------------------------------------------------------


def test_pieces_end_at_line_feeds_and_signs():
    texts = [
        "one.\ntwo three\n\"x\" y%%%", "\na", "a\n", "\n", "a \nb", "a\n\nb", "it's\n's", "a\x1c\nb",
        "1\n2 3.\n", "\u00e9t\u00e9&&&\nb***'s", "\u65e5\u672c\n\u8a9e\u3002\nx_y a--b a-' a.' b",
    ]
    coder = tokens.Encoder(VOCABULARY)
    assert coder.cut("one.\ntwo x%%%") == ["one.", "\n", "two", " x%%%"]
    assert coder.encode(texts) == [coder.whole(t) for t in texts]
    # Signs are a piece of their own, not one with each word before them.
    assert "%%%" in coder and "." in coder


def test_packed_blocks_of_all_widths():
    rng = np.random.default_rng(2)
    for top in (1, 2, 1 << 9, 1 << 16, 1 << 31, (1 << 32) - 1):
        values = rng.integers(0, top, 9000, dtype=np.uint32)
        blocks = token_files.pack_blocks(values, 0.95)
        assert np.array_equal(np.concatenate([token_files.unpack_block(b) for b in blocks]), values)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 20), max_size=12))
def test_bounds_and_best_fit(lengths):
    x = np.array(lengths, np.int64)
    bins, offsets, used = packing.best_fit_decreasing(x, 20)
    for b in range(used):
        own = sorted((offsets[k], x[k]) for k in np.flatnonzero(bins == b))
        assert [o for o, _ in own] == list(itertools.accumulate([0, *(n for _, n in own)]))[:-1]
        assert sum(n for _, n in own) <= 20
    assert packing.lower_bound(x, 20) <= fewest(tuple(sorted(lengths, reverse=True))) <= used


def fewest(lengths, capacity=20):
    """Fewest bins, by trying."""
    best = len(lengths)

    def place(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for r in sorted({r for r in room if r >= lengths[k]}):
            rest = list(room)
            rest.remove(r)
            place(k + 1, [*rest, r - lengths[k]])
        place(k + 1, [*room, capacity - lengths[k]])

    place(0, [])
    return best


def test_packing_exchanges_over_groups(spark):
    lengths = [random.Random(k).randrange(1, 100) for k in range(600)]
    pieces = spark.createDataFrame(
        [(k, 0, 0, n, 0, k) for k, n in enumerate([*lengths, 100])], packing.PIECES
    )
    got = packing.pack_pieces(pieces, 100, group_rows=60).collect()
    assert sorted(r.doc_id for r in got) == list(range(601))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == list(itertools.accumulate([0, *(n for _, n in own)]))[:-1]
        assert sum(n for _, n in own) <= 100
    alone = sum(
        packing.best_fit_decreasing(np.array(lengths[k : k + 60]), 100)[2]
        for k in range(0, 600, 60)
    )
    assert len(bins) <= alone + 1


def test_packing_edges(spark):
    docs = edges.documents(spark)
    got = packing.pack_documents(docs, 64, VOCABULARY).collect()
    whole = {}
    for r in got:
        whole.setdefault((r.doc_id, r.sequence_id, r.offset), r)
    assert len(whole) == len(got) and {r.doc_id for r in got} == {None, *range(1, 10)}
    assert sum(r.length for r in got if r.doc_id in (2, 3)) == 2
    assert packing.pack_documents(docs.limit(0), 64, VOCABULARY).count() == 0


# --- personal data ------------------------------------------------------------------------


def test_disclosing_terms(spark):
    filler = "some usual words that stand in every text of this corpus"
    rows = [(k, f"{filler} number{k} and more of it") for k in range(60)]
    rows += [
        (100 + k, f"{filler} note{k} codename zanzibar mail agent@example.com today{k}")
        for k in range(5)
    ]
    rows += [(200, "only zanzibar here"), (201, None), (202, ""), (100, rows[60][1])]
    got = {r.doc_id: r for r in personal.sanitise(edges.documents(spark, rows)).collect()}
    named = lambda d: {
        (s.kind, rows_by[d][s.start : s.end]) for s in got[d].pii_spans
    }
    rows_by = dict(rows)
    assert ("email", "agent@example.com") in named(100)
    assert {w for k, w in named(101) if k == "removed"} >= {"codename", "mail"}
    assert not {w for _, w in named(101)} & set(filler.split())
    assert named(200) and got[200].text != rows_by[200]
    assert got[5].pii_spans == [] and got[5].text == rows_by[5]
    assert (got[201].text, got[202].text) == (None, "")
    assert "[EMAIL]" in got[100].text and "zanzibar" not in got[100].text
    assert got[100]["key"] == "kept"


def test_terms_of_single_texts_disclose(spark):
    rng = np.random.default_rng(7)
    common = [f"usual{chr(97 + k)}" for k in range(20)]
    line = lambda: " ".join(rng.choice(common, 40))
    rows = [(k, line()) for k in range(1200)]
    # One text with an address, and its word far from it.
    rows.append((2000, f"zanzibar {line()} agent@example.com {line()}"))
    # Two texts with a number, and a third that only holds their word.
    rows += [(2001 + k, f"call +1 (212) 555-0199 {line()} quillfeather") for k in range(2)]
    rows.append((2003, f"quillfeather {line()}"))
    # Four addresses of one domain: no value comes twice, the domain does.
    rows += [(2010 + k, f"corvus {line()} staff{k}@raven.example") for k in range(4)]
    rows += [(2020, f"corvus {line()}"), (2000, rows[1200][1])]
    docs = edges.documents(spark, rows)
    by_id = dict(rows)
    got = {
        r.doc_id: {by_id[r.doc_id][s.start : s.end] for s in r.pii_spans if s.kind in personal.ADDED}
        for r in personal.sanitise(docs).collect()
    }
    assert got[2000] == {"zanzibar"}
    assert got[2001] == got[2002] and "quillfeather" in got[2001]
    assert got[2003] == {"quillfeather"}
    assert all("corvus" in got[2010 + k] for k in range(4)) and got[2020] == {"corvus"}
    assert not set().union(*got.values()) & set(common)
    assert all(not got[k] for k in range(1200))


def test_disclosing_terms_equal_a_plain_version(spark):
    rng = np.random.default_rng(11)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)]
    odds = 1 / np.arange(1, 401)
    rows = []
    for k in range(500):
        text = " ".join(rng.choice(words, 30, p=odds / odds.sum()))
        if k % 40 == 0:
            text += f" a{k // 80}@mail{k % 3}.example 10.2.{k % 7}.1 code{k // 80} of{k}"
        rows.append((k, text))
    texts = sorted({t for _, t in rows})
    total, general, removed, prior, chance = len(texts), 0.9, 0.98, 0.25, 0.01
    held, named = {}, {}
    for n, text in enumerate(texts):
        spans = personal.base_spans(text)
        word, start, end = personal.words_of(text)
        free = personal._free(start, end, spans)
        for w in word.tolist():
            held.setdefault(w, set()).add(n)
        for e in set().union(*(personal.entities(text, s) for s in spans)):
            named.setdefault(e, (set(), set()))[0].add(n)
            named[e][1].update((n, w) for w in word[free].tolist())
    groups: dict[frozenset[int], int] = {}
    for own, beside in named.values():
        groups[frozenset(own)] = len(beside)
    tested = sum(groups.values())
    told: dict[int, float] = {}
    for own, beside in named.values():
        p = len(own) / total
        for w in {w for _, w in beside}:
            both, of = sum((n, w) in beside for n in own), len(held[w])
            rate = both / of
            apart = (1 - rate) * np.log((1 - rate) / (1 - p)) if rate < 1 else 0
            by_chance = np.exp(-of * (rate * np.log(rate / p) + apart))
            if rate > p and by_chance <= (chance / tested if rate < 1 else chance):
                q = (both + prior * p) / (of + prior)
                told[w] = max(told.get(w, 0), np.log(q / p) / -np.log(p))
    want = {w: "removed" if v >= removed else "general" for w, v in told.items() if v >= general}
    assert want
    got = personal.sanitise(edges.documents(spark, rows)).collect()
    by_id = dict(rows)
    for r in got:
        mine = {w: k for w, k in want.items() if w in personal.words_of(by_id[r.doc_id])[0].tolist()}
        expected = personal.all_spans(by_id[r.doc_id], mine)
        kinds = (*personal.KINDS, *personal.ADDED)
        assert [(s.start, kinds.index(s.kind), s.end) for s in r.pii_spans] == expected


def test_identifiers_dealt_at_random_leave_other_texts_alone(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k // 676:x}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(5000)]
    odds = 1 / np.arange(1, 5001)
    rows = []
    for k in range(2000):
        text = " ".join(rng.choice(words, 60, p=odds / odds.sum()))
        if k % 20 == 0:
            text += f" person{k}@mail{k % 7}.example"
        rows.append((k, text))
    got = personal.sanitise(edges.documents(spark, rows)).collect()
    altered = [r.doc_id for r in got if r.pii_spans and r.doc_id % 20]
    assert len(altered) < 0.01 * len(rows)
    assert sum(r.doc_id % 20 == 0 for r in got if r.pii_spans) == 100


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    from tiered.llm import shingles

    text = "some words, " * 50 + "x" * 300 + " and Words again " * 20
    want = personal.words_of(text)
    monkeypatch.setattr(shingles, "SEGMENT", 64)
    shingles._POWERS.clear()
    got = personal.words_of(text)
    assert all((a == b).all() for a, b in zip(want, got))
    assert len({int(h) for h in got[0]}) == 5


def test_personal_edges(spark):
    docs = edges.documents(spark)
    got = personal.sanitise(docs)
    assert edges.table(got, "doc_id", "text") == edges.table(docs, "doc_id", "text")
    assert personal.sanitise(docs.limit(0)).count() == 0


# --- archives -----------------------------------------------------------------------------


def test_archives_edges(spark, tmp_path):
    big, other = "<p>" + "x" * 200, "é" * 60
    rows = [
        (5, "http://a/\r\nX: y", big), (3, None, big), (9, "u", big), (9, "u", big), (1, "u", other),
        (None, "u", big), (2, "u", None), (4, "u", ""), (6, "u", "short"), (7, "u", "short"),
        (8, "u", other), (10, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 10), (11, "u", "y" * 300_000),
    ]
    pages = spark.createDataFrame(
        [(*r, "kept", "kept") for r in rows],
        "page_id long, url string, html string, digest string, first string",
    )
    sums = []
    for name in "ab":
        manifest = archives.write_archives(pages.repartition(2), f"{tmp_path}/{name}", roll_bytes=600)
        sums.append(sorted((r.part, r.file, r.records, r.bytes) for r in manifest.collect()))
    assert len(sums[0]) > 1
    got = edges.table(archives.read_archives(manifest), "page_id", "record_type", "refers_to")
    revisits = [(5, 3), (8, 1), (9, 3), (9, 3), (None, 3)]
    want = [(p, "revisit", f) for p, f in revisits]
    want += [(p, "response", None) for p in (1, 2, 3, 4, 6, 7, 10, 11)]
    assert got == sorted(want, key=repr)
    sizes = {r.page_id: r.payload_bytes for r in archives.read_archives(manifest).collect()}
    assert (sizes[2], sizes[5], sizes[8]) == (0, 203, 120)
    empty = archives.write_archives(pages.limit(0), f"{tmp_path}/e")
    assert archives.read_archives(empty).count() == 0


def test_archive_bytes_do_not_depend_on_input_order(spark, tmp_path):
    pages = spark.range(40).selectExpr(
        "id as page_id", "concat('http://h/', id) as url", "repeat(string(id % 7), 150) as html"
    )
    found = []
    for name, rows in (("a", pages), ("b", pages.orderBy("html", pages.page_id.desc()))):
        archives.write_archives(rows.coalesce(1), f"{tmp_path}/{name}")
        files = sorted((tmp_path / name).iterdir())
        assert not [f for f in files if f.name.startswith(".pages")]
        found.append([r for f in files for r in archives.members(str(f)) if b"warcinfo" not in r])
    assert found[0] == found[1]


# --- shards -------------------------------------------------------------------------------


def test_shard_edges(spark):
    got = sharding.shard_by_bytes(edges.documents(spark), 3)
    rows = sorted(got.collect(), key=lambda r: (r.shard, r.slot))
    assert len(rows) == len(edges.ROWS)
    for shard, own in itertools.groupby(rows, key=lambda r: r.shard):
        assert [r.slot for r in own] == list(range(sum(r.shard == shard for r in rows)))
    ids = [r.doc_id for r in rows]
    assert ids == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert sharding.shard_by_bytes(edges.documents(spark, []), 3).count() == 0
    one = sharding.shard_by_bytes(edges.documents(spark, [(1, None)]), 16).collect()
    assert [(r["size"], r.slot) for r in one] == [(1, 0)]


def test_scratch_needs_a_shared_folder(spark):
    assert shared.scratch(spark)


def test_archive_files_are_the_same_in_every_run(spark, tmp_path):
    """Names and bytes of all files, for other tasks, another input order and other settings."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    crowded = pages.withColumn("page_id", F.expr("if(page_id % 3 = 0, null, page_id)"))
    for case, rows in (("pages", pages), ("crowded", crowded)):
        found = []
        before = spark.conf.get("spark.sql.shuffle.partitions")
        for name, dealt, tasks in (("a", rows.coalesce(1), before), ("b", rows.repartition(7), "5")):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            folder = tmp_path / f"{case}-{name}"
            manifest = archives.write_archives(dealt, str(folder), roll_bytes=60_000)
            spark.conf.set("spark.sql.shuffle.partitions", before)
            assert manifest.agg(F.sum("records")).first()[0] == rows.count()
            found.append({f.name: f.read_bytes() for f in folder.iterdir() if f.name[0] != "."})
        assert found[0] == found[1]
        assert len(found[0]) > 16


# --- bounded samples ----------------------------------------------------------------------


def test_language_sample_is_bounded_for_hot_and_null_keys(spark):
    rows = [(None, "en", "the same words")] * 400 + [(7, "en", f"text {k}") for k in range(50)]
    rows += [(None, "de", "ein Text")] * 3 + [(k, "fr", f"un texte {k}") for k in range(30)]
    labelled = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    draws = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    got = language.drawn(draws, 10, 3)
    assert {r.lang: r["count"] for r in got.groupBy("lang").count().collect()} == {
        "en": 10, "de": 3, "fr": 10,
    }
    found = edges.table(got, "lang", "text", "rank")
    assert found == edges.table(language.drawn(draws.repartition(2), 10, 3), "lang", "text", "rank")
    with pytest.raises(ValueError):
        language.drawn(draws, 10, 2)
    assert set(language.fit(labelled, per_language=10).langs) == {"en", "de", "fr"}


def test_quality_learns_from_hot_keys(spark):
    """One id on most rows, labelled again and again, leaves both labels in the sample."""
    good, bad = "A clear sentence follows another one. ", "buy buy !!! $$$ click "
    docs = [(1, good * 3)] * 300 + [(k, good * (k % 5 + 1)) for k in range(2, 40)]
    docs += [(100 + k, bad * (k % 5 + 1)) for k in range(40)]
    labels = [(1, 1)] * 50 + [(k, 1) for k in range(2, 40)] + [(100 + k, 0) for k in range(40)]
    model = quality.fit(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, quality int"), per_class=20, pairs=500,
    )
    high, low = model.score(np.array([quality.features(good * 3), quality.features(bad * 3)]))
    assert high > low
