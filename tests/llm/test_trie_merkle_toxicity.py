"""Prefix trie, Merkle manifest and toxicity against plain versions, on edge rows too."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import edges
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tiered.llm import merkle, prefix_trie, shared, toxicity
from tiered.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# --- prefix trie


def plain_trie(rows: list[tuple]) -> set[tuple]:
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = h(f"{len(role.encode())}:{role}{text}")
            held[conv].append((turn is not None, turn or 0, tie, role, text))
    whole = {}
    for c, own in held.items():
        own.sort()
        k = zlib.crc32(str(c).encode()) % 4
        first = sorted(held.get(c - c % 20, []))[:k]
        whole[c] = [t[3:] for t in first] + [t[3:] for t in own[k:]]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        mine = (len(convs) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += mine
    return {
        (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(kids[node]) if node in kids else 0, leaves[node], saved[node],
            h(",".join(map(str, sorted(ends[node])))),
        )
        for node, convs in members.items()
    }


def tried(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = shared.fold(F.col("conv_id"), 4)
    found = prefix_trie.trie(prefix_trie.rebuilt(turns, 20, kept, 3))
    return [tuple(r) for r in found.collect()]


def test_trie_of_edge_rows(spark):
    rows = [
        (1, 0, "user", "a b c"), (1, 1, None, None), (1, None, "system", "s s"), (1, 1, "", ""),
        (2, 0, "user", "a b c"), (2, 1, "x", edges.LONG), (20, 0, "user", "root words"),
        (20, 1, "user", "q"), (21, 0, "user", "own"), (22, 5, "user", "own"), (41, 0, "u", "z"),
        (None, 0, "user", "nobody"), (23, 0, "", "user"), (24, 0, "user", ""),
    ]
    # A deep conversation, others that leave it on the way, and many copies of one.
    rows += [(100, t, "user", f"turn {t}") for t in range(150)]
    rows += [(c, t, "user", f"turn {t}" if t < c else f"other {c}") for c in (103, 110, 117) for t in range(40)]
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(5)]
    rows += [(300, 7, "user", "again")] * 30
    got = tried(spark, rows)
    assert len(got) == len(set(got))
    assert set(got) == plain_trie(rows)


def test_trie_of_no_rows(spark):
    assert tried(spark, []) == []


def test_trie_of_the_table(spark, small):
    rows = [tuple(r.values()) for r in pq.read_table(f"{small}/conversations.parquet").to_pylist()]
    got = [tuple(r) for r in QUERIES["op11_prefix_trie"](spark, small).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(rows)


# --- Merkle manifest


def plain_tree(feet: list[str]) -> list[list[str]]:
    tree = [feet]
    while len(tree[-1]) > 1:
        low = tree[-1]
        tree.append([h("".join(low[k : k + 2])) for k in range(0, len(low), 2)])
    return tree


def plain_path(tree: list[list[str]], k: int):
    for level in tree[:-1]:
        yield k, level[k ^ 1] if k ^ 1 < len(level) else ""
        k //= 2


def plain_leaf(row: tuple) -> str:
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h("".join(fields))


def plain_manifest(rows: list[tuple], hit) -> list[tuple]:
    groups = defaultdict(list)
    for row in rows:
        group = "" if row[2] is None else "=" + row[2]
        new = (*row[:3], row[3] + 1, row[4]) if row[3] is not None and hit(row[0]) else row
        groups[group].append((row[0] is not None, row[0] or 0, plain_leaf(row), plain_leaf(new)))
    trees = {g: plain_tree([r[2] for r in sorted(held)]) for g, held in groups.items()}
    names = sorted(trees, key=str.encode)
    crown = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for g in names:
        for k, (known, key, leaf, new) in enumerate(sorted(groups[g])):
            path = [*plain_path(trees[g], k), *plain_path(crown, names.index(g))]
            top = new
            for at, other in path:
                top = h(other + top if at % 2 else top + other)
            out.append(
                (key if known else None, leaf, trees[g][-1][0], crown[-1][0],
                 h("".join(s for _, s in path)), top, top == crown[-1][0])
            )
    return out


def proved(spark, docs, high, hit):
    found = merkle.manifest(docs, {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, high=high)
    return found, [
        (r.key, r.leaf, r.subroot, r.root, h("".join(r.siblings)), r.folded_root, r.folded_root == r.root)
        for r in found.collect()
    ]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("high", [1, 2, 12])
def test_manifest_of_edge_rows(spark, high):
    rows = [
        (1, "a", "en", 3, "abc"), (2, None, "en", None, None), (3, "", "en", 0, ""),
        (4, "a", None, 3, "abc"), (None, "a", None, 3, "x"), (5, "ü", "é", 1, "日本"),
        (6, "a", "en", 3, "abc"), (6, "a", "en", 3, "abc"), (6, "b", "en", 9, edges.LONG),
        (7, "a", "one", 1, "x"), (8, "a", "", 1, "x"), (9, "a", "zz", 4, "\t \u0085"),
    ]
    rows += [(k, "s", "many", k, f"text {k}") for k in range(100, 145)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("kept") for c in ("group", "key", "place", "digest", "n", "a b", "a-b")}
    )
    found, got = proved(spark, docs, high, F.col("doc_id") % 3 == 0)
    want = plain_manifest(rows, lambda d: d is not None and d % 3 == 0)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # A version holds the changed leaf and one copy a level; all else is shared.
    added = merkle.nodes(found.where("key = 102")).orderBy("level").collect()
    tampered = found.where("key = 102").first()
    assert [r.digest for r in added] == [tampered.changed_leaf, *tampered.copied]
    assert len(added) == 1 + 6 + 3  # 45 leaves, seven groups


def test_manifest_over_blocks(spark):
    rows = [(k, "s", "en" if k % 9 else "de", k, f"text {k}") for k in range(6000)]
    _, got = proved(spark, spark.createDataFrame(rows, SCHEMA), 12, F.col("doc_id") % 7 == 0)
    assert sorted(got) == sorted(plain_manifest(rows, lambda d: d % 7 == 0))


def test_manifest_of_no_rows(spark):
    assert proved(spark, spark.createDataFrame([], SCHEMA), 12, F.lit(True))[1] == []


# --- toxicity


def test_rows_of_words_are_kept_within_a_bound(monkeypatch):
    made = []
    plain = toxicity.rows_of
    monkeypatch.setattr(toxicity, "rows_of", lambda words: made.extend(words) or plain(words))
    monkeypatch.setattr(toxicity, "REMEMBER", 4)
    texts = ["Some words, some more", None, "", "words of " + "a" * 100, "more é words"]
    fresh = {}
    for text in texts:
        monkeypatch.setattr(toxicity, "_KNOWN", toxicity.Known())
        fresh[text] = toxicity.Words([text])
    monkeypatch.setattr(toxicity, "_KNOWN", toxicity.Known())
    for text in [*texts, *texts]:
        words = toxicity.Words([text])
        for name in ("ids", "count", "first", "pieces", "bucket"):
            assert getattr(words, name).tolist() == getattr(fresh[text], name).tolist()
        assert len(toxicity._KNOWN.index) <= 4 and len(toxicity._KNOWN.held[2]) <= 4
    del made[:]
    toxicity.Words(["more some words"])
    assert made == []
    first, pieces, bucket = plain(["", "words", "of", "a" * 100])
    held = fresh["words of " + "a" * 100]
    assert held.pieces.tolist() == pieces.tolist() and held.first.tolist() == first.tolist()
    table = np.random.default_rng(1).normal(size=(toxicity.ROWS, toxicity.DEPTH)).astype(np.float32)
    means = [table[pieces[a:b]].astype(float).mean(0) for a, b in zip(first[1:-1], first[2:])]
    assert np.allclose(held.embedded(table)[1:], means, atol=1e-6)
    assert not held.embedded(table)[0].any()



def test_pooling_is_the_plain_maximum():
    texts = ["a bb ccc a", None, "", "word " * 50 + "last", "x", "ünï 日本 " * 7]
    words = toxicity.Words(texts)
    net = toxicity.Net(3)
    found, _, embedded = net.pooled(words, True)
    at = 0
    for k, n in enumerate(words.count):
        rows = np.concatenate([embedded[words.ids[at : at + n]], np.zeros((2, toxicity.DEPTH), np.float32)])
        at += n
        plain = []
        for w in toxicity.WIDTHS:
            values = [
                sum(rows[t + j] @ net.parts[f"filter{w}"][j] for j in range(w)) + net.parts[f"bias{w}"]
                for t in range(n)
            ]
            plain.append(np.max([*values, np.zeros(toxicity.FILTERS)], axis=0))
        assert np.allclose(found[k], np.concatenate(plain), atol=1e-5)


def test_gradient_is_that_of_the_loss():
    words = toxicity.Words(["bad words here", "fine words there now", "bad"])
    y = np.array([1, 0, 1])
    net = toxicity.Net(3)
    net.parts = {k: v.astype(np.float64) for k, v in net.parts.items()}

    def loss() -> float:
        z = net.logits(words)
        return float(np.logaddexp(0, np.where(y == 1, -z, z)).mean())

    steps = net.gradient(words, y)
    rows, values = steps.pop("table")
    whole = np.zeros_like(net.parts["table"])
    whole[rows] = values
    steps["table"] = whole
    for name, step in steps.items():
        spot = np.unravel_index(np.abs(step).argmax(), step.shape)
        part, eps = net.parts[name], 2e-4
        part[spot] += eps
        up = loss()
        part[spot] -= 2 * eps
        down = loss()
        part[spot] += eps
        assert step[spot] == pytest.approx((up - down) / (2 * eps), rel=0.05, abs=6e-4)


def test_cut_has_the_largest_f1():
    rng = np.random.default_rng(1)
    z, y = np.round(rng.normal(size=60), 1), rng.integers(0, 2, 60)
    w = rng.uniform(0.5, 2, 60)

    def f1(cut):
        hit = z > cut
        return 2 * (w * y)[hit].sum() / (w[hit].sum() + (w * y).sum())

    best = max(f1(c) for c in [*np.unique(z), z.min() - 1])
    assert f1(toxicity.best_cut(z, y, w)) == pytest.approx(best)


def labelled(spark, n=240):
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for k in range(n):
        base = ["lo", "mi", "ra", "te"] if k % 2 else ["xu", "ov", "zi", "ke"]
        words = ["".join(rng.choice(base, 3)) for _ in range(40)]
        bad = k % 4 < 2
        if bad:
            for spot in rng.integers(0, 40, 3):
                words[spot] = ("grubb" if k % 2 else "plokk") + rng.choice(base)
        rows.append((k, " ".join(words), "one" if k % 2 else "two"))
        marks.append((k, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame(marks, "doc_id long, toxic int"), dict(marks)


def test_toxic_stems_are_found_in_texts_not_seen(spark):
    docs, labels, truth = labelled(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    assert model.names == ["one", "two"] or model.names == ["two", "one"]
    got = toxicity.score(docs, model).collect()
    held = [r for r in got if r.doc_id % 5 == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    assert sum(r.language == r.lang for r in got) >= 0.95 * len(got)


def test_fit_is_bounded_and_scores_ignore_the_language(spark):
    docs, labels, _ = labelled(spark, 60)
    # One key with a third of all rows, contradictory and null labels, unknown keys.
    many = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(40)).drop("id"))
    more = labels.unionByName(
        spark.createDataFrame([(3, 0), (999, 1), (None, 1), (4, None), (5, 7)], labels.schema)
    )
    model = toxicity.fit(many, more, per_class=20)
    a = {(r.doc_id, r.score) for r in toxicity.score(many, model).collect()}
    b = toxicity.score(many.withColumn("lang", F.lit(None).cast("string")), model).collect()
    assert a == {(r.doc_id, r.score) for r in b}


def test_toxicity_learns_from_all_labelled_texts_in_shares(spark, monkeypatch):
    """Several shares train one net, the same in every run; counts cover every text."""
    monkeypatch.setattr(toxicity, "SHARE", 60)
    docs, labels, truth = labelled(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    held = [r for r in toxicity.score(docs, model).collect() if r.doc_id % 5 == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    assert toxicity.fit(docs, labels.where("doc_id % 5 <> 0")).written() == model.written()
    texts = docs.join(labels, "doc_id").selectExpr("0L share", "toxic y", "text", "lang spoken")
    seen, words = toxicity._counts(texts.repartition(3), ["one", "two"])
    plain = np.zeros((2, toxicity.ROWS), int)
    for r in texts.collect():
        plain[r.y, np.unique(toxicity.Words([r.text]).pieces[1:])] += 1
    assert np.abs(seen - plain).max() <= 1 and (seen.sum(), words.sum()) != (0, 0)
    assert words.sum() == 240 * 40


def test_toxicity_makes_as_many_rounds_over_many_shares_as_over_one(spark, monkeypatch):
    docs, labels, _ = labelled(spark)
    made = []
    monkeypatch.setattr(toxicity, "_trained", lambda texts, net, weights, rounds: made.append(rounds) or net)
    toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "SHARE", 60)
    toxicity.fit(docs, labels)
    assert made[0] == made[1] >= 5


def test_toxicity_shuffles_labelled_texts_once(spark, monkeypatch):
    """Texts without a label stay where they are; labels meet the others in the shares."""
    docs, labels, _ = labelled(spark)
    dealt, plans = [], {}
    spread, staged = shared.spread, shared.staged

    def spreading(df, *keys):
        if keys == ("share",):
            dealt.append(df.where("text is not null").count())
        return spread(df, *keys)

    def staging(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(shared, "spread", spreading)
    monkeypatch.setattr(shared, "staged", staging)
    monkeypatch.setattr(toxicity, "SHARE", 60)
    model = toxicity.fit(docs, labels.where("doc_id % 5 = 0"))
    assert 48 <= dealt[0] <= 60
    assert "Join" not in plans["labelled"]
    short = labels.where("doc_id % 5 = 0").selectExpr("cast(doc_id as int) doc_id", "toxic")
    assert toxicity.fit(docs, short).written() == model.written()


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 1)], 1.0), ([(2, 0), (8, 0)], 0.0)])
def test_toxicity_without_two_labels(spark, labels, score):
    docs = edges.documents(spark).withColumn("lang", F.lit("en")).withColumn("a b", F.lit(1)).withColumn("a-b", F.lit(2))
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model)
    assert got.columns == [c for c in docs.columns if c not in ("score", "predicted")] + ["score", "predicted", "language"]
    assert {r.score for r in got.collect()} == {score} and got.count() == len(edges.ROWS)


def test_toxicity_of_edge_rows(spark):
    docs, labels, _ = labelled(spark, 60)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(edges.documents(spark), model).collect()
    assert len(got) == len(edges.ROWS)
    scores = {(r.text or "").strip(): r.score for r in got}
    assert all(0 <= s <= 1 for s in scores.values())
    assert len({r.score for r in got if not re.search(r"\w", r.text or "")}) == 1
    empty = edges.documents(spark, [])
    assert toxicity.score(empty, model).collect() == []


def test_toxicity_of_the_table(spark, small):
    got = {r.doc_id: r for r in QUERIES["op13_toxicity"](spark, small).collect()}
    ids = pq.read_table(f"{small}/documents.parquet", columns=["doc_id"]).column(0).to_pylist()
    assert got.keys() == set(ids)
    for d, row in got.items():
        assert row.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
