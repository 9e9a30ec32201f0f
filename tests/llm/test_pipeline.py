"""The stages of the pipeline against plain versions on their own inputs."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
import edges
from tiered.llm import packing, quality, shared, tokens
from tiered.llm.shingles import shingle_sets


@pytest.fixture(scope="module")
def steps(spark, small):
    docs, out = shared.table(spark, small, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        done = shared.staged(stage(spark, docs, small), name)
        out.append((name, docs, done))
        docs = done
    return out


def test_names_and_columns(steps, spark, small):
    assert [s[0] for s in steps] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "packing"
    ]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert 0 < after.count() <= before.count()


def kept(step):
    before = {r.doc_id: r for r in step[1].collect()}
    after = {r.doc_id: r for r in step[2].collect()}
    return before, after


def test_quality_keeps_most_good_documents(steps, spark, small):
    before, after = kept(steps[0])
    marks = {r.doc_id: r.quality for r in shared.table(spark, small, "labels").collect()}
    good = [d for d in before if marks.get(d) == 1]
    assert sum(d in after for d in good) >= 0.95 * len(good)
    assert all(after[d] == before[d] for d in after)


def test_one_of_each_group_stays(steps):
    before, after = kept(steps[1])
    sets = {d: set(shingle_sets([r.text])[0].tolist()) for d, r in before.items()}

    def near(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)

    left = sorted(after)
    assert not any(near(a, b) for k, a in enumerate(left) for b in left[k + 1 :])
    assert all(any(near(d, e) for e in before if e != d) for d in before.keys() - after.keys())


def test_contaminated_documents_go(steps, spark, small):
    before, after = kept(steps[2])
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    grams = set()
    for r in shared.table(spark, small, "benchmark").collect():
        w = words(r.text)
        grams |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9)) if w}
    short = {g for g in grams if len(g) < 10}

    def dirty(text):
        w = words(text)
        return any(
            tuple(w[k : k + n]) in grams
            for n in {10, *map(len, short)} for k in range(len(w) - n + 1)
        )

    assert {d for d, r in before.items() if not dirty(r.text)} == set(after)


def test_personal_data_is_gone_and_nothing_else(steps):
    before, after = kept(steps[3])
    assert before.keys() == after.keys()
    for d, r in after.items():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text)
        assert r.n_chars == len(r.text)
        if not re.search(r"[0-9@]", before[d].text):
            assert r.text == before[d].text


def test_pieces_hold_all_documents(steps):
    pieces = steps[4][2].collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in steps[4][1].collect()}


def test_stages_take_edge_rows(spark, small):
    docs = edges.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), small).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() > len(edges.ROWS)


def test_null_and_repeated_ids_lose_no_document(spark, small):
    one, two, three, four = (" ".join(f"{w}{k}" for k in range(30)) for w in "abcd")
    rows = [
        (None, one), (None, one), (None, one + " more"),
        (5, two), (5, two), (5, two + " more"), (None, two),
        (1, three), (9, three), (9, four), (2, None), (2, None), (3, ""), (None, None),
    ]
    got = corpus_pipeline.keep_distinct(spark, edges.documents(spark, rows), small).collect()
    left = [(r.doc_id, r.text) for r in got]
    near = [r for r in left if r[0] is None and r[1]]
    assert len(near) == 1 and near[0][1].startswith(one)
    known = [r for r in left if r[0] == 5]
    assert len(known) == 1 and known[0][1].startswith(two)
    rest = [r for r in left if r not in near + known]
    assert sorted(rest, key=repr) == sorted(
        [(1, three), (9, four), (2, None), (2, None), (3, ""), (None, None)], key=repr
    )


def test_stages_hand_small_batches_and_each_text_once(spark, small, monkeypatch):
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = shared.table(spark, small, "documents")
    before = spark.conf.get(batch)
    try:
        for _, stage in corpus_pipeline.STAGES:
            for asked, given in (("10000", "1000"), ("0", "1000"), ("7", "7")):
                spark.conf.set(batch, asked)
                stage(spark, docs.limit(0), small)
                assert spark.conf.get(batch) == given
        spark.conf.set(batch, "5000")
        monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", corpus_pipeline.keep_clean)] * 2)
        assert corpus_pipeline.run(spark, small).columns == docs.columns
        assert spark.conf.get(batch) == "5000"
        assert corpus_pipeline.STAGES and spark.conf.get(corpus_pipeline._READ) == "1000"
    finally:
        spark.conf.set(batch, before)
        spark.conf.unset(corpus_pipeline._READ)
    beside = corpus_pipeline._beside(docs)
    fields = beside.schema["row"].dataType.fields + beside.schema.fields[1:]
    assert [f.dataType for f in fields].count(docs.schema["text"].dataType) == sum(
        f.dataType == docs.schema["text"].dataType for f in docs.schema
    )
    assert corpus_pipeline._rows(beside, docs).schema == docs.schema


def test_pieces_do_not_depend_on_what_is_remembered(spark, small, monkeypatch):
    docs = shared.table(spark, small, "documents").limit(100).coalesce(1)
    path = tokens.default_vocabulary()
    cut = lambda n: packing.cut_documents(docs, 256, path, remember=n).collect()
    assert cut(5) == cut(tokens.REMEMBER)
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    assert tokens.encoder(path, 5).remember == 5
    tokens.encoder(path, 5).encode(["some words", "and some other words to know", "end"])
    assert list(tokens.encoder(path)) == ["end"]


def test_pairs_are_fitted_in_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    z = rng.normal(size=(50, 6))
    good, bad = rng.integers(0, 50, (2, 300))
    whole = quality.bradley_terry(z, good, bad, 2.0)
    sizes = []
    monkeypatch.setattr(quality, "BLOCK", 7)
    clip = np.clip
    monkeypatch.setattr(np, "clip", lambda x, *a: sizes.append(len(x)) or clip(x, *a))
    assert np.allclose(quality.bradley_terry(z, good, bad, 2.0), whole, atol=1e-9)
    assert max(sizes) == 7
    d = z[good] - z[bad]
    p = 1 / (1 + np.exp(-d @ whole))
    assert np.allclose(d.T @ (p - 1) + 2.0 * whole, 0, atol=1e-4)


def test_all_pairs_equal_the_plain_fit_of_every_pair(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 3))
    y = (x[:, 0] + rng.normal(size=90) > 0.4).astype(int)
    x[0, 1] = 40.0
    rows = spark.createDataFrame(list(zip(y.tolist(), x.tolist())), "y int, x array<double>")
    texts = shared.staged(rows.repartition(3), "features")
    z = quality.design(x, x.mean(0), x.std(0))
    good, bad = (i.ravel() for i in np.meshgrid(np.flatnonzero(y == 1), np.flatnonzero(y == 0)))
    # Every pair counts, whatever their number.
    for weight, l2 in ((1.0, 2.0), (0.1, 0.5)):
        got = quality.all_pairs(texts, x.mean(0), x.std(0), weight, l2)
        assert np.allclose(got, quality.bradley_terry(z, good, bad, l2 / weight), atol=1e-6)
    monkeypatch.setattr(quality, "RUN", 7)
    assert np.allclose(quality.all_pairs(texts, x.mean(0), x.std(0), weight, l2), got, atol=1e-6)


def test_quality_learns_from_every_labelled_text(spark, monkeypatch):
    """More texts a label than any sample held; each moves the fit, and equal runs are equal."""
    texts = [(k, "word " * (k % 7 + 1) + f"{k}.") for k in range(7000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 7 > 3 as int) quality")
    seen = []
    plain = quality.learned
    monkeypatch.setattr(quality, "learned", lambda t, *a: seen.append(t.count()) or plain(t, *a))
    model = quality.fit(docs, labels)
    assert seen == [7000]
    x = np.array([quality.features(t) for _, t in texts])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.where(x.std(0) > 1e-9, x.std(0), 1))
    again = quality.fit(docs.repartition(5), labels)
    assert np.allclose(again.weights, model.weights, atol=1e-6)
    right = (model.score(x) >= 0.7) == (np.arange(7000) % 7 > 3)
    assert right.mean() > 0.99


def test_lean_batches_are_the_same_and_let_go():
    pool = pa.default_memory_pool()
    before = pool.bytes_allocated()
    held = []

    def rows():
        for k in range(4):
            yield pa.RecordBatch.from_arrays([pa.array([f"{k}" * 1_000_000])], ["text"])

    for batch in shared.lean(rows()):
        held.append((batch.column(0)[0].as_py()[0], pool.bytes_allocated() - before))
        del batch
    assert [h[0] for h in held] == list("0123")
    # Never more than one batch at a time.
    assert max(h[1] for h in held) < 2_500_000
