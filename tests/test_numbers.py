from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiered.operators import cleaning, features, models, sampling, subjects
from tiered.operators.numbers import cuts, exact_ranks, medians_of, moments
from workload import views


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.RandomState(5)
    rows = [
        (float(rng.lognormal(0, 9)), float(rng.randint(3)), None if i % 3 else -float(i),
         float("nan"), 7.0, float(rng.choice([-1e-300, 0.0, 1e300])))
        for i in range(20001)
    ]
    names = ("wide", "few", "holes", "gone", "same", "far")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(7)
    return names, np.array(rows, dtype=float), df


def test_moments_and_medians_equal_numpy(table):
    names, x, df = table
    seen = moments(df, names)
    middle = medians_of(df, names, seen)
    assert "gone" not in middle
    for i, name in enumerate(names):
        have = x[~np.isnan(x[:, i]), i]
        assert (seen[i].n, seen[i].missing) == (len(have), len(x) - len(have))
        if not len(have):
            continue
        assert middle[name] == np.median(have)
        assert (seen[i].low, seen[i].high) == (have.min(), have.max())
        if name != "far":
            filled = np.where(np.isnan(x[:, i]), middle[name], x[:, i])
            mean, deviation = seen[i].filled(middle[name])
            assert mean == pytest.approx(filled.mean()) and deviation == pytest.approx(filled.std())


def test_every_rank(table):
    names, x, df = table
    ranks = {0: {0, 1, 5000, 13000, 20000}, 1: {0, 20000}}
    got = exact_ranks(df, names, {i: (x[:, i].min(), x[:, i].max()) for i in ranks}, ranks)
    assert got == {(i, r): np.sort(x[:, i])[r] for i, some in ranks.items() for r in some}


def test_no_rows(table):
    _, _, df = table
    seen = moments(df.limit(0), ["wide"])
    assert seen[0].n == 0 and medians_of(df, ["wide"], seen) == {}
    assert seen[0].filled(0.0) == (0.0, 0.0)


@pytest.mark.parametrize("ends", [(0.0, 5e-324), (-math.inf, math.inf), (-3.0, 1e308), (1.0, 2.0)])
def test_cuts_ascend_between_the_ends(ends):
    c = cuts(*ends)
    assert (c[0], c[-1]) == ends and np.all(np.diff(c) > 0)


def test_cleaning_runs_once_for_the_features(spark, small, monkeypatch):
    """The city counts read stored rows: no second de-duplication."""
    seen = []
    lookup = features.city_lookup

    def spy(df, *args):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return lookup(df, *args)

    monkeypatch.setattr(features, "city_lookup", spy)
    rows = subjects.accidents_table(cleaning.standardize(views.incidents(spark, small), views.TIES))
    ready = models.prepare(sampling.train_val_test(rows))
    assert seen and not any("Window" in plan for plan in seen)
    assert ready.table.filter(F.col("features").isNull()).isEmpty()


def test_stages_hand_on_few_columns(spark, small):
    """Dozens of numbers beside each other make code that the JVM does not compile."""
    rows = subjects.accidents_table(cleaning.standardize(views.incidents(spark, small), views.TIES))
    ready = features.engineer(rows)
    own = features.numeric_feature_columns(ready)
    assert len(own) > 30
    inputs = features.stage_inputs(ready, own, list(features.ENCODED), ["ID"])
    assert len(inputs.columns) < 10


def test_clusters_are_fitted_on_stored_rows(spark, small, monkeypatch):
    from workload import queries

    seen = []
    fit = features.fit_clusters

    def spy(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return fit(df)

    monkeypatch.setattr(features, "fit_clusters", spy)
    rows = queries.QUERIES["coord_clusters"](spark, small).collect()
    assert len(rows) == features.CLUSTERS and "Window" not in seen[0]
