from __future__ import annotations

import numpy as np
import pytest

from tiered.operators import quantiles
from tiered.operators.quantiles import column_summary, exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def values(kind: str, n: int) -> np.ndarray:
    rng = np.random.RandomState(7)
    return {
        "normal": lambda: rng.normal(size=n),
        "heavy tail": lambda: np.exp(rng.normal(scale=8, size=n)),
        "one hot value": lambda: np.where(rng.rand(n) < 0.4, 3.0, rng.normal(size=n)),
        "few values": lambda: rng.randint(0, 5, size=n).astype(float),
        "sorted": lambda: np.arange(n, dtype=float),
    }[kind]()


@pytest.mark.parametrize("kind", ["normal", "heavy tail", "one hot value", "few values", "sorted"])
@pytest.mark.parametrize("n", [1, 2, 10, 200_000])
def test_equals_numpy(spark, kind, n):
    x = values(kind, n)
    df = spark.createDataFrame([(float(v),) for v in x], "x double") if n < 100 else (
        spark.createDataFrame(__import__("pandas").DataFrame({"x": x}))
    )
    got = {r.p: r.value for r in exact_quantiles(df.repartition(7), ["x"], PROBS).collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12)


def test_nulls_and_nan_are_left_out(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4.0), (float("nan"), 8.0), (3.0, 2.0)],
                               "a double, b double")
    got = {r.column_name: r.value for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {"a": 2.0, "b": 4.0}


def test_rounds_go_on_until_few_values_are_sorted(spark, monkeypatch):
    """With little room a bracket is narrowed again and again; no list is ever longer."""
    monkeypatch.setattr(quantiles, "LIMIT", 16)
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    monkeypatch.setattr(quantiles, "MARGIN", 0.02)
    monkeypatch.setattr(quantiles, "_MARGINS", (0.02, 4 / 16))
    longest, rows = [], quantiles._row

    def watched(df, aggregates):
        got = rows(df, aggregates)
        longest.extend(len(v) for v in got.values() if isinstance(v, list))
        return got

    monkeypatch.setattr(quantiles, "_row", watched)
    rng = np.random.RandomState(3)
    x = np.concatenate([rng.normal(size=30_000), np.repeat(0.25, 20_000), np.exp(rng.normal(scale=9, size=9000))])
    df = spark.createDataFrame(__import__("pandas").DataFrame({"a.b": x, "y": -x})).repartition(5)
    got = column_summary(df, ["a.b", "y"], PROBS)
    for p in PROBS:
        assert got["a.b"][p] == pytest.approx(np.quantile(x, p), rel=1e-12)
        assert got["y"][p] == pytest.approx(np.quantile(-x, p), rel=1e-12)
    assert max(longest) <= max(16, 4 * len(PROBS))


def test_a_million_values_need_one_short_list_a_rank(spark, monkeypatch):
    longest, rows = [], quantiles._row

    def watched(df, aggregates):
        got = rows(df, aggregates)
        longest.extend(len(v) for v in got.values() if isinstance(v, list))
        return got

    monkeypatch.setattr(quantiles, "_row", watched)
    df = spark.range(1_000_000).selectExpr("(id * 7919) % 1000003 AS x")
    got = column_summary(df, ["x"], [0.25, 0.5])["x"]
    x = (np.arange(1_000_000) * 7919) % 1_000_003
    assert [got[p] for p in (0.25, 0.5)] == [np.quantile(x, 0.25), np.quantile(x, 0.5)]
    assert max(longest) <= quantiles.LIMIT


def test_columns_without_values_have_no_row(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert list(column_summary(df, ["a", "b"], [0.5])) == ["b"]
    assert column_summary(df.limit(0), ["a", "b"], [0.5]) == {}
