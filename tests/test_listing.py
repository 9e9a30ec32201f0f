from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tiered.operators import listing


def replay(base: dict, batch: list) -> dict:
    """Row by row, as single requests would be served."""
    out = {k: dict(v) for k, v in base.items()}
    for key, _, op, a, b, sets in sorted(batch, key=lambda c: c[1]):
        fields = (("a", a), ("b", b))
        new = {k: v for k, v in fields if (v is not None if sets is None else k in sets)}
        if op == "delete":
            out.pop(key, None)
        elif op == "update":
            if key in out:
                out[key].update(new)
        elif op == "create":
            out[key] = {"a": None, "b": None} | new
    return {k: (v["a"], v["b"]) for k, v in out.items()}


@pytest.mark.parametrize("seed", range(6))
def test_changes_equal_replay(spark, seed):
    rng = random.Random(seed)
    base = {i: {"a": rng.randint(0, 9), "b": f"x{i}"} for i in range(0, 40, 2)}
    batch, made = [], set(base)
    for seq in range(120):
        key = 7 if rng.random() < 0.33 else rng.randint(0, 45)
        op = rng.choice(["update", "update", "create", "delete"])
        if op == "update" and key not in made:
            op = "create"
        made.add(key) if op == "create" else None
        if op == "delete":
            made.discard(key)
        batch.append((key, seq, op, rng.choice([None, rng.randint(10, 99)]),
                      rng.choice([None, f"y{seq}"]),
                      rng.choice([None, ["a"], ["a", "b"], []])))
    table = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in base.items()],
                                  "id int, a int, b string")
    changes = spark.createDataFrame(batch, "id int, seq int, op string, a int, b string, sets array<string>")
    got = {r.id: (r.a, r.b) for r in listing.apply_changes(table, changes).collect()}
    assert got == replay(base, batch)


def test_change_of_absent_row_does_nothing(spark):
    table = spark.createDataFrame([(1, 5)], "id int, a int")
    changes = spark.createDataFrame([(2, 1, "update", 9), (3, 2, "delete", None)],
                                    "id int, seq int, op string, a int")
    assert [tuple(r) for r in listing.apply_changes(table, changes).collect()] == [(1, 5)]


def test_pages_cover_the_table_once(spark):
    df = spark.range(95).withColumn("k", F.col("id") % 10)
    seen = []
    for page in range(1, 6):
        seen += [r.id for r in listing.page_of(df, ["k", "id"], page, 20).collect()]
    assert len(seen) == 95 and len(set(seen)) == 95
    last, walked = None, []
    while True:
        rows = listing.page_of(df, ["k", "id"], 1, 20, last).collect()
        if not rows:
            break
        walked += [r.id for r in rows]
        last = {"k": rows[-1].k, "id": rows[-1].id}
    assert walked == seen


@pytest.mark.parametrize("skip,limit", [(-1, 10), (0, 0), (0, 1001)])
def test_listing_bounds(spark, skip, limit):
    df = spark.range(1).select(F.col("id").alias("k"))
    with pytest.raises(ValueError):
        listing.list_mart(df, ["k"], skip=skip, limit=limit)


def test_filters_ignore_absent_columns_and_unset_values(spark):
    df = spark.createDataFrame([("Rainy", 2.0), ("Clear", 4.0)],
                               "weather_condition string, severity_score double")
    same = {"date_range": ("2020-01-01", "2020-02-01"), "selected_model": "x",
            "weather_conditions": [], "severity_range": None, "other": 1}
    assert listing.apply_filters(df, same).count() == 2
    one = {"weather_conditions": ["Rainy"], "severity_range": (1.0, 3.0)}
    assert listing.apply_filters(df, one).count() == 1


def test_format_blank_for_null(spark):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "id int, x double")
    got = listing.head_formatted(df, ["id"], ["id", "x", "nope"], {"x": "%.1f"}).collect()
    assert [tuple(r) for r in got] == [(1, "2.5"), (2, "")]


def test_exact_version(spark):
    df = spark.createDataFrame(
        [(1, "m", "1.0", "2024-01-01", True), (2, "m", "2.0", "2024-02-01", True),
         (3, "m", "3.0", "2024-03-01", False)],
        "id int, model_name string, model_version string, training_date string, is_active boolean",
    )
    assert listing.latest_active_model(df).first().id == 2
    assert listing.latest_active_model(df, "1.0").first().id == 1
    assert listing.latest_active_model(df, "3.0").isEmpty()
