"""The plans keep to what a large cluster needs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tiered import specs
from tiered.operators import cleaning, features, listing, marts, sampling, subjects
from tiered.sources import files, tables
from workload import views
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(autouse=True)
def whole_plans(spark):
    for name in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields"):
        spark.conf.set(name, 100_000)
    yield
    for name in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields"):
        spark.conf.unset(name)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_dedup_limits_groups_before_the_shuffle(spark, small):
    text = plan(cleaning.dedup_by_key(views.incidents(spark, small), order=views.TIES))
    shuffle = text.index("Exchange hashpartitioning(ID")
    assert text.index("row_number(), 1, Final") < shuffle < text.index("row_number(), 1, Partial")


def test_hot_key_sends_one_row_per_task(spark):
    """A key with a third of all rows: the shuffle carries tasks + keys rows."""
    n, tasks = 60_000, 6
    df = spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("ID"),
        (F.col("id") * 7919 % n).alias("o"),
    )
    out = cleaning.dedup_by_key(df, order=["o"])
    rows = out.collect()
    assert len(rows) == n - n // 3 + 1
    assert {r.o for r in rows if r.ID == 0} == {0}
    leaf = out._jdf.queryExecution().executedPlan()
    text = leaf.toString()
    assert "Partial" in text


def test_marts_shuffle_incidents_once(spark, small):
    clean = cleaning.standardize(views.incidents(spark, small), views.TIES)
    text = plan(marts.cells(marts.measures(subjects.observations(clean))))
    assert len(re.findall(r"Exchange hashpartitioning\(ID", text)) == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in text


def test_share_window_sees_aggregated_rows_only(spark, small):
    clean = cleaning.standardize(views.incidents(spark, small), views.TIES)
    text = plan(marts.frequency_mart(marts.measures(subjects.observations(clean))))
    single = text.index("Exchange SinglePartition")
    assert "HashAggregate" in text[single:single + 400]


@pytest.fixture(scope="module")
def dated(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dated") / "bronze")
    raw = views.incidents(spark, small).drop("bucket")
    for d in specs.SNAPSHOT_DATES[:2]:
        files.write_dated(raw.withColumn("ingestion_date", F.lit(d).cast("date")), path)
    return path


def test_date_prunes_and_required_columns_push_down(spark, dated):
    raw = files.read_dated(spark, dated, specs.SNAPSHOT_DATES[0])
    staged = cleaning.stage(raw, views.TIES)
    text = plan(marts.measures(subjects.observations(cleaning.standardize_staged(staged))))
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date", text)
    for c in ("Start_Lat", "Start_Lng", "Start_Time", "End_Time", "ID"):
        assert f"IsNotNull({c})" in text
    schema = re.search(r"ReadSchema: struct<([^\n]*)", text).group(1)
    assert "Zipcode" not in schema and "Turning_Loop" not in schema


def test_subject_tables_from_staged_do_not_shuffle(spark, dated):
    staged = tables.read_slices(spark, dated).withColumn("rejected_by", F.lit(None).cast("string"))
    clean = cleaning.standardize_staged(staged)
    for build in subjects.SUBJECTS.values():
        assert "Exchange" not in plan(build(clean))


def test_null_profile_is_one_scan(spark, dated):
    text = plan(cleaning.null_profile(spark.read.parquet(dated)))
    assert text.count("FileScan parquet") == 1


def test_patterns_run_once_per_row(spark, dated):
    staged = tables.read_slices(spark, dated).withColumn("rejected_by", F.lit(None).cast("string"))
    text = plan(subjects.weather_table(cleaning.standardize_staged(staged)))
    assert text.count("overcast") == 1


@pytest.mark.parametrize("make", [
    lambda df: sampling.sample_n(df, 10, key="id"),
    lambda df: listing.top_n_sorted(df, "id", n=10),
    lambda df: listing.page_of(df, ["id"], 3, 20),
])
def test_heads_do_not_sort_the_table(spark, make):
    text = plan(make(spark.range(1000)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_stored_lookup_is_broadcast_by_its_size(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("City"))
    cities = features.city_lookup(df)
    assert "BroadcastHashJoin" in plan(features.with_city_features(df, cities))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1)
    try:
        assert "SortMergeJoin" in plan(features.with_city_features(df, cities))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changes_combine_before_the_shuffle(spark, small):
    batch = listing.collapse_changes(views.changes(spark, small), "id", ["f1_score"])
    text = plan(batch)
    assert "Join" not in text and "partial_max" in text
    assert text.count("Exchange") == 1


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_partitioning_does_not_change_a_mart(spark, small, parts):
    raw = views.incidents(spark, small)
    def mart(df):
        clean = cleaning.standardize(df, views.TIES)
        return [tuple(r) for r in marts.trend_mart(
            marts.measures(subjects.observations(clean))).collect()]
    assert mart(raw.repartition(parts)) == mart(raw)
