from __future__ import annotations

import csv
import os
import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tiered import specs
from tiered.operators import cleaning, sampling
from tiered.plans import jobs
from tiered.sources import files, slices, tables

DAY1, DAY2, DAY3 = specs.SNAPSHOT_DATES


def write_source(path, n=600):
    """Records with an extra column, another column order and a line break."""
    rng = random.Random(1)
    head = ["Extra", *reversed(specs.RAW_COLUMNS)]
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, head)
        out.writeheader()
        for i in range(n):
            hour = rng.randint(0, 23)
            out.writerow(
                {
                    "Extra": "a,b\nc" if i % 50 == 0 else 'say ""x""',
                    "ID": f"A-{i // 2 if i % 10 == 0 else i}",
                    "Source": f" Source{i % 3} ", "Severity": i % 5 or "",
                    "Start_Time": f"2020-{1 + i % 12:02d}-11 {hour:02d}:00:00",
                    "End_Time": f"2020-{1 + i % 12:02d}-12 {hour:02d}:30:00.000000000",
                    "Start_Lat": 25 + i / 64, "Start_Lng": -70 - (i % 300) / 64,
                    "City": "" if i % 9 == 0 else f" City{i % 4}",
                    "State": ("ca", " TX", "zz")[i % 3],
                    "Temperature(F)": "" if i % 7 == 0 else i % 120,
                    "Humidity(%)": i % 110, "Pressure(in)": 29.5,
                    "Wind_Speed(mph)": i % 40,
                    "Weather_Condition": ("Fair", "Rain", "Fog", "", "Snow")[i % 5],
                    **{f: ("True", "False")[(i + k) % 2] for k, f in enumerate(specs.FLAGS)},
                }
            )


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    source = str(base / "raw.csv")
    write_source(source)
    paths = {n: str(base / n) for n in ("bronze", "silver", "marts", "models")}
    for date in (DAY1, DAY2, DAY3):
        jobs.land_snapshot(spark, source, paths["bronze"], date, multi_line=True)
    jobs.build_silver(spark, paths["bronze"], paths["silver"], DAY3)
    jobs.build_marts(spark, paths["silver"], paths["marts"], DAY3)
    return {**paths, "source": source}


def test_csv_types_come_by_name(spark, lake):
    raw = files.read_csv(spark, lake["source"], multi_line=True)
    assert raw.count() == 600
    assert raw.schema["Severity"].dataType.typeName() == "integer"
    assert raw.schema["Bump"].dataType.typeName() == "boolean"
    assert cleaning.project_available(raw).columns == list(specs.RAW_COLUMNS)
    assert raw.filter("Bump IS NULL").isEmpty()


def test_malformed_values_are_null_and_kept_aside(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("ID,Severity\na,2\nb,two\n")
    got = files.read_csv(spark, str(path), corrupt_column="_bad").orderBy("ID").collect()
    assert [(r.Severity, r._bad) for r in got] == [(2, None), (None, "b,two")]


def test_snapshots_nest(spark, lake):
    ids = [
        {r.ID for r in files.read_dated(spark, lake["bronze"], d).select("ID").collect()}
        for d in (DAY1, DAY2, DAY3)
    ]
    assert ids[0] < ids[1] < ids[2]
    assert 0.2 < len(ids[0]) / len(ids[2]) < 0.45
    assert files.slice_rows(spark, lake["bronze"], DAY3) == 600


def test_unknown_date_is_an_error(spark, lake):
    with pytest.raises(ValueError):
        sampling.snapshot(spark.range(1).withColumnRenamed("id", "ID"), "2025-01-09")
    with pytest.raises(FileNotFoundError):
        files.read_dated(spark, lake["silver"] + "/weather_clean", "2025-01-09")


def test_subject_tables_are_one_to_one(spark, lake):
    ids = [
        sorted(r.ID for r in files.read_dated(spark, f"{lake['silver']}/{n}", DAY3)
               .select("ID").collect())
        for n in ("accidents_clean", "weather_clean", "location_clean")
    ]
    assert ids[0] == ids[1] == ids[2] and len(set(ids[0])) == len(ids[0]) > 300


def test_rerun_leaves_the_same_tables(spark, lake):
    def state():
        out = []
        for n in ("accidents_clean", "quality_waterfall", "null_profile"):
            df = tables.read_slices(spark, f"{lake['silver']}/{n}")
            out.append(sorted(map(str, df.collect())))
        for spec in specs.MART_ROUTES.values():
            df = tables.read_table(spark, lake["marts"], spec).drop("created_at")
            out.append(sorted(map(str, df.collect())))
        return out

    before = state()
    jobs.land_snapshot(spark, lake["source"], lake["bronze"], DAY3, multi_line=True)
    jobs.build_silver(spark, lake["bronze"], lake["silver"], DAY3)
    jobs.build_marts(spark, lake["silver"], lake["marts"], DAY3)
    assert state() == before


def test_another_date_leaves_the_first_alone(spark, lake):
    first = files.slice_rows(spark, lake["silver"] + "/weather_clean", DAY3)
    jobs.build_silver(spark, lake["bronze"], lake["silver"], DAY1)
    jobs.build_marts(spark, lake["silver"], lake["marts"], DAY1)
    assert files.slice_rows(spark, lake["silver"] + "/weather_clean", DAY3) == first
    dates = tables.read_table(spark, lake["marts"], specs.FREQUENCY)
    assert {str(r[0]) for r in dates.select("analysis_date").distinct().collect()} == {DAY1, DAY3}


def test_marts_from_subjects_equal_marts_from_staged(spark, lake, tmp_path):
    jobs.build_marts(spark, lake["silver"], str(tmp_path), DAY3, from_subjects=True)
    for spec in specs.MART_ROUTES.values():
        a = tables.read_table(spark, lake["marts"], spec).filter(
            F.col("analysis_date") == DAY3).drop("created_at")
        b = tables.read_table(spark, str(tmp_path), spec).drop("created_at")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_stored_marts_meet_their_rules(spark, lake):
    for spec, rules in ((specs.FREQUENCY, specs.FREQUENCY_RULES),
                        (specs.SEVERITY, specs.SEVERITY_RULES),
                        (specs.TRENDS, specs.TREND_RULES)):
        rows = tables.read_table(spark, lake["marts"], spec)
        assert not rows.isEmpty()
        _, rejected = cleaning.split_valid(rows, rules)
        assert rejected.isEmpty()


def test_shares_add_up(spark, lake):
    rows = tables.read_table(spark, lake["marts"], specs.FREQUENCY).filter(
        F.col("analysis_date") == DAY3).collect()
    assert abs(float(sum(r.frequency_percentage for r in rows)) - 100) <= 0.005 * len(rows)
    assert sum(r.accident_count for r in rows) == rows[0].total_accidents


def test_inventory_marks_missing_dates(spark, lake):
    got = {(r.layer, r.date): r for r in jobs.layer_inventory(
        spark, lake["bronze"], lake["silver"]).collect()}
    assert len(got) == 12
    assert not got["bronze", DAY1].is_missing and got["bronze", DAY1].bytes > 0
    assert got["weather_clean", DAY2].is_missing and got["weather_clean", DAY2].files == 0


def test_unknown_output_is_an_error(spark, lake):
    with pytest.raises(ValueError):
        tables.write_mart(spark.range(1), "other", lake["marts"], DAY1)
    with pytest.raises(ValueError):
        tables.conform(spark.range(1), specs.FREQUENCY)


def test_overflow_becomes_null(spark):
    df = spark.createDataFrame([("2020-01", "Rainy", 1, 2.0, "Stable", 123.0)],
                               "period_month string, weather_category string, "
                               "total_accidents long, avg_severity double, "
                               "trend_direction string, seasonal_factor double")
    row = tables.conform(df, specs.TRENDS, analysis_date=DAY1).first()
    assert row.seasonal_factor is None and str(row.avg_severity) == "2.00"


def test_folder_read_and_csv_export(spark, lake, tmp_path):
    rows = files.read_folder(spark, lake["bronze"])
    assert rows.count() == sum(
        files.slice_rows(spark, lake["bronze"], d) for d in specs.SNAPSHOT_DATES)
    broken = tmp_path / "mixed"
    spark.range(5).write.parquet(str(broken / "good"))
    (broken / "bad.parquet").write_bytes(b"no parquet here at all")
    got = files.read_folder(spark, str(broken), skip_unreadable=True, schema="id long")
    assert got.count() == 5
    files.export_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3


def test_an_empty_slice_clears_its_date_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    for date in ("2025-01-01", "2025-01-02"):
        rows = spark.range(3).withColumn("day", F.lit(date).cast("date"))
        tables.replace_slice(rows, path, {"day": date})
    tables.replace_slice(rows.limit(0), path, {"day": "2025-01-02"})
    left = [(r.id, str(r.day)) for r in tables.read_slices(spark, path).collect()]
    assert sorted(left) == [(k, "2025-01-01") for k in range(3)]
    assert files.slice_rows(spark, path, "2025-01-02", "day") == 0
    with pytest.raises(Exception, match="row outside"):
        tables.replace_slice(rows, path, {"day": "2025-01-03"})


def test_a_failed_rerun_keeps_the_old_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.lit("2025-01-01").cast("date")
    tables.replace_slice(spark.range(5).withColumn("day", day), path, {"day": "2025-01-01"})
    # Fails in a task, after other tasks have written files.
    bad = spark.range(0, 4000, 1, 8).withColumn("day", day).withColumn(
        "id", F.when(F.col("id") == 3999, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        tables.replace_slice(bad, path, {"day": "2025-01-01"})
    assert files.slice_rows(spark, path, "2025-01-01", "day") == 5
    other = spark.range(9).withColumn("day", F.lit("2025-01-02").cast("date"))
    with pytest.raises(Exception, match="row outside"):
        tables.replace_slice(other, path, {"day": "2025-01-01"})
    assert sorted(r.id for r in tables.read_slices(spark, path).collect()) == list(range(5))
    assert len([d for d in os.listdir(path) if d.startswith("commit=")]) == 1


def test_a_reader_sees_old_rows_or_new_ones(spark, tmp_path):
    """Readers run while a slice is replaced over and over, each time by rows of one kind."""
    path = str(tmp_path / "t")

    def write(kind):
        rows = spark.range(200, numPartitions=4).select(F.lit(kind).alias("kind"), F.lit("a").alias("part"))
        tables.replace_slices(rows, path, "part")

    write(0)
    seen, done = [], threading.Event()

    def look():
        while not done.is_set():
            seen.append([(r.kind, r["count"]) for r in
                         tables.read_slices(spark, path).groupBy("kind").count().collect()])

    reader = threading.Thread(target=look)
    reader.start()
    for kind in range(1, 5):
        write(kind)
    done.set()
    reader.join()
    assert seen and all(len(s) == 1 and s[0][1] == 200 for s in seen)
    assert [s[0][0] for s in seen] == sorted(s[0][0] for s in seen)


def test_writers_of_different_slices_keep_each_others_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: tables.replace_slice(
            spark.range(k + 1).withColumn("part", F.lit(f"p:{k}/x")), path, {"part": f"p:{k}/x"}), range(6)))
    got = {(r.part, r["count"]) for r in tables.read_slices(spark, path).groupBy("part").count().collect()}
    assert got == {(f"p:{k}/x", k + 1) for k in range(6)}


def test_replaced_files_go_later(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        rows = spark.range(n).select("id", (F.col("id") % 2).cast("string").alias("part"))
        tables.replace_slices(rows, path, "part")
    tables.replace_slice(spark.range(2).select("id", F.lit("1").alias("part")), path, {"part": "1"})
    old = tables.read_slices(spark, path)
    assert slices.clean(spark, path) == 0
    want = {(0, "0"), (2, "0"), (4, "0"), (0, "1"), (1, "1")}
    assert {tuple(r) for r in old.collect()} == want
    (tmp_path / "t" / "commit=000000009-lost").mkdir()
    assert slices.clean(spark, path, older_than_hours=-1) == 3
    assert {tuple(r) for r in tables.read_slices(spark, path).collect()} == want
    tables.replace_slice(spark.range(0).select("id", F.lit("0").alias("part")), path, {"part": "0"})
    slices.clean(spark, path, older_than_hours=-1)
    assert {tuple(r) for r in tables.read_slices(spark, path).collect()} == {(0, "1"), (1, "1")}


def test_slices_of_null_and_odd_values(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(1, None, "a b"), (2, "x=y", "007"), (3, "ü/%", "a b")], "id long, p string, q string")
    tables.replace_slices(rows, path, "p", "q")
    assert {tuple(r) for r in tables.read_slices(spark, path).collect()} == {
        tuple(r) for r in rows.collect()}
    tables.replace_slices(rows.limit(0), path, "p", "q", only=[{"q": "007", "p": "x=y"}])
    assert {r.id for r in tables.read_slices(spark, path).collect()} == {1, 3}
    with pytest.raises(ValueError):
        tables.replace_slices(rows, path, "p", "q", only=[{"p": "x=y"}])
    with pytest.raises(FileNotFoundError):
        tables.read_slices(spark, str(tmp_path / "none"))


def test_predictions_of_two_models_stay_in_a_batch(spark, tmp_path):
    def scored(model, n):
        return spark.range(n).select(
            F.lit(model).alias("model_id"), F.lit("b1").alias("prediction_batch"),
            F.col("id").cast("string").alias("accident_id"),
            F.lit(1.0).alias("predicted_severity"), F.lit(0.5).alias("confidence_score"),
            F.current_timestamp().alias("prediction_date"), F.lit(True).alias("is_validated"),
        )

    for model, n in (("A:1", 3), ("B:1", 2), ("A:1", 3)):
        tables.write_model_output(scored(model, n), "predictions", str(tmp_path))
    stored = tables.read_table(spark, str(tmp_path), specs.PREDICTIONS)
    assert {(r.model_id, r["count"]) for r in stored.groupBy("model_id").count().collect()} == {
        ("A:1", 3), ("B:1", 2)
    }
    # An empty run of a pair clears that pair and no other.
    pair = {"model_id": "A:1", "prediction_batch": "b1"}
    tables.write_model_output(scored("A:1", 0), "predictions", str(tmp_path), [pair])
    stored = tables.read_table(spark, str(tmp_path), specs.PREDICTIONS)
    assert {(r.model_id, r["count"]) for r in stored.groupBy("model_id").count().collect()} == {("B:1", 2)}


def test_models_that_register_at_once_are_both_kept(spark, tmp_path):
    def row(k):
        given = {f.name: F.lit(None) for f in specs.MODELS.schema}
        given |= {f.name: F.lit("0") for f in specs.MODELS.schema if not f.nullable}
        given["training_date"] = F.current_timestamp()
        given["model_id"] = F.lit(f"m:{k}")
        return spark.range(1).select(*[c.alias(n) for n, c in given.items()])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: tables.write_model_output(row(k), "models", str(tmp_path)), range(4)))
    assert {r.model_id for r in jobs.registry(spark, str(tmp_path)).collect()} == {
        f"m:{k}" for k in range(4)}


def test_versions_written_at_once_have_numbers_of_their_own(spark, tmp_path):
    v = str(tmp_path / "v")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda n: tables.write_version(spark.range(n), v), range(1, 7)))
    assert sorted(numbers) == list(range(1, 7))
    assert tables.read_latest(spark, v, spark.range(1).schema).count() == numbers.index(6) + 1


def test_inventory_of_absent_layers(spark, tmp_path):
    report = files.layer_report(spark, {"bronze": str(tmp_path / "none")}, ("2025-01-01",))
    assert [(r.files, r.is_missing) for r in report.collect()] == [(0, True)]


def test_versions(spark, tmp_path):
    v = str(tmp_path / "v")
    assert tables.read_latest(spark, v, spark.range(1).schema) is None
    assert tables.write_version(spark.range(3), v) == 1
    old = tables.read_latest(spark, v, spark.range(1).schema)
    assert tables.write_version(old.filter("id > 0"), v) == 2
    assert tables.read_latest(spark, v, spark.range(1).schema).count() == 2
    assert old.count() == 3
