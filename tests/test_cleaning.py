from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from records import frame, record

from tiered import specs
from tiered.operators import cleaning, features, subjects


def clean_ids(spark, *rows):
    return {r.ID for r in cleaning.standardize(frame(spark, *rows)).collect()}


def test_good_row_is_kept_and_classified(spark):
    row = subjects.weather_table(cleaning.standardize(frame(spark, record()))).first()
    assert (row.Weather_Category, row.Temperature_Category) == ("Rainy", "Mild")
    assert row.Weather_Severity_Score == 4
    assert row.State == "PA" and row.Weather_Condition == "Light Rain"


@pytest.mark.parametrize(
    "change",
    [
        {"ID": None}, {"Start_Time": None}, {"End_Time": None}, {"Start_Lat": None},
        {"Start_Lng": None}, {"Severity": 0}, {"Severity": 5}, {"Start_Lat": 0.0},
        {"Start_Lng": -200.0}, {"Start_Lat": float("nan")},
        {"End_Time": "2020-01-01 07:00:00"}, {"End_Time": "2020-01-08 09:00:00"},
        {"Start_Time": "not a time"},
    ],
)
def test_bad_row_is_dropped(spark, change):
    assert clean_ids(spark, record(**change)) == set()


@pytest.mark.parametrize(
    "change",
    [
        {"Severity": None}, {"End_Time": "2020-01-08 08:00:00"},
        {"Start_Time": "2020-01-01 00:00:00.000000000"},
    ],
)
def test_borderline_row_is_kept(spark, change):
    assert clean_ids(spark, record(**change)) == {"A-1"}


def test_null_severity_becomes_two(spark):
    assert cleaning.standardize(frame(spark, record(Severity=None))).first().Severity == 2


@pytest.mark.parametrize(
    "value,expected",
    [(float("nan"), 70), (-60.0, 70), (131.0, 70), (-50.0, -50), (130.0, 130), (None, 70)],
)
def test_temperature_range(spark, value, expected):
    row = cleaning.standardize(frame(spark, record(temperature=value))).first()
    assert row.Temperature_F == expected


def test_temperature_cuts(spark):
    df = spark.createDataFrame([(31.9,), (32.0,), (50.0,), (70.0,), (85.0,)], "t double")
    got = [r[0] for r in df.select(subjects.temperature_category(F.col("t"))).collect()]
    assert got == ["Freezing", "Cold", "Mild", "Warm", "Hot"]


def test_category_order(spark):
    names = ["Snow Showers", "Thunderstorms and Rain", "T-Storm", "Smoke", None]
    df = spark.createDataFrame([(n,) for n in names], "w string")
    got = [r[0] for r in df.select(subjects.weather_category(F.col("w"))).collect()]
    assert got == ["Rainy", "Rainy", "Storm", "Other", "Other"]


def test_regions(spark):
    rows = [record(ID=str(i), State=s) for i, s in enumerate([" ca ", "dc", "ZZ", None])]
    loc = subjects.location_table(cleaning.standardize(frame(spark, *rows)))
    got = [r.Region for r in loc.orderBy("ID").collect()]
    assert got == ["West", "South", "Other", "Other"]


def test_every_state_has_one_region():
    states = [s for members in specs.REGIONS.values() for s in members]
    assert len(states) == len(set(states)) == 51


def test_missing_city_is_rural(spark):
    loc = subjects.location_table(cleaning.standardize(frame(spark, record(City=None))))
    assert (loc.first().City, loc.first().Area_Type) == ("Unknown", "Rural")


def test_complexity(spark):
    rows = [
        record(ID="a", No_Exit=True),
        record(ID="b", **{f: True for f in specs.COMPLEXITY_FLAGS}),
    ]
    acc = subjects.accidents_table(cleaning.standardize(frame(spark, *rows)))
    got = [(r.Road_Complexity_Score, r.Road_Complexity_Category)
           for r in acc.orderBy("ID").collect()]
    assert got == [(0, "Simple"), (11, "Very_Complex")]


def test_hours(spark):
    hours = [5, 6, 11, 12, 17, 18, 21, 22]
    rows = [
        record(ID=f"{h:02d}", Start_Time=f"2020-01-01 {h:02d}:00:00",
               End_Time="2020-01-02 00:00:00")
        for h in hours
    ]
    acc = subjects.accidents_table(cleaning.standardize(frame(spark, *rows))).orderBy("ID")
    assert [r.Time_Period for r in acc.collect()] == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
        "Night",
    ]
    night = {r.ID: r.is_night for r in features.engineer(acc).collect()}
    assert night["06"] == night["22"] == 1 and night["11"] == 0


def test_duplicate_keeps_first_by_order(spark):
    rows = [record(Severity=4, Source="b"), record(Severity=1, Source="a")]
    for parts in (1, 2, 5):
        df = frame(spark, *rows).repartition(parts)
        assert cleaning.standardize(df).first().Severity == 1


def test_bad_winner_is_dropped_with_its_key(spark):
    rows = [record(Source="a", Start_Lat=0.0), record(Source="b")]
    assert clean_ids(spark, *rows) == set()


def test_duration_ignores_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = frame(spark, record(Start_Time="2020-03-08 01:30:00",
                                 End_Time="2020-03-08 03:30:00"))
        assert cleaning.standardize(df).first().Duration_Hours == 2.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_profile_counts_nan_and_handles_empty(spark):
    df = frame(spark, record(temperature=float("nan")), record(temperature=None), record())
    got = {r.column_name: r for r in cleaning.null_profile(df).collect()}
    assert len(got) == 32
    assert got["Temperature(F)"].null_count == 2
    assert float(got["Temperature(F)"].null_percentage) == 66.67
    empty = cleaning.null_profile(frame(spark))
    assert {float(r.null_percentage) for r in empty.collect()} == {0.0}


def test_waterfall_adds_up_both_ways(spark, small):
    from workload import views

    raw = views.incidents(spark, small)
    direct = cleaning.quality_waterfall(raw, views.TIES).orderBy("step").collect()
    staged = cleaning.staged_waterfall(raw, cleaning.stage(raw, views.TIES))
    assert [tuple(r) for r in staged.orderBy("step").collect()] == [tuple(r) for r in direct]
    assert direct[0].rows_left - sum(r.rows_removed for r in direct) == direct[-1].rows_left
    assert direct[-1].rows_left == cleaning.standardize(raw, views.TIES).count()


def test_waterfall_of_nothing(spark):
    rows = cleaning.quality_waterfall(frame(spark), ["Source"]).collect()
    assert [r.rows_left for r in rows] == [0] * 6


def test_mart_rules(spark):
    good = ("2020-01", "Rainy", 5, 2.5, "Stable", 1.0, "2025-01-01")
    bad = ("2020-1", "x" * 51, -1, 0.5, "y" * 21, -0.1, None)
    df = spark.createDataFrame(
        [good, bad],
        "period_month string, weather_category string, total_accidents int, "
        "avg_severity double, trend_direction string, seasonal_factor double, "
        "analysis_date string",
    )
    valid, rejected = cleaning.split_valid(df, specs.TREND_RULES)
    assert [r.period_month for r in valid.collect()] == ["2020-01"]
    assert rejected.first().violations == list(specs.TREND_RULES)


def test_frequency_rules(spark):
    df = spark.createDataFrame(
        [("Rainy", "Mild", 1, 2, 50.0, "2025-01-01"), (None, "z" * 21, -1, -1, 101.0, None)],
        "weather_category string, temperature_category string, accident_count int, "
        "total_accidents int, frequency_percentage double, analysis_date string",
    )
    got = cleaning.validate_rows(df, specs.FREQUENCY_RULES).collect()
    assert got[0].violations == []
    assert got[1].violations == list(specs.FREQUENCY_RULES)


def test_absent_columns_are_skipped(spark):
    df = frame(spark, record()).drop("Visibility(mi)", "County", "Bump")
    row = cleaning.standardize(df).first()
    assert not hasattr(row, "Visibility_Mi")
    assert cleaning.missing(df, specs.RAW_COLUMNS) == ["County", "Visibility(mi)", "Bump"]


def test_flags_travel_as_words_and_come_back(spark):
    """Every value of 70 flags, null too, survives; none is a shuffled column of its own."""
    names = [f"flag {i}" for i in range(70)]
    values = (True, False, None)
    rows = [
        (f"k{k}", n, *[values[(i + k + n) % 3] for i in range(70)])
        for k in range(5) for n in range(2)
    ]
    schema = "ID string, n int, " + ", ".join(f"`{c}` boolean" for c in names)
    df = spark.createDataFrame(rows, schema)
    kept = cleaning.dedup_by_key(df, order=["n"])
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[1] == 0)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Project" in line and "__flags0" in line
                  and "AS __flags0" in line)
    assert window.count(" AS __flags") == 3
