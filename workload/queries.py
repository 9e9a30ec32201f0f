"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads its whole tables. Dates, timestamps and decimals are printed
as text or doubles at the very end, so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiered import specs
from tiered.functions.exprs import haversine_km
from tiered.operators import (
    cleaning,
    features,
    listing,
    marts,
    models,
    reports,
    sampling,
    subjects,
)
from tiered.sources import tables
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def comparable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------------------
# Inputs


def raw(spark: SparkSession, d: str) -> DataFrame:
    return views.incidents(spark, d)


def complete(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.fill_defaults(cleaning.drop_incomplete(raw(spark, d)))


def unique(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.dedup_by_key(complete(spark, d), order=views.TIES)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.standardize(raw(spark, d), order=views.TIES)


def obs(spark: SparkSession, d: str) -> DataFrame:
    return subjects.observations(clean(spark, d))


def measures(spark: SparkSession, d: str) -> DataFrame:
    return marts.measures(obs(spark, d))


def impact(spark: SparkSession, d: str) -> DataFrame:
    return reports.impact_view(obs(spark, d))


def summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.impact_summary(impact(spark, d))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return reports.daily_by_condition(impact(spark, d))


def bucket():
    return F.col("bucket")


ANALYSIS_DATE = "2025-01-03"


def stored_trends(spark: SparkSession, d: str) -> DataFrame:
    return tables.conform(
        marts.trend_mart(measures(spark, d)), specs.TRENDS, analysis_date=ANALYSIS_DATE
    )


def scored(spark: SparkSession, d: str) -> DataFrame:
    p = views.predictions(spark, d)
    return reports.join_outcomes(
        p.drop("actual_severity"), p.select("prediction_id", "actual_severity")
    )


# ---------------------------------------------------------------------------
# Scan, cleaning


@query
def scan_parquet(spark, d):
    return views.table(spark, d, "lineitem")


@query
def project_available(spark, d):
    wanted = ("l_orderkey", "l_quantity", "l_missing", "l_shipdate", "l_absent")
    return cleaning.project_available(views.table(spark, d, "lineitem"), wanted)


@query
def null_profile(spark, d):
    return cleaning.null_profile(raw(spark, d).drop("bucket", *views.TIES))


@query
def fill_defaults(spark, d):
    return cleaning.fill_defaults(raw(spark, d)).select(
        *[f"`{c}`" for c in specs.RAW_COLUMNS]
    )


@query
def drop_incomplete(spark, d):
    return cleaning.drop_incomplete(raw(spark, d)).select(
        "ID", "Start_Time", "End_Time", "Start_Lat", "Start_Lng"
    )


@query
def dedup_by_key(spark, d):
    return unique(spark, d).select(
        "ID", *views.TIES, "Severity", "Start_Lat", "Weather_Condition"
    )


@query
def filter_geo(spark, d):
    return cleaning.filter_geo(unique(spark, d)).select("ID", "Start_Lat", "Start_Lng")


@query
def filter_domain(spark, d):
    return cleaning.filter_domain(unique(spark, d)).select("ID", "Severity")


@query
def quality_waterfall(spark, d):
    return cleaning.quality_waterfall(raw(spark, d), order=views.TIES)


@query
def parse_timestamps(spark, d):
    """Text in the usual form, with a fraction, a part of a date, an offset, or no time."""
    text = F.date_format("Start_Time", "yyyy-MM-dd HH:mm:ss")
    form = F.col("tie_a") % 6
    rows = raw(spark, d).select(
        "ID",
        F.when(form == 0, text)
        .when(form == 1, F.concat(text, F.lit(".250000000")))
        .when(form == 2, F.substring(text, 1, 7))
        .when(form == 3, F.concat(text, F.lit("+05:00")))
        .when(form == 4, F.substring(text, 1, 4))
        .otherwise("not a time")
        .alias("Start_Time"),
        F.date_format("End_Time", "yyyy-MM-dd HH:mm:ss").alias("End_Time"),
    )
    return cleaning.parse_timestamps(rows)


@query
def duration_hours(spark, d):
    return raw(spark, d).select("ID", cleaning.duration_hours().alias("Duration_Hours"))


@query
def filter_duration(spark, d):
    rows = raw(spark, d).withColumn("Duration_Hours", cleaning.duration_hours())
    return cleaning.filter_duration(rows).select("ID", "Duration_Hours")


@query
def standardize_text(spark, d):
    return cleaning.standardize_text(raw(spark, d)).select("ID", *specs.TRIMMED)


@query
def range_or_default(spark, d):
    return cleaning.range_or_default(raw(spark, d)).select(
        "ID", *[r.target for r in specs.RANGES]
    )


@query
def validate_rows(spark, d):
    """Listing rows with faults of every kind against the severity mart's rules."""
    rows = raw(spark, d).select(
        "ID",
        F.when(
            F.col("tie_a") % 50 == 0, F.repeat(F.lit("x"), F.lit(51))
        ).otherwise(F.col("Weather_Condition")).alias("weather_category"),
        F.col("Severity").alias("severity_level"),
        (F.col("bucket") - 3).alias("accident_count"),
        cleaning.duration_hours().alias("avg_duration_hours"),
        ((F.col("bucket") - 50) / F.lit(32)).alias("correlation_score"),
        F.to_date("End_Time").alias("analysis_date"),
    )
    return cleaning.validate_rows(rows, specs.SEVERITY_RULES).select("ID", "violations")


# ---------------------------------------------------------------------------
# Subject tables


@query
def weather_clean(spark, d):
    return subjects.weather_table(clean(spark, d))


@query
def location_clean(spark, d):
    return subjects.location_table(clean(spark, d))


@query
def accidents_clean(spark, d):
    return subjects.accidents_table(clean(spark, d))


@query
def weather_category(spark, d):
    return raw(spark, d).select(
        "ID", subjects.weather_category(F.col("Weather_Condition")).alias("category")
    )


@query
def temperature_category(spark, d):
    rows = cleaning.range_or_default(raw(spark, d))
    return rows.select(
        "ID", subjects.temperature_category(F.col("Temperature_F")).alias("category")
    )


@query
def weather_score(spark, d):
    rows = raw(spark, d).select(
        "ID", subjects.weather_category(F.col("Weather_Condition")).alias("category")
    )
    return rows.select("ID", subjects.weather_score(F.col("category")).alias("score"))


@query
def region_of_state(spark, d):
    state = F.upper(F.trim("State"))
    return raw(spark, d).select(
        "ID", state.alias("State"), subjects.region_of_state(state).alias("Region")
    )


@query
def area_type(spark, d):
    return cleaning.fill_defaults(raw(spark, d)).select(
        "ID", subjects.area_type(F.trim("City")).alias("Area_Type")
    )


@query
def geo_grid(spark, d):
    """Incidents per grid cell of two decimals."""
    return raw(spark, d).groupBy(
        F.round("Start_Lat", 2).alias("lat_rounded"),
        F.round("Start_Lng", 2).alias("lng_rounded"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def calendar_parts(spark, d):
    parts = subjects.calendar_parts(F.col("Start_Time"))
    return raw(spark, d).select("ID", *[c.alias(n) for n, c in parts.items()])


@query
def time_period(spark, d):
    return raw(spark, d).select(
        "ID", subjects.time_period(F.hour("Start_Time")).alias("Time_Period")
    )


@query
def severity_label(spark, d):
    return raw(spark, d).select(
        "ID", subjects.severity_label(F.col("Severity")).alias("Severity_Category")
    )


@query
def flag_score(spark, d):
    rows = subjects.accidents_table(clean(spark, d))
    return rows.select("ID", "Road_Complexity_Score", "Road_Complexity_Category")


# ---------------------------------------------------------------------------
# Split, sample, union


@query
def hash_split(spark, d):
    return sampling.hash_split(raw(spark, d), bucket=bucket()).select("ID", "part")


def _snapshot(spark, d, date):
    return sampling.snapshot(raw(spark, d), date, bucket=bucket()).select(
        "ID", "tie_a", "ingestion_date"
    )


@query
def snapshot_day1(spark, d):
    return _snapshot(spark, d, "2025-01-01")


@query
def snapshot_day2(spark, d):
    return _snapshot(spark, d, "2025-01-02")


@query
def snapshot_day3(spark, d):
    return _snapshot(spark, d, "2025-01-03")


@query
def union_parts(spark, d):
    rows = sampling.hash_split(raw(spark, d), bucket=bucket()).select("ID", "tie_a", "part")
    return sampling.union_parts([rows.filter(F.col("part") == i) for i in (3, 1, 2)])


@query
def sample_n(spark, d):
    return sampling.sample_n(raw(spark, d), 500, ties=views.TIES).select(
        "ID", *views.TIES
    )


@query
def train_val_test(spark, d):
    return sampling.train_val_test(raw(spark, d), bucket=bucket()).select("ID", "split")


@query
def distinct_values(spark, d):
    return sampling.distinct_values(raw(spark, d), "Weather_Condition", "Source")


# ---------------------------------------------------------------------------
# Joins and marts


@query
def join_incidents_weather(spark, d):
    """From stored rows: the cleaning and its shuffle run once for both sides."""
    rows = features.cut_lineage(
        clean(spark, d).select(
            "ID", "Severity", "Start_Time", "Duration_Hours", "Temperature_F", "Humidity_Pct",
            "Wind_Speed_Mph", "Pressure_In", "Weather_Condition",
        )
    )
    return subjects.join_subjects(rows, subjects.observations(rows))


@query
def frequency_mart(spark, d):
    return marts.frequency_mart(measures(spark, d))


@query
def severity_mart(spark, d):
    return marts.severity_mart(measures(spark, d))


@query
def severity_mart_fixed(spark, d):
    return marts.severity_mart(marts.measures(obs(spark, d), specs.DANGER_MATCHING))


@query
def severity_corr(spark, d):
    return marts.severity_corr(obs(spark, d)).select(
        F.round("correlation", 6).alias("correlation"), "accident_count"
    )


@query
def trend_mart(spark, d):
    return marts.trend_mart(measures(spark, d))


@query
def mart_conform(spark, d):
    return stored_trends(spark, d).drop("created_at")


@query
def mart_conform_frequency(spark, d):
    mart = marts.frequency_mart(measures(spark, d))
    stored = tables.conform(mart, specs.FREQUENCY, analysis_date=ANALYSIS_DATE)
    return stored.drop("created_at")


@query
def mart_conform_severity(spark, d):
    mart = marts.severity_mart(measures(spark, d))
    stored = tables.conform(mart, specs.SEVERITY, analysis_date=ANALYSIS_DATE)
    return stored.drop("created_at")


# ---------------------------------------------------------------------------
# Reports


@query
def impact_summary(spark, d):
    return summary(spark, d)


@query
def daily_by_condition(spark, d):
    return daily(spark, d)


@query
def severity_bands(spark, d):
    return reports.severity_bands(impact(spark, d))


@query
def severity_band_totals(spark, d):
    return reports.severity_band_totals(reports.severity_bands(impact(spark, d)))


@query
def correlation_rows(spark, d):
    rows = raw(spark, d).select(
        F.col("Temperature(F)").alias("temperature"),
        F.col("Humidity(%)").alias("humidity"),
        F.col("Wind_Speed(mph)").alias("wind_speed"),
        F.col("Pressure(in)").alias("pressure"),
        F.col("Severity").alias("severity_score"),
        F.col("Weather_Condition").alias("weather_condition"),
    )
    return reports.correlation_rows(rows)


@query
def ols_by_group(spark, d):
    lines = reports.ols_by_group(impact(spark, d), "temperature", "severity_score")
    return lines.select(
        "weather_condition",
        *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")],
        "n",
    )


@query
def condition_day_pivot(spark, d):
    events = views.table(spark, d, "events").select(
        F.to_date("ts").alias("analysis_date"),
        F.col("event_type").alias("weather_condition"),
        F.lit(1).alias("severity_score"),
    )
    first = dt.date(2024, 1, 1)
    days = [first + dt.timedelta(days=i) for i in range(31)]
    return reports.condition_day_pivot(reports.daily_by_condition(events), days)


@query
def daily_series(spark, d):
    series = reports.daily_series(daily(spark, d))
    return series.withColumn("avg_severity", F.round("avg_severity", 6))


@query
def condition_profile(spark, d):
    return reports.condition_profile(summary(spark, d))


@query
def kpi_weather(spark, d):
    kpi = reports.kpi_weather(summary(spark, d))
    return kpi.withColumn("average_severity", F.round("average_severity", 6))


@query
def kpi_models(spark, d):
    return reports.kpi_models(views.models(spark, d))


@query
def model_comparison(spark, d):
    return reports.model_comparison(views.models(spark, d))


@query
def model_evolution(spark, d):
    return reports.model_evolution(views.models(spark, d))


@query
def best_model(spark, d):
    return reports.best_model(views.models(spark, d), 1 - F.col("accuracy"))


@query
def predictions_summary(spark, d):
    return reports.predictions_summary(views.predictions(spark, d), 30, views.AS_OF)


@query
def prediction_timeline(spark, d):
    return reports.prediction_timeline(views.predictions(spark, d))


@query
def prediction_accuracy(spark, d):
    p = views.predictions(spark, d)
    return reports.prediction_accuracy(
        p.drop("actual_severity"), p.select("prediction_id", "actual_severity")
    )


@query
def confusion_matrix(spark, d):
    """Predictions in halves, so that rounding to the even label shows."""
    rows = scored(spark, d).withColumn(
        "predicted_severity", F.col("predicted_severity") + F.col("prediction_id") % 3 / F.lit(2)
    )
    return reports.confusion_matrix(rows)


@query
def confidence_histogram(spark, d):
    return reports.confidence_histogram(views.predictions(spark, d), "confidence_score")


@query
def error_box(spark, d):
    return reports.error_box(scored(spark, d))


@query
def model_scores(spark, d):
    rows = reports.model_scores(scored(spark, d))
    return rows.select(
        "model_id", "samples",
        *[
            F.round(c, 6).alias(c)
            for c in ("accuracy", "precision_score", "recall", "f1_score")
        ],
    )


@query
def describe_numeric(spark, d):
    stats = reports.describe_numeric(
        raw(spark, d),
        ["Severity", "Start_Lat", "Start_Lng", "Temperature(F)", "Humidity(%)",
         "Pressure(in)", "Wind_Speed(mph)"],
    )
    return stats.withColumn("std", F.round("std", 6))


@query
def completeness(spark, d):
    return reports.completeness(raw(spark, d).drop("bucket", *views.TIES))


@query
def mart_summary(spark, d):
    # Stored once, as the mart job does: the three marts read the small table.
    one = features.cut_lineage(marts.cells(measures(spark, d)))
    built = [
        tables.conform(mart(one), spec, analysis_date=ANALYSIS_DATE)
        for mart, spec in (
            (marts.frequency_mart, specs.FREQUENCY),
            (marts.severity_mart, specs.SEVERITY),
            (marts.trend_mart, specs.TRENDS),
        )
    ]
    return reports.mart_summary(*built)


@query
def column_range(spark, d):
    return reports.column_range(impact(spark, d), "severity_score")


# ---------------------------------------------------------------------------
# Listings


@query
def list_mart_page(spark, d):
    return listing.list_mart(
        stored_trends(spark, d).drop("created_at"),
        specs.TRENDS.key,
        category="Rainy",
        date_from="2025-01-01",
        skip=10,
        limit=50,
    )


@query
def get_by_id(spark, d):
    return listing.get_by_id(views.models(spark, d), 42)


@query
def apply_changes(spark, d):
    """Creates, deletes and updates; ``sets`` names what a change sets, null included."""
    return listing.apply_changes(
        views.models(spark, d).select("id", "model_name", "accuracy", "f1_score"),
        views.changes(spark, d),
    )


@query
def apply_filters(spark, d):
    rows = daily(spark, d).withColumn("severity_score", F.col("avg_severity"))
    return listing.apply_filters(
        rows,
        {
            "date_range": ("1996-01-01", "1999-12-31"),
            "weather_conditions": ["Rainy", "Snow/Ice", "Storm"],
            "severity_range": (2.0, 3.5),
            "selected_model": "All",
        },
    )


@query
def top_n_sorted(spark, d):
    rows = clean(spark, d).select("ID", "Duration_Hours", "Temperature_F")
    return listing.top_n_sorted(rows, "Duration_Hours", ascending=False, n=200, ties=["ID"])


@query
def page_of(spark, d):
    rows = clean(spark, d).select("ID", "Severity", "State")
    return listing.page_of(rows, ["ID"], page=7, size=25)


@query
def page_count(spark, d):
    return listing.page_count(clean(spark, d), 25)


@query
def head_formatted(spark, d):
    rows = raw(spark, d).withColumnRenamed("Temperature(F)", "Temperature_F")
    return listing.head_formatted(
        rows, ["ID", *views.TIES], ["ID", "Temperature_F", "Severity", "Absent"],
        {"Temperature_F": "%.2f"},
    )


@query
def model_listing(spark, d):
    return listing.model_listing(
        views.models(spark, d),
        ["id", "model_name", "model_version", "accuracy", "precision_score", "recall",
         "f1_score", "training_date", "is_active"],
    )


def named_features(spark, d):
    m = views.models(spark, d).select(
        F.col("id").alias("model_id"), "model_name", "model_version"
    )
    return views.features(spark, d).join(m, "model_id")


@query
def top_features(spark, d):
    top = listing.top_features(named_features(spark, d), "ECONOMY", 15)
    return top.select("feature_name", "importance_score", "model_name", "model_version")


@query
def latest_active_model(spark, d):
    return listing.latest_active_model(views.models(spark, d)).select(
        "id", "model_name", "model_version", "training_date"
    )


# ---------------------------------------------------------------------------
# Features


def accidents(spark: SparkSession, d: str) -> DataFrame:
    return subjects.accidents_table(clean(spark, d))


@query
def haversine(spark, d):
    """Distance of every incident from the middle of the country; null without a place."""
    rows = raw(spark, d)
    km = haversine_km(
        F.col("Start_Lat"), F.col("Start_Lng"), F.lit(39.828125), F.lit(-98.5625)
    )
    return rows.select("ID", F.round(km, 6).alias("km"))


QUERIES["haversine_km"] = QUERIES.pop("haversine")


@query
def median_impute(spark, d):
    """Missing temperature and humidity replaced by the exact median."""
    rows = raw(spark, d).select(
        "ID", F.col("Temperature(F)").alias("temperature"),
        F.col("Humidity(%)").alias("humidity"),
    )
    return features.median_impute(rows, ["temperature", "humidity"])


@query
def geo_features(spark, d):
    """Grid, interaction, state code and city features of accident rows."""
    made = features.geo_columns()
    wide = features.cut_lineage(
        accidents(spark, d).select(
            "ID", "State", "City", *[c.alias(n) for n, c in made.items()]
        )
    )
    coded = features.label_encode(wide, {"State": features.ENCODED["State"]})
    return features.with_city_features(coded, features.city_lookup(wide)).select(
        "ID", *made, "state_encoded", "city_frequency", "is_major_city"
    )


@query
def temporal_features(spark, d):
    made = features.temporal_columns()
    waves = {n for n in made if n.endswith(("_sin", "_cos"))}
    return accidents(spark, d).select(
        "ID", *[(F.round(c, 6) if n in waves else c).alias(n) for n, c in made.items()]
    )


@query
def env_features(spark, d):
    rows = accidents(spark, d)
    made = features.env_columns(rows)
    return rows.select("ID", *[c.alias(n) for n, c in made.items()])


@query
def label_encode(spark, d):
    """All five encoded label columns of accident rows."""
    encoded = {**features.ENCODED, **features.LEAKY_ENCODED}
    rows = features.cut_lineage(accidents(spark, d).select("ID", *encoded))
    return features.label_encode(rows, encoded)


@query
def zscore(spark, d):
    rows = clean(spark, d).select("ID", "Temperature_F", "Humidity_Pct", "Pressure_In")
    columns = ["Temperature_F", "Humidity_Pct", "Pressure_In"]
    scaled = features.zscore(rows, columns)
    return scaled.select("ID", *[F.round(c, 6).alias(c) for c in columns])


@query
def feature_catalog(spark, d):
    return features.feature_catalog(views.features(spark, d))


@query
def feature_stats(spark, d):
    rows = raw(spark, d).withColumnsRenamed(
        {"Temperature(F)": "temperature", "Humidity(%)": "humidity"}
    )
    stats = features.feature_stats(rows, ["temperature", "humidity", "Start_Lat", "Severity"])
    return stats.withColumn("std_value", F.round("std_value", 6))


# ---------------------------------------------------------------------------
# Models. Numbers depend on the learner, so these have no SQL; the two formulas
# that do are checked on plain columns.

_PREPARED: dict[tuple[str, str], models.Prepared] = {}
_FORESTS: dict[tuple[str, str], models.Trained] = {}


def prepared(spark: SparkSession, d: str) -> models.Prepared:
    """Feature table of the accidents, laid out once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _PREPARED:
        _PREPARED[key] = models.prepare(sampling.train_val_test(accidents(spark, d)))
    return _PREPARED[key]


def forest_of(spark: SparkSession, d: str) -> models.Trained:
    """The declared forest, fitted once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FORESTS:
        _FORESTS[key] = models.train(prepared(spark, d), "random_forest")
    return _FORESTS[key]


def metrics_of(spark: SparkSession, d: str, algorithm: str) -> DataFrame:
    ready = prepared(spark, d)
    return models.regression_metrics(models.train(ready, algorithm).score(ready.table))


@query
def regression_metrics(spark, d):
    rows = sampling.train_val_test(raw(spark, d), bucket=bucket()).select(
        "split",
        F.when(F.col("bucket") % 7 == 0, "n/a")
        .otherwise(F.col("Severity").cast("string"))
        .alias("label"),
        (F.col("Humidity(%)") / 32).alias("prediction"),
    )
    out = models.regression_metrics(rows)
    return out.select(
        "split", "samples",
        *[F.round(c, 6).alias(c) for c in ("mae", "mse", "rmse", "r2")],
    )


@query
def confidence_formula(spark, d):
    votes = F.array(
        *[F.col(c) / F.lit(64.0) for c in ("Temperature_F", "Humidity_Pct", "Pressure_In")]
    )
    return clean(spark, d).select(
        "ID", F.round(models.spread_confidence(votes), 6).alias("confidence")
    )


@query
def coord_clusters(spark, d):
    """Incidents per coordinate cluster, from stored coordinates: the cleaning runs once."""
    rows = features.cut_lineage(accidents(spark, d).select("ID", "Latitude", "Longitude"))
    return (
        features.fit_clusters(rows)
        .transform(rows)
        .groupBy("coord_cluster")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("Latitude"), 6).alias("latitude"),
            F.round(F.avg("Longitude"), 6).alias("longitude"),
        )
    )


@query
def feature_matrix(spark, d):
    table = prepared(spark, d).table
    return table.select(
        "ID", "label", "split",
        F.transform(vector_to_array("features"), lambda x: F.round(x, 6).cast("string"))
        .alias("features"),
    )


@query
def train_rf(spark, d):
    return models.regression_metrics(forest_of(spark, d).score(prepared(spark, d).table))


@query
def train_gbt(spark, d):
    return metrics_of(spark, d, "gradient_boosting")


@query
def train_linear(spark, d):
    return metrics_of(spark, d, "linear_regression")


@query
def train_ridge(spark, d):
    return metrics_of(spark, d, "ridge")


@query
def train_lasso(spark, d):
    return metrics_of(spark, d, "lasso")


@query
def train_rbf_approx(spark, d):
    return metrics_of(spark, d, "rbf")


@query
def importance_table(spark, d):
    return models.importance_table(forest_of(spark, d))


@query
def cv_mae(spark, d):
    return models.cv_mae(prepared(spark, d), "ridge")


@query
def tune(spark, d):
    _, results = models.tune(prepared(spark, d), "ridge")
    return results


@query
def score_confidence(spark, d):
    scored_rows = models.score_confidence(forest_of(spark, d), prepared(spark, d).table)
    return scored_rows.select("ID", "prediction", "confidence")


@query
def prediction_rows(spark, d):
    as_of = F.lit(views.AS_OF).cast("timestamp_ntz")
    return models.prediction_rows(
        forest_of(spark, d), accidents(spark, d), "accident_severity_rf:1.0", "batch_1", as_of
    )
