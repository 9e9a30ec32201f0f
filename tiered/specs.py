"""Schemas, defaults, ranges, rules and dimensions of the incident domain.

Operators are generic; everything domain-specific sits here as plain data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw records. Column names, defaults and valid ranges.

KEY = "ID"

FLAGS = (
    "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway",
    "Roundabout", "Station", "Stop", "Traffic_Calming", "Traffic_Signal",
    "Turning_Loop",
)
# No_Exit is recorded but does not count towards road complexity.
COMPLEXITY_FLAGS = tuple(f for f in FLAGS if f != "No_Exit")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Source", T.StringType()),
        T.StructField("Severity", T.IntegerType()),
        T.StructField("Start_Time", T.StringType()),
        T.StructField("End_Time", T.StringType()),
        T.StructField("Start_Lat", T.DoubleType()),
        T.StructField("Start_Lng", T.DoubleType()),
        T.StructField("City", T.StringType()),
        T.StructField("County", T.StringType()),
        T.StructField("State", T.StringType()),
        T.StructField("Zipcode", T.StringType()),
        T.StructField("Timezone", T.StringType()),
        T.StructField("Temperature(F)", T.DoubleType()),
        T.StructField("Humidity(%)", T.DoubleType()),
        T.StructField("Pressure(in)", T.DoubleType()),
        T.StructField("Visibility(mi)", T.DoubleType()),
        T.StructField("Wind_Direction", T.StringType()),
        T.StructField("Wind_Speed(mph)", T.DoubleType()),
        T.StructField("Precipitation(in)", T.DoubleType()),
        T.StructField("Weather_Condition", T.StringType()),
    ]
    + [T.StructField(f, T.BooleanType()) for f in FLAGS]
)
RAW_COLUMNS = tuple(RAW_SCHEMA.names)

DEFAULTS = {
    **{f: False for f in FLAGS},
    **{
        c: "Unknown"
        for c in (
            "Source", "City", "County", "State", "Zipcode", "Timezone",
            "Wind_Direction", "Weather_Condition",
        )
    },
    "Severity": 2,
    "Temperature(F)": 70.0,
    "Humidity(%)": 50.0,
    "Pressure(in)": 30.0,
    "Visibility(mi)": 10.0,
    "Wind_Speed(mph)": 0.0,
    "Precipitation(in)": 0.0,
}
REQUIRED = ("ID", "Start_Lat", "Start_Lng", "Start_Time", "End_Time")


@dataclass(frozen=True)
class RangeRule:
    source: str
    target: str
    low: float
    high: float
    default: float


RANGES = (
    RangeRule("Temperature(F)", "Temperature_F", -50, 130, 70.0),
    RangeRule("Humidity(%)", "Humidity_Pct", 0, 100, 50.0),
    RangeRule("Pressure(in)", "Pressure_In", 25, 35, 30.0),
    RangeRule("Visibility(mi)", "Visibility_Mi", 0, 15, 10.0),
    RangeRule("Wind_Speed(mph)", "Wind_Speed_Mph", 0, 200, 0.0),
    RangeRule("Precipitation(in)", "Precipitation_In", 0, 10, 0.0),
)

SEVERITY_RANGE = (1, 4)
MAX_DURATION_HOURS = 168

TRIMMED = (
    "State", "City", "County", "Source", "Weather_Condition",
    "Wind_Direction", "Zipcode", "Timezone",
)
UPPERED = ("State",)

# ---------------------------------------------------------------------------
# Classification rules. Patterns, labels and cut points; the
# order of a rule list is part of its meaning, the first match wins.

WEATHER_RULES = (
    (r"(?i)(clear|fair|sunny)", "Clear"),
    (r"(?i)(cloud|overcast)", "Cloudy"),
    (r"(?i)(rain|drizzle|shower)", "Rainy"),
    (r"(?i)(snow|sleet|ice|hail)", "Snow/Ice"),
    (r"(?i)(fog|mist|haze)", "Fog/Mist"),
    (r"(?i)(thunder|storm)", "Storm"),
)
WEATHER_DEFAULT = "Other"

WEATHER_SCORES = {
    "Clear": 1, "Cloudy": 2, "Fog/Mist": 3, "Rainy": 4, "Snow/Ice": 5, "Storm": 6,
}
WEATHER_SCORE_DEFAULT = 2

TEMPERATURE_CUTS = ((32, "Freezing"), (50, "Cold"), (70, "Mild"), (85, "Warm"))
TEMPERATURE_TOP = "Hot"

REGIONS = {
    "Northeast": ("ME", "NH", "VT", "MA", "RI", "CT"),
    "Mid-Atlantic": ("NY", "NJ", "PA"),
    "Midwest": (
        "OH", "MI", "IN", "WI", "IL", "MN", "IA", "MO", "ND", "SD", "NE", "KS",
    ),
    "South": (
        "DE", "MD", "DC", "VA", "WV", "KY", "TN", "NC", "SC", "GA", "FL", "AL",
        "MS", "AR", "LA", "OK", "TX",
    ),
    "West": (
        "MT", "WY", "CO", "NM", "ID", "UT", "NV", "AZ", "WA", "OR", "CA", "AK",
        "HI",
    ),
}
REGION_DEFAULT = "Other"

TIME_PERIODS = (((6, 11), "Morning"), ((12, 17), "Afternoon"), ((18, 21), "Evening"))
TIME_PERIOD_DEFAULT = "Night"

SEVERITY_LABELS = {1: "Minor", 2: "Moderate", 3: "Serious", 4: "Severe"}

COMPLEXITY_LABELS = (((0, 0), "Simple"), ((1, 2), "Moderate"), ((3, 5), "Complex"))
COMPLEXITY_TOP = "Very_Complex"

# Danger score of a record: labels first, then wind, then frost.
# OBSERVED tests for labels that cleaning never produces, so only its wind and
# frost branches can fire; MATCHING tests for the labels that do occur.
DANGER_OBSERVED = {"Snow": 0.9, "Rain": 0.7, "Fog": 0.8}
DANGER_MATCHING = {"Snow/Ice": 0.9, "Rainy": 0.7, "Fog/Mist": 0.8}
DANGER_WIND = (20, 0.6)
DANGER_FROST = (32, 0.5)
DANGER_DEFAULT = 0.3

TREND_UP, TREND_DOWN = "1.2", "0.8"

SEVERITY_BANDS = ((3, "Low"), (7, "Medium"))
SEVERITY_BAND_TOP = "High"

# Feature catalogue (first keyword hit decides) and descriptions.
FEATURE_TYPES = (
    (("lat", "lng", "coord", "state", "city"), "geographic", "geographic"),
    (
        ("hour", "day", "month", "time", "season", "weekend"),
        "temporal", "temporal",
    ),
    (
        ("bump", "junction", "signal", "road", "traffic"),
        "infrastructure", "infrastructure",
    ),
    (("source", "severity", "duration"), "accident_context", "accident"),
)
FEATURE_TYPE_DEFAULT = "other"
FEATURE_DESCRIPTIONS = {
    "lat_rounded": "Rounded latitude coordinate",
    "lng_rounded": "Rounded longitude coordinate",
    "hour": "Hour of the day when accident occurred",
    "is_weekend": "Whether accident occurred on weekend",
    "is_rush_hour": "Whether accident occurred during rush hour",
    "road_features_count": "Count of road infrastructure features present",
    "road_complexity_score": "Complexity score based on road features",
}

# ---------------------------------------------------------------------------
# Snapshots.

SNAPSHOT_DATES = ("2025-01-01", "2025-01-02", "2025-01-03")
SNAPSHOT_CUTS = (33, 66, 100)  # cumulative percent of keys per date

# ---------------------------------------------------------------------------
# Names, types and keys of the stored marts and registry tables.


def _fields(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in cols])


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


_S, _I, _L, _D, _TS, _B = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DateType(),
    T.TimestampType(), T.BooleanType(),
)


@dataclass(frozen=True)
class TableSpec:
    """A stored table: schema, partition column and natural key."""

    name: str
    schema: T.StructType
    partition_by: str
    key: tuple[str, ...]


FREQUENCY = TableSpec(
    "weather_accident_frequency",
    _fields(
        ("weather_category", _S, False),
        ("temperature_category", _S, False),
        ("accident_count", _L, False),
        ("total_accidents", _L, False),
        ("frequency_percentage", _dec(5, 2), False),
        ("analysis_date", _D, False),
        ("created_at", _TS, True),
    ),
    "analysis_date",
    ("analysis_date", "weather_category", "temperature_category"),
)
SEVERITY = TableSpec(
    "weather_severity_correlation",
    _fields(
        ("weather_category", _S, False),
        ("severity_level", _I, False),
        ("accident_count", _L, False),
        ("avg_duration_hours", _dec(8, 2), True),
        ("correlation_score", _dec(5, 3), True),
        ("analysis_date", _D, False),
        ("created_at", _TS, True),
    ),
    "analysis_date",
    ("analysis_date", "weather_category", "severity_level"),
)
TRENDS = TableSpec(
    "weather_impact_trends",
    _fields(
        ("period_month", _S, False),
        ("weather_category", _S, False),
        ("total_accidents", _L, False),
        ("avg_severity", _dec(3, 2), False),
        ("trend_direction", _S, True),
        ("seasonal_factor", _dec(5, 3), True),
        ("analysis_date", _D, False),
        ("created_at", _TS, True),
    ),
    "analysis_date",
    ("analysis_date", "period_month", "weather_category"),
)
MODELS = TableSpec(
    "ml_models",
    _fields(
        ("model_id", _S, False),
        ("model_name", _S, False),
        ("model_version", _S, False),
        ("model_type", _S, False),
        ("algorithm", _S, False),
        ("training_date", _TS, False),
        ("feature_count", _I, False),
        ("training_samples", _L, False),
        ("validation_samples", _L, False),
        ("mae_score", _dec(10, 6), True),
        ("mse_score", _dec(10, 6), True),
        ("rmse_score", _dec(10, 6), True),
        ("r2_score", _dec(10, 6), True),
        ("model_path", _S, True),
        ("feature_importance", T.MapType(_S, T.DoubleType()), True),
        ("hyperparameters", T.MapType(_S, _S), True),
        ("is_active", _B, True),
    ),
    "model_id",
    ("model_name", "model_version"),
)
FEATURES = TableSpec(
    "ml_features",
    _fields(
        ("model_id", _S, False),
        ("feature_name", _S, False),
        ("feature_type", _S, False),
        ("importance_score", _dec(10, 6), True),
        ("feature_category", _S, True),
        ("description", _S, True),
        ("min_value", _dec(15, 6), True),
        ("max_value", _dec(15, 6), True),
        ("mean_value", _dec(15, 6), True),
        ("std_value", _dec(15, 6), True),
        ("null_percentage", _dec(5, 2), True),
    ),
    "model_id",
    ("model_id", "feature_name"),
)
PREDICTIONS = TableSpec(
    "ml_predictions",
    _fields(
        ("model_id", _S, False),
        ("prediction_batch", _S, False),
        ("accident_id", _S, True),
        ("predicted_severity", _dec(8, 4), False),
        ("confidence_score", _dec(5, 4), True),
        ("prediction_date", _TS, False),
        ("input_features", _S, True),
        ("actual_severity", _dec(8, 4), True),
        ("prediction_error", _dec(8, 4), True),
        ("is_validated", _B, True),
    ),
    "prediction_batch,model_id",
    ("prediction_batch", "model_id", "accident_id"),
)

# Output routing: short name -> table. Unknown names are an error.
MART_ROUTES = {"frequency": FREQUENCY, "severity": SEVERITY, "weather": TRENDS}
MODEL_ROUTES = {"models": MODELS, "features": FEATURES, "predictions": PREDICTIONS}

# Row rules of the marts (rule name, SQL condition a good row meets).
# A null passes where the column is nullable, as in the conditions below.
FREQUENCY_RULES = {
    "weather_category_length": "length(weather_category) <= 50",
    "temperature_category_length": "length(temperature_category) <= 20",
    "accident_count_min": "accident_count >= 0",
    "total_accidents_min": "total_accidents >= 0",
    "frequency_percentage_range": "frequency_percentage BETWEEN 0 AND 100",
    "analysis_date_present": "analysis_date IS NOT NULL",
}
SEVERITY_RULES = {
    "weather_category_length": "length(weather_category) <= 50",
    "severity_level_range": "severity_level BETWEEN 1 AND 4",
    "accident_count_min": "accident_count >= 0",
    "avg_duration_min": "avg_duration_hours IS NULL OR avg_duration_hours >= 0",
    "correlation_range": "correlation_score IS NULL OR correlation_score BETWEEN -1 AND 1",
    "analysis_date_present": "analysis_date IS NOT NULL",
}
TREND_RULES = {
    "period_month_pattern": r"period_month RLIKE '^[0-9]{4}-[0-9]{2}$'",
    "weather_category_length": "length(weather_category) <= 50",
    "total_accidents_min": "total_accidents >= 0",
    "avg_severity_range": "avg_severity BETWEEN 1 AND 4",
    "trend_direction_length": "trend_direction IS NULL OR length(trend_direction) <= 20",
    "seasonal_factor_min": "seasonal_factor IS NULL OR seasonal_factor >= 0",
    "analysis_date_present": "analysis_date IS NOT NULL",
}
PAGE_LIMIT_RANGE = (1, 1000)
