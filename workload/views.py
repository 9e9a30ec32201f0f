"""Views over the given Parquet tables; each statement runs in Spark and DuckDB.

INCIDENTS turns line items into dirty incident records: nulls, duplicate keys,
bad ranges, padded and mixed-case text. All arithmetic is on integers or binary
exact fractions, so both engines give the same values. PREDICTIONS, MODELS,
FEATURES and CHANGES stand in for the model tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

INCIDENTS = """
SELECT
  concat('A-', CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING)) AS id,
  l.l_partkey AS tie_a,
  l.l_suppkey AS tie_b,
  l.l_extendedprice AS tie_c,
  concat(' Source', CAST(1 + l.l_suppkey % 3 AS STRING), ' ') AS source,
  CASE WHEN l.l_partkey % 23 = 0 THEN NULL WHEN l.l_partkey % 31 = 0 THEN 5
       ELSE CAST(1 + l.l_partkey % 4 AS INT) END AS severity,
  l.l_shipdate + (l.l_orderkey % 24) * INTERVAL '1' HOUR
    + (l.l_suppkey % 1000) * INTERVAL '1' MILLISECOND AS start_time,
  CASE WHEN l.l_partkey % 41 = 0 THEN NULL
       ELSE l.l_shipdate + (l.l_orderkey % 24 + l.l_partkey % 200 - 4) * INTERVAL '1' HOUR
         + (l.l_orderkey % 60) * INTERVAL '1' MINUTE + (l.l_partkey % 1000) * INTERVAL '1' MILLISECOND END AS end_time,
  CASE WHEN l.l_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
       ELSE 25 + CAST(l.l_orderkey % 2400 AS DOUBLE) / 64 END AS start_lat,
  CASE WHEN l.l_orderkey % 89 = 0 THEN NULL
       ELSE -67 - CAST(l.l_partkey % 7000 AS DOUBLE) / 64 END AS start_lng,
  CASE WHEN s.s_nationkey % 7 = 0 THEN NULL ELSE concat(' ', n.n_name, CASE WHEN l.l_suppkey % 4 = 0 THEN ''
         ELSE concat(' ', CAST(l.l_suppkey % 4 AS STRING)) END, ' ') END AS city,
  CASE WHEN l.l_suppkey % 9 = 0 THEN NULL
       ELSE concat(' County', CAST(l.l_suppkey % 50 AS STRING), ' ') END AS county,
  CASE s.s_nationkey % 6 WHEN 0 THEN ' ca' WHEN 1 THEN 'TX ' WHEN 2 THEN 'ny'
       WHEN 3 THEN 'OH' WHEN 4 THEN 'ma' ELSE 'ZZ' END AS state,
  CASE WHEN l.l_suppkey % 13 = 0 THEN NULL
       ELSE concat(' ', CAST(10000 + l.l_suppkey % 900 AS STRING)) END AS zipcode,
  CASE n.n_regionkey WHEN 0 THEN ' US/Eastern' WHEN 1 THEN 'US/Central ' WHEN 2 THEN 'US/Mountain'
       WHEN 3 THEN ' US/Pacific ' ELSE NULL END AS timezone,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_quantity * 4 - 60 END AS temperature_f,
  CASE WHEN l.l_linenumber = 6 THEN NULL ELSE l.l_quantity * 2 + 5 END AS humidity_pct,
  CASE WHEN l.l_linenumber = 4 THEN NULL ELSE 24 + l.l_quantity / 4 END AS pressure_in,
  CASE WHEN l.l_linenumber = 3 THEN NULL ELSE CAST(l.l_partkey % 20 AS DOUBLE) END AS visibility_mi,
  CASE l.l_partkey % 6 WHEN 0 THEN ' N' WHEN 1 THEN 'SSW ' WHEN 2 THEN 'Calm' WHEN 3 THEN 'E'
       WHEN 4 THEN 'VAR' ELSE NULL END AS wind_direction,
  CASE WHEN l.l_linenumber = 5 THEN NULL ELSE CAST(l.l_suppkey % 60 AS DOUBLE) END AS wind_speed_mph,
  CASE WHEN l.l_linenumber = 2 THEN NULL ELSE l.l_quantity / 4 - 1 END AS precipitation_in,
  CASE l.l_suppkey % 12 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Partly Cloudy' WHEN 2 THEN 'Light Rain'
       WHEN 3 THEN 'Snow Showers' WHEN 4 THEN 'Light Snow' WHEN 5 THEN 'Fog'
       WHEN 6 THEN 'Heavy T-Storm' WHEN 7 THEN 'Thunderstorms and Rain' WHEN 8 THEN 'Smoke'
       WHEN 9 THEN 'Overcast' WHEN 10 THEN ' Fair ' ELSE NULL END AS weather_condition,
  CASE WHEN l.l_orderkey % 11 = 0 THEN NULL ELSE l.l_orderkey % 2 = 0 END AS bump,
  l.l_orderkey % 3 = 0 AS crossing,
  l.l_orderkey % 7 = 0 AS give_way,
  l.l_partkey % 5 = 0 AS junction,
  l.l_partkey % 13 = 0 AS no_exit,
  CASE WHEN l.l_suppkey % 17 = 0 THEN NULL ELSE l.l_suppkey % 5 = 0 END AS railway,
  l.l_partkey % 19 = 0 AS roundabout,
  l.l_orderkey % 4 = 0 AS station,
  l.l_partkey % 3 = 0 AS stop,
  l.l_suppkey % 6 = 0 AS traffic_calming,
  l.l_suppkey % 4 = 0 AS traffic_signal,
  l.l_orderkey % 29 = 0 AS turning_loop,
  CAST(l.l_orderkey % 100 AS INT) AS bucket
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
"""

# The view's names against the raw record names the library works on.
RAW_NAMES = {
    "id": "ID", "source": "Source", "severity": "Severity",
    "start_time": "Start_Time", "end_time": "End_Time", "start_lat": "Start_Lat",
    "start_lng": "Start_Lng", "city": "City", "county": "County", "state": "State",
    "zipcode": "Zipcode", "timezone": "Timezone",
    "temperature_f": "Temperature(F)", "humidity_pct": "Humidity(%)",
    "pressure_in": "Pressure(in)", "visibility_mi": "Visibility(mi)",
    "wind_direction": "Wind_Direction", "wind_speed_mph": "Wind_Speed(mph)",
    "precipitation_in": "Precipitation(in)",
    "weather_condition": "Weather_Condition", "bump": "Bump",
    "crossing": "Crossing", "give_way": "Give_Way", "junction": "Junction",
    "no_exit": "No_Exit", "railway": "Railway", "roundabout": "Roundabout",
    "station": "Station", "stop": "Stop", "traffic_calming": "Traffic_Calming",
    "traffic_signal": "Traffic_Signal", "turning_loop": "Turning_Loop",
}
TIES = ("tie_a", "tie_b", "tie_c")

PREDICTIONS = """
SELECT event_id AS prediction_id,
  CAST(1 + user_id % 3 AS INT) AS model_id,
  concat('E-', CAST(event_id AS STRING)) AS accident_id,
  CAST(1 + event_id % 4 AS INT) AS predicted_severity,
  CAST(user_id % 100 AS DOUBLE) / 128 AS confidence_score,
  ts AS prediction_date,
  CASE WHEN event_id % 10 = 0 THEN NULL
       ELSE CAST(1 + (event_id + user_id) % 4 AS INT) END AS actual_severity
FROM events
"""
AS_OF = "2024-01-31 00:00:00"

MODELS = """
SELECT p_partkey AS id, p_type AS model_name, p_brand AS model_version,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 64 END AS accuracy,
  CAST(p_partkey % 50 AS DOUBLE) / 64 AS precision_score,
  CAST(p_partkey % 40 AS DOUBLE) / 64 AS recall,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_partkey % 37 AS DOUBLE) / 64 END AS f1_score,
  DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS training_date,
  p_partkey % 3 = 0 AS is_active
FROM part
"""

FEATURES = """
SELECT p_partkey AS model_id,
  CASE p_partkey % 12 WHEN 0 THEN 'lat_rounded' WHEN 1 THEN 'city_frequency' WHEN 2 THEN 'hour'
       WHEN 3 THEN 'is_weekend' WHEN 4 THEN 'duration_hours' WHEN 5 THEN 'Duration_Km'
       WHEN 6 THEN 'junction_flag' WHEN 7 THEN 'road_features_count' WHEN 8 THEN 'source_encoded'
       WHEN 9 THEN 'crossing_flag' WHEN 10 THEN 'Traffic_Signal' ELSE 'season' END AS feature_name,
  CAST(p_size AS DOUBLE) / 64 AS importance_score
FROM part
"""

CHANGES = """
SELECT p_partkey AS id, 1 AS seq, 'update' AS op, CAST(NULL AS STRING) AS model_name,
  CAST(NULL AS DOUBLE) AS accuracy, CAST(p_size AS DOUBLE) / 32 AS f1_score, 'accuracy,f1_score' AS sets
FROM part WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey, 2, 'update', 'renamed', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS STRING)
FROM part WHERE p_partkey % 8 = 0
UNION ALL
SELECT p_partkey, 3, 'delete', CAST(NULL AS STRING), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), ''
FROM part WHERE p_partkey % 5 = 0
UNION ALL
SELECT p_partkey, 4, 'create', 'again', CAST(0.5 AS DOUBLE), CAST(NULL AS DOUBLE), 'model_name,accuracy'
FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 17 = 0
UNION ALL
SELECT -p_partkey, 5, 'create', 'new', CAST(p_size AS DOUBLE) / 16, CAST(0.25 AS DOUBLE), 'model_name,f1_score'
FROM part WHERE p_partkey % 3 = 0
UNION ALL
SELECT -p_partkey - 1000000000, 6, 'update', 'absent', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 'model_name'
FROM part WHERE p_partkey % 7 = 0
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    # Bound names instead of temp views: nothing is left behind in the session.
    frames = {n: table(spark, sf_dir, n) for n in names}
    text = sql
    for n in names:
        text = text.replace(f"FROM {n}", f"FROM {{{n}}}").replace(
            f"JOIN {n}", f"JOIN {{{n}}}"
        )
    return spark.sql(text, **frames)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incident records plus the tie columns and the bucket."""
    raw = _view(spark, sf_dir, INCIDENTS, "lineitem", "supplier", "nation")
    return raw.withColumnsRenamed(RAW_NAMES)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, PREDICTIONS, "events")


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, MODELS, "part")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FEATURES, "part")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes; ``sets`` lists the fields a change sets, null for those not null."""
    rows = _view(spark, sf_dir, CHANGES, "part")
    return rows.withColumn("sets", F.split("sets", ","))
