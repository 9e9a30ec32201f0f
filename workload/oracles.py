"""The same queries as plain SQL, written apart from the library."""

from __future__ import annotations

from workload.views import AS_OF, CHANGES, FEATURES, INCIDENTS, MODELS, PREDICTIONS

ORACLES: dict[str, str] = {}

RAW_LIST = """
id AS "ID", source AS "Source", severity AS "Severity",
CAST(start_time AS VARCHAR) AS "Start_Time", CAST(end_time AS VARCHAR) AS "End_Time",
start_lat AS "Start_Lat", start_lng AS "Start_Lng", city AS "City", county AS "County",
state AS "State", zipcode AS "Zipcode", timezone AS "Timezone",
temperature_f AS "Temperature(F)", humidity_pct AS "Humidity(%)",
pressure_in AS "Pressure(in)", visibility_mi AS "Visibility(mi)",
wind_direction AS "Wind_Direction", wind_speed_mph AS "Wind_Speed(mph)",
precipitation_in AS "Precipitation(in)", weather_condition AS "Weather_Condition",
bump AS "Bump", crossing AS "Crossing", give_way AS "Give_Way", junction AS "Junction",
no_exit AS "No_Exit", railway AS "Railway", roundabout AS "Roundabout",
station AS "Station", stop AS "Stop", traffic_calming AS "Traffic_Calming",
traffic_signal AS "Traffic_Signal", turning_loop AS "Turning_Loop"
"""

# Incidents after defaults; complete ones; one per id; clean ones.
CTES = f"""
inc AS ({INCIDENTS}),
filled AS (
  SELECT id, tie_a, tie_b, tie_c, coalesce(source, 'Unknown') AS source,
    coalesce(severity, 2) AS severity, start_time, end_time, start_lat, start_lng,
    coalesce(city, 'Unknown') AS city, coalesce(county, 'Unknown') AS county,
    coalesce(state, 'Unknown') AS state, coalesce(zipcode, 'Unknown') AS zipcode,
    coalesce(timezone, 'Unknown') AS timezone,
    coalesce(temperature_f, 70.0) AS temperature_f,
    coalesce(humidity_pct, 50.0) AS humidity_pct,
    coalesce(pressure_in, 30.0) AS pressure_in,
    coalesce(visibility_mi, 10.0) AS visibility_mi,
    coalesce(wind_direction, 'Unknown') AS wind_direction,
    coalesce(wind_speed_mph, 0.0) AS wind_speed_mph,
    coalesce(precipitation_in, 0.0) AS precipitation_in,
    coalesce(weather_condition, 'Unknown') AS weather_condition,
    coalesce(bump, false) AS bump, coalesce(crossing, false) AS crossing,
    coalesce(give_way, false) AS give_way, coalesce(junction, false) AS junction,
    coalesce(no_exit, false) AS no_exit, coalesce(railway, false) AS railway,
    coalesce(roundabout, false) AS roundabout, coalesce(station, false) AS station,
    coalesce(stop, false) AS stop, coalesce(traffic_calming, false) AS traffic_calming,
    coalesce(traffic_signal, false) AS traffic_signal,
    coalesce(turning_loop, false) AS turning_loop, bucket
  FROM inc),
comp AS (
  SELECT * FROM filled WHERE id IS NOT NULL AND start_lat IS NOT NULL
    AND start_lng IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL),
uniq AS (
  SELECT * FROM comp
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY tie_a, tie_b, tie_c) = 1),
judged AS (
  SELECT *, CAST(date_diff('second', date_trunc('second', start_time),
      date_trunc('second', end_time)) AS DOUBLE) / 3600 AS hours,
    start_lat BETWEEN -90 AND 90 AND start_lng BETWEEN -180 AND 180
      AND start_lat <> 0 AND start_lng <> 0 AS geo_ok
  FROM uniq),
cl AS (
  SELECT id AS "ID", trim(source) AS "Source", severity AS "Severity",
    start_time AS "Start_Time", end_time AS "End_Time", hours AS "Duration_Hours",
    start_lat AS "Latitude", start_lng AS "Longitude", trim(city) AS "City",
    trim(county) AS "County", upper(trim(state)) AS "State",
    trim(zipcode) AS "Zipcode", trim(timezone) AS "Timezone",
    CASE WHEN temperature_f BETWEEN -50 AND 130 THEN temperature_f ELSE 70 END AS "Temperature_F",
    CASE WHEN humidity_pct BETWEEN 0 AND 100 THEN humidity_pct ELSE 50 END AS "Humidity_Pct",
    CASE WHEN pressure_in BETWEEN 25 AND 35 THEN pressure_in ELSE 30 END AS "Pressure_In",
    CASE WHEN visibility_mi BETWEEN 0 AND 15 THEN visibility_mi ELSE 10 END AS "Visibility_Mi",
    CASE WHEN wind_speed_mph BETWEEN 0 AND 200 THEN wind_speed_mph ELSE 0 END AS "Wind_Speed_Mph",
    CASE WHEN precipitation_in BETWEEN 0 AND 10 THEN precipitation_in ELSE 0 END AS "Precipitation_In",
    trim(weather_condition) AS "Weather_Condition", trim(wind_direction) AS "Wind_Direction",
    bump AS "Bump", crossing AS "Crossing", give_way AS "Give_Way", junction AS "Junction",
    no_exit AS "No_Exit", railway AS "Railway", roundabout AS "Roundabout",
    station AS "Station", stop AS "Stop", traffic_calming AS "Traffic_Calming",
    traffic_signal AS "Traffic_Signal", turning_loop AS "Turning_Loop", bucket
  FROM judged WHERE geo_ok AND severity BETWEEN 1 AND 4 AND hours BETWEEN 0 AND 168),
obs AS (
  SELECT *,
    CASE WHEN regexp_matches("Weather_Condition", 'clear|fair|sunny', 'i') THEN 'Clear'
      WHEN regexp_matches("Weather_Condition", 'cloud|overcast', 'i') THEN 'Cloudy'
      WHEN regexp_matches("Weather_Condition", 'rain|drizzle|shower', 'i') THEN 'Rainy'
      WHEN regexp_matches("Weather_Condition", 'snow|sleet|ice|hail', 'i') THEN 'Snow/Ice'
      WHEN regexp_matches("Weather_Condition", 'fog|mist|haze', 'i') THEN 'Fog/Mist'
      WHEN regexp_matches("Weather_Condition", 'thunder|storm', 'i') THEN 'Storm'
      ELSE 'Other' END AS "Weather_Category",
    CASE WHEN "Temperature_F" < 32 THEN 'Freezing' WHEN "Temperature_F" < 50 THEN 'Cold'
      WHEN "Temperature_F" < 70 THEN 'Mild' WHEN "Temperature_F" < 85 THEN 'Warm'
      ELSE 'Hot' END AS "Temperature_Category"
  FROM cl),
impact AS (
  SELECT "ID" AS incident_id, "Weather_Category" AS weather_condition,
    "Severity" AS severity_score, "Temperature_F" AS temperature,
    "Humidity_Pct" AS humidity, "Wind_Speed_Mph" AS wind_speed,
    "Pressure_In" AS pressure, CAST("Start_Time" AS DATE) AS analysis_date
  FROM obs),
summ AS (
  SELECT weather_condition, count(*) AS incident_count, avg(severity_score) AS avg_severity,
    avg(temperature) AS avg_temperature, avg(humidity) AS avg_humidity,
    avg(wind_speed) AS avg_wind_speed
  FROM impact GROUP BY weather_condition),
daily AS (
  SELECT CAST(analysis_date AS VARCHAR) AS date, weather_condition,
    count(*) AS incident_count, avg(severity_score) AS avg_severity
  FROM impact GROUP BY ALL),
freq AS (
  SELECT "Weather_Category" AS weather_category,
    "Temperature_Category" AS temperature_category, count(*) AS accident_count,
    CAST(sum(count(*)) OVER () AS BIGINT) AS total_accidents
  FROM obs GROUP BY ALL),
cells AS (
  SELECT strftime("Start_Time", '%Y-%m') AS period_month, month("Start_Time") AS m,
    "Weather_Category" AS weather_category, count(*) AS total_accidents,
    CAST(sum("Severity") AS BIGINT) AS s
  FROM obs GROUP BY ALL),
cells2 AS (
  SELECT *, count(*) OVER (PARTITION BY m) AS k,
    CAST(sum(total_accidents) OVER (PARTITION BY m) AS BIGINT) AS t
  FROM cells),
trend AS (
  SELECT period_month, weather_category, total_accidents,
    CAST((s * 200 + total_accidents) // (2 * total_accidents) AS DOUBLE) / 100 AS avg_severity,
    CAST((total_accidents * k * 2000 + t) // (2 * t) AS DOUBLE) / 1000 AS seasonal_factor,
    CASE WHEN (total_accidents * k * 2000 + t) // (2 * t) > 1200 THEN 'Increasing'
      WHEN (total_accidents * k * 2000 + t) // (2 * t) < 800 THEN 'Decreasing'
      ELSE 'Stable' END AS trend_direction
  FROM cells2),
pred AS ({PREDICTIONS}),
scored AS (
  SELECT *, abs(predicted_severity - actual_severity) AS error
  FROM pred WHERE actual_severity IS NOT NULL),
mods AS ({MODELS}),
feats AS ({FEATURES}),
chg AS ({CHANGES})
"""


def sql(name: str, body: str) -> None:
    ORACLES[name] = f"WITH {CTES.strip()}\n{body.strip()}"


# ---------------------------------------------------------------------------
# Scan, cleaning

ORACLES["scan_parquet"] = """
SELECT * EXCLUDE (l_shipdate), CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem
"""
ORACLES["project_available"] = """
SELECT l_orderkey, l_quantity, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem
"""

_TYPES = {
    "ID": ("id", "string"), "Source": ("source", "string"),
    "Severity": ("severity", "int"),
    "Start_Time": ("start_time", "timestamp_ntz"),
    "End_Time": ("end_time", "timestamp_ntz"),
    "Start_Lat": ("start_lat", "double"), "Start_Lng": ("start_lng", "double"),
    "City": ("city", "string"), "County": ("county", "string"),
    "State": ("state", "string"), "Zipcode": ("zipcode", "string"),
    "Timezone": ("timezone", "string"),
    "Temperature(F)": ("temperature_f", "double"),
    "Humidity(%)": ("humidity_pct", "double"),
    "Pressure(in)": ("pressure_in", "double"),
    "Visibility(mi)": ("visibility_mi", "double"),
    "Wind_Direction": ("wind_direction", "string"),
    "Wind_Speed(mph)": ("wind_speed_mph", "double"),
    "Precipitation(in)": ("precipitation_in", "double"),
    "Weather_Condition": ("weather_condition", "string"),
    "Bump": ("bump", "boolean"), "Crossing": ("crossing", "boolean"),
    "Give_Way": ("give_way", "boolean"), "Junction": ("junction", "boolean"),
    "No_Exit": ("no_exit", "boolean"), "Railway": ("railway", "boolean"),
    "Roundabout": ("roundabout", "boolean"), "Station": ("station", "boolean"),
    "Stop": ("stop", "boolean"), "Traffic_Calming": ("traffic_calming", "boolean"),
    "Traffic_Signal": ("traffic_signal", "boolean"),
    "Turning_Loop": ("turning_loop", "boolean"),
}
sql(
    "null_profile",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, "
        f"count(*) - count({col}) AS null_count, count(*) AS total_rows, "
        f"CAST(((count(*) - count({col})) * 20000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100"
        " AS null_percentage FROM inc"
        for name, (col, kind) in _TYPES.items()
    ),
)
sql("fill_defaults", f"SELECT {RAW_LIST} FROM filled")
sql(
    "drop_incomplete",
    """
SELECT id AS "ID", CAST(start_time AS VARCHAR) AS "Start_Time",
  CAST(end_time AS VARCHAR) AS "End_Time", start_lat AS "Start_Lat", start_lng AS "Start_Lng"
FROM comp
""",
)
sql(
    "dedup_by_key",
    """
SELECT id AS "ID", tie_a, tie_b, tie_c, severity AS "Severity", start_lat AS "Start_Lat",
  weather_condition AS "Weather_Condition" FROM uniq
""",
)
sql(
    "filter_geo",
    'SELECT id AS "ID", start_lat AS "Start_Lat", start_lng AS "Start_Lng" FROM judged WHERE geo_ok',
)
sql(
    "filter_domain",
    'SELECT id AS "ID", severity AS "Severity" FROM uniq WHERE severity BETWEEN 1 AND 4',
)
sql(
    "quality_waterfall",
    """
, n AS (
  SELECT (SELECT count(*) FROM inc) AS r0, (SELECT count(*) FROM comp) AS r1,
    (SELECT count(*) FROM uniq) AS r2, (SELECT count(*) FROM judged WHERE geo_ok) AS r3,
    (SELECT count(*) FROM judged WHERE geo_ok AND severity BETWEEN 1 AND 4) AS r4,
    (SELECT count(*) FROM cl) AS r5)
SELECT CAST(0 AS INT) AS step, 'input' AS rule, CAST(0 AS BIGINT) AS rows_removed, r0 AS rows_left FROM n
UNION ALL SELECT 1, 'incomplete', r0 - r1, r1 FROM n
UNION ALL SELECT 2, 'duplicate', r1 - r2, r2 FROM n
UNION ALL SELECT 3, 'geo', r2 - r3, r3 FROM n
UNION ALL SELECT 4, 'severity', r3 - r4, r4 FROM n
UNION ALL SELECT 5, 'duration', r4 - r5, r5 FROM n
""",
)
sql(
    "parse_timestamps",
    """
, texts AS (
  SELECT id, CASE tie_a % 6 WHEN 0 THEN strftime(start_time, '%Y-%m-%d %H:%M:%S')
      WHEN 1 THEN concat(strftime(start_time, '%Y-%m-%d %H:%M:%S'), '.250000') END AS st,
    strftime(end_time, '%Y-%m-%d %H:%M:%S') AS et
  FROM inc)
SELECT id AS "ID", CAST(TRY_CAST(st AS TIMESTAMP) AS VARCHAR) AS "Start_Time",
  CAST(TRY_CAST(et AS TIMESTAMP) AS VARCHAR) AS "End_Time" FROM texts
""",
)
_HOURS = (
    "CAST(date_diff('second', date_trunc('second', start_time), date_trunc('second', end_time)) "
    "AS DOUBLE) / 3600"
)
sql("duration_hours", f'SELECT id AS "ID", {_HOURS} AS "Duration_Hours" FROM inc')
sql(
    "filter_duration",
    f'SELECT id AS "ID", {_HOURS} AS "Duration_Hours" FROM inc WHERE {_HOURS} BETWEEN 0 AND 168',
)
sql(
    "standardize_text",
    """
SELECT id AS "ID", upper(trim(state)) AS "State", trim(city) AS "City", trim(county) AS "County",
  trim(source) AS "Source", trim(weather_condition) AS "Weather_Condition",
  trim(wind_direction) AS "Wind_Direction", trim(zipcode) AS "Zipcode",
  trim(timezone) AS "Timezone" FROM inc
""",
)
sql(
    "range_or_default",
    """
SELECT id AS "ID",
  CASE WHEN temperature_f BETWEEN -50 AND 130 THEN temperature_f ELSE 70 END AS "Temperature_F",
  CASE WHEN humidity_pct BETWEEN 0 AND 100 THEN humidity_pct ELSE 50 END AS "Humidity_Pct",
  CASE WHEN pressure_in BETWEEN 25 AND 35 THEN pressure_in ELSE 30 END AS "Pressure_In",
  CASE WHEN visibility_mi BETWEEN 0 AND 15 THEN visibility_mi ELSE 10 END AS "Visibility_Mi",
  CASE WHEN wind_speed_mph BETWEEN 0 AND 200 THEN wind_speed_mph ELSE 0 END AS "Wind_Speed_Mph",
  CASE WHEN precipitation_in BETWEEN 0 AND 10 THEN precipitation_in ELSE 0 END AS "Precipitation_In"
FROM inc
""",
)
sql(
    "validate_rows",
    f"""
, rws AS (
  SELECT id, CASE WHEN tie_a % 50 = 0 THEN repeat('x', 51) ELSE weather_condition END AS w,
    severity AS s, bucket - 3 AS n, {_HOURS} AS h, (bucket - 50) / 32.0 AS c,
    CAST(end_time AS DATE) AS d
  FROM inc)
SELECT id AS "ID", concat_ws(',',
  CASE WHEN w IS NULL OR length(w) > 50 THEN 'weather_category_length' END,
  CASE WHEN s IS NULL OR s < 1 OR s > 4 THEN 'severity_level_range' END,
  CASE WHEN n < 0 THEN 'accident_count_min' END,
  CASE WHEN h < 0 THEN 'avg_duration_min' END,
  CASE WHEN c < -1 OR c > 1 THEN 'correlation_range' END,
  CASE WHEN d IS NULL THEN 'analysis_date_present' END) AS violations
FROM rws
""",
)

# ---------------------------------------------------------------------------
# Subject tables

_SCORE = """CASE "Weather_Category" WHEN 'Clear' THEN 1 WHEN 'Cloudy' THEN 2 WHEN 'Fog/Mist' THEN 3
  WHEN 'Rainy' THEN 4 WHEN 'Snow/Ice' THEN 5 WHEN 'Storm' THEN 6 ELSE 2 END"""
_REGION = """CASE WHEN "State" IN ('ME','NH','VT','MA','RI','CT') THEN 'Northeast'
  WHEN "State" IN ('NY','NJ','PA') THEN 'Mid-Atlantic'
  WHEN "State" IN ('OH','MI','IN','WI','IL','MN','IA','MO','ND','SD','NE','KS') THEN 'Midwest'
  WHEN "State" IN ('DE','MD','DC','VA','WV','KY','TN','NC','SC','GA','FL','AL','MS','AR','LA','OK','TX') THEN 'South'
  WHEN "State" IN ('MT','WY','CO','NM','ID','UT','NV','AZ','WA','OR','CA','AK','HI') THEN 'West'
  ELSE 'Other' END"""

sql(
    "weather_clean",
    f"""
SELECT "ID", "State", CAST("Start_Time" AS VARCHAR) AS "Timestamp", "Temperature_F",
  "Humidity_Pct", "Pressure_In", "Visibility_Mi", "Wind_Speed_Mph", "Precipitation_In",
  "Weather_Condition", "Wind_Direction", "Weather_Category", "Temperature_Category",
  CAST({_SCORE} AS INT) AS "Weather_Severity_Score"
FROM obs
""",
)
sql(
    "location_clean",
    f"""
SELECT "ID", "Latitude", "Longitude", "State", "City", "County", "Zipcode", "Timezone",
  {_REGION} AS "Region",
  CASE WHEN "City" <> 'Unknown' THEN 'Urban' ELSE 'Rural' END AS "Area_Type",
  CAST(CAST(CAST(round(CAST("Latitude" AS DECIMAL(12,6)), 2) AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) AS "Latitude_Rounded",
  CAST(CAST(CAST(round(CAST("Longitude" AS DECIMAL(12,6)), 2) AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) AS "Longitude_Rounded"
FROM cl
""",
)
_FLAGS11 = " + ".join(
    f'CAST("{f}" AS INT)'
    for f in (
        "Bump", "Crossing", "Give_Way", "Junction", "Railway", "Roundabout", "Station",
        "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop",
    )
)
_COMPLEX = f"""CASE WHEN {_FLAGS11} = 0 THEN 'Simple' WHEN {_FLAGS11} <= 2 THEN 'Moderate'
  WHEN {_FLAGS11} <= 5 THEN 'Complex' ELSE 'Very_Complex' END"""


def _period(ts: str) -> str:
    return (
        f"CASE WHEN hour({ts}) BETWEEN 6 AND 11 THEN 'Morning' "
        f"WHEN hour({ts}) BETWEEN 12 AND 17 THEN 'Afternoon' "
        f"WHEN hour({ts}) BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END"
    )


def _calendar(ts: str) -> str:
    return (
        f'CAST(hour({ts}) AS INT) AS "Hour_of_Day", '
        f'CAST(dayofweek({ts}) + 1 AS INT) AS "Day_of_Week", '
        f'CAST(month({ts}) AS INT) AS "Month", strftime({ts}, \'%Y\') AS "Year", '
        f'dayofweek({ts}) IN (0, 6) AS "Is_Weekend"'
    )


_LABEL = (
    "CASE {s} WHEN 1 THEN 'Minor' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Serious' "
    "WHEN 4 THEN 'Severe' ELSE 'Unknown' END"
)
sql(
    "accidents_clean",
    f"""
SELECT "ID", "Source", "Severity", CAST("Start_Time" AS VARCHAR) AS "Start_Time",
  CAST("End_Time" AS VARCHAR) AS "End_Time", "Duration_Hours", "State", "City", "County",
  "Latitude", "Longitude", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway",
  "Roundabout", "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop",
  {_calendar('"Start_Time"')}, {_period('"Start_Time"')} AS "Time_Period",
  {_LABEL.format(s='"Severity"')} AS "Severity_Category",
  {_FLAGS11} AS "Road_Complexity_Score", {_COMPLEX} AS "Road_Complexity_Category"
FROM cl
""",
)
_CATEGORY = """CASE WHEN regexp_matches(weather_condition, 'clear|fair|sunny', 'i') THEN 'Clear'
  WHEN regexp_matches(weather_condition, 'cloud|overcast', 'i') THEN 'Cloudy'
  WHEN regexp_matches(weather_condition, 'rain|drizzle|shower', 'i') THEN 'Rainy'
  WHEN regexp_matches(weather_condition, 'snow|sleet|ice|hail', 'i') THEN 'Snow/Ice'
  WHEN regexp_matches(weather_condition, 'fog|mist|haze', 'i') THEN 'Fog/Mist'
  WHEN regexp_matches(weather_condition, 'thunder|storm', 'i') THEN 'Storm' ELSE 'Other' END"""
sql("weather_category", f'SELECT id AS "ID", {_CATEGORY} AS category FROM inc')
sql(
    "temperature_category",
    """
SELECT id AS "ID", CASE WHEN t < 32 THEN 'Freezing' WHEN t < 50 THEN 'Cold' WHEN t < 70 THEN 'Mild'
  WHEN t < 85 THEN 'Warm' ELSE 'Hot' END AS category
FROM (SELECT id, CASE WHEN temperature_f BETWEEN -50 AND 130 THEN temperature_f ELSE 70 END AS t FROM inc)
""",
)
sql(
    "weather_score",
    f"""
SELECT id AS "ID", CAST({_SCORE} AS INT) AS score
FROM (SELECT id, {_CATEGORY} AS "Weather_Category" FROM inc)
""",
)
sql(
    "region_of_state",
    f"""
SELECT id AS "ID", "State", {_REGION} AS "Region"
FROM (SELECT id, upper(trim(state)) AS "State" FROM inc)
""",
)
sql(
    "area_type",
    """
SELECT id AS "ID", CASE WHEN trim(city) <> 'Unknown' THEN 'Urban' ELSE 'Rural' END AS "Area_Type"
FROM filled
""",
)
_GRID = "CAST(CAST(CAST(round(CAST({c} AS DECIMAL(12,6)), 2) AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE)"
sql(
    "geo_grid",
    f"""
SELECT {_GRID.format(c='start_lat')} AS lat_rounded, {_GRID.format(c='start_lng')} AS lng_rounded,
  count(*) AS n
FROM inc GROUP BY ALL
""",
)
sql("calendar_parts", f'SELECT id AS "ID", {_calendar("start_time")} FROM inc')
sql("time_period", f'SELECT id AS "ID", {_period("start_time")} AS "Time_Period" FROM inc')
sql(
    "severity_label",
    f'SELECT id AS "ID", {_LABEL.format(s="severity")} AS "Severity_Category" FROM inc',
)
sql(
    "flag_score",
    f"""
SELECT "ID", {_FLAGS11} AS "Road_Complexity_Score", {_COMPLEX} AS "Road_Complexity_Category" FROM cl
""",
)

# ---------------------------------------------------------------------------
# Split, sample, union

_PART = "CAST(CASE WHEN bucket < 33 THEN 1 WHEN bucket < 66 THEN 2 ELSE 3 END AS INT)"
sql("hash_split", f'SELECT id AS "ID", {_PART} AS part FROM inc')
for _day, (_date, _cut) in enumerate(
    (("2025-01-01", 33), ("2025-01-02", 66), ("2025-01-03", 100)), 1
):
    sql(
        f"snapshot_day{_day}",
        f"SELECT id AS \"ID\", tie_a, '{_date}' AS ingestion_date FROM inc WHERE bucket < {_cut}",
    )
sql("union_parts", f'SELECT id AS "ID", tie_a, {_PART} AS part FROM inc')
sql(
    "sample_n",
    """
SELECT id AS "ID", tie_a, tie_b, tie_c FROM inc
ORDER BY md5(id), id, tie_a, tie_b, tie_c LIMIT 500
""",
)
sql(
    "train_val_test",
    """
SELECT id AS "ID", CASE WHEN bucket < 60 THEN 'train' WHEN bucket < 80 THEN 'validation'
  ELSE 'test' END AS split FROM inc
""",
)
sql(
    "distinct_values",
    'SELECT DISTINCT weather_condition AS "Weather_Condition", source AS "Source" FROM inc',
)

# ---------------------------------------------------------------------------
# Joins and marts

sql(
    "join_incidents_weather",
    """
, a AS (SELECT "ID", "Severity", "Start_Time", "Duration_Hours" FROM cl),
w AS (SELECT "ID", "Temperature_F", "Humidity_Pct", "Wind_Speed_Mph", "Pressure_In",
  "Weather_Category", "Temperature_Category" FROM obs)
SELECT a."ID", a."Severity", CAST(a."Start_Time" AS VARCHAR) AS "Start_Time", a."Duration_Hours",
  w.* EXCLUDE ("ID")
FROM a JOIN w ON a."ID" = w."ID"
""",
)
sql(
    "frequency_mart",
    """
SELECT weather_category, temperature_category, accident_count, total_accidents,
  CAST((accident_count * 20000 + total_accidents) // (2 * total_accidents) AS DOUBLE) / 100 AS frequency_percentage
FROM freq
""",
)


def _severity(
    name: str, snow: str, rain: str, fog: str, score: str = "any_value(score)", more: str = ""
) -> None:
    sql(
        name,
        f"""
, sc AS (
  SELECT *, CASE WHEN "Weather_Category" = '{snow}' THEN 9 WHEN "Weather_Category" = '{rain}' THEN 7
    WHEN "Weather_Category" = '{fog}' THEN 8 WHEN "Wind_Speed_Mph" > 20 THEN 6
    WHEN "Temperature_F" < 32 THEN 5 ELSE 3 END AS tenths
  FROM obs),
pw AS (
  SELECT "Weather_Category" AS wc, CAST(sum(tenths) AS DOUBLE) / (count(*) * 10) AS score
  FROM sc GROUP BY 1)
SELECT "Weather_Category" AS weather_category, "Severity" AS severity_level,
  count(*) AS accident_count,
  CAST((CAST(sum(round("Duration_Hours" * 3600)) AS BIGINT) * 200 + count(*) * 3600)
    // (count(*) * 7200) AS DOUBLE) / 100 AS avg_duration_hours,
  {score} AS correlation_score{more}
FROM sc JOIN pw ON wc = "Weather_Category" GROUP BY 1, 2
""",
    )


_severity("severity_mart", "Snow", "Rain", "Fog")
_severity("severity_mart_fixed", "Snow/Ice", "Rainy", "Fog/Mist")
_severity(
    "mart_conform_severity", "Snow", "Rain", "Fog",
    "CAST(CAST(any_value(score) AS DECIMAL(5, 3)) AS DOUBLE)",
    ", '2025-01-03' AS analysis_date",
)
sql(
    "mart_conform_frequency",
    """
SELECT weather_category, temperature_category, accident_count, total_accidents,
  CAST((accident_count * 20000 + total_accidents) // (2 * total_accidents) AS DOUBLE) / 100 AS frequency_percentage,
  '2025-01-03' AS analysis_date
FROM freq
""",
)
sql(
    "severity_corr",
    """
SELECT round(corr(score, sev), 6) AS correlation, count(*) AS accident_count
FROM (SELECT CAST("Severity" AS DOUBLE) AS sev,
  CAST(CASE WHEN "Weather_Category" = 'Snow/Ice' THEN 0.9 WHEN "Weather_Category" = 'Rainy' THEN 0.7
    WHEN "Weather_Category" = 'Fog/Mist' THEN 0.8 WHEN "Wind_Speed_Mph" > 20 THEN 0.6
    WHEN "Temperature_F" < 32 THEN 0.5 ELSE 0.3 END AS DOUBLE) AS score FROM obs)
""",
)
sql("trend_mart", "SELECT * FROM trend")
sql("mart_conform", "SELECT *, '2025-01-03' AS analysis_date FROM trend")

# ---------------------------------------------------------------------------
# Reports

sql("impact_summary", "SELECT * FROM summ")
sql("daily_by_condition", "SELECT * FROM daily")
_BANDS = """
SELECT CASE WHEN severity_score < 3 THEN 'Low' WHEN severity_score < 7 THEN 'Medium' ELSE 'High' END
  AS severity_category, weather_condition, count(*) AS count
FROM impact GROUP BY ALL
"""
sql("severity_bands", _BANDS)
sql(
    "severity_band_totals",
    f"""
SELECT severity_category, CAST(sum(count) AS BIGINT) AS count FROM ({_BANDS}) GROUP BY 1
""",
)
sql(
    "correlation_rows",
    """
SELECT temperature_f AS temperature, humidity_pct AS humidity, wind_speed_mph AS wind_speed,
  pressure_in AS pressure, severity AS severity_score, weather_condition
FROM inc
WHERE temperature_f IS NOT NULL AND humidity_pct IS NOT NULL AND wind_speed_mph IS NOT NULL
""",
)
sql(
    "ols_by_group",
    """
SELECT weather_condition, round(regr_slope(severity_score, temperature), 6) AS slope,
  round(regr_intercept(severity_score, temperature), 6) AS intercept,
  round(regr_r2(severity_score, temperature), 6) AS r2, count(*) AS n
FROM impact GROUP BY 1
""",
)
ORACLES["condition_day_pivot"] = (
    "SELECT event_type AS weather_condition, "
    + ", ".join(
        f"CAST(count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-{d:02d}') AS DOUBLE) AS \"2024-01-{d:02d}\""
        for d in range(1, 32)
    )
    + " FROM events GROUP BY 1"
)
sql(
    "daily_series",
    """
SELECT date, CAST(sum(incident_count) AS BIGINT) AS incident_count,
  round(avg(avg_severity), 6) AS avg_severity FROM daily GROUP BY 1
""",
)
sql(
    "condition_profile",
    """
SELECT weather_condition, avg_temperature / 10 AS temperature, avg_humidity / 10 AS humidity,
  avg_wind_speed AS wind_speed, avg_severity AS severity FROM summ
""",
)
sql(
    "kpi_weather",
    """
SELECT CAST(sum(incident_count) AS BIGINT) AS total_incidents,
  round(avg(avg_severity), 6) AS average_severity,
  (SELECT weather_condition FROM summ ORDER BY incident_count DESC, weather_condition LIMIT 1) AS top_condition,
  count(*) AS conditions
FROM summ
""",
)
sql(
    "kpi_models",
    """
SELECT count(*) FILTER (is_active) AS active_models, max(f1_score) AS best_f1,
  (SELECT model_name FROM mods ORDER BY f1_score DESC NULLS LAST, id LIMIT 1) AS best_model,
  count(*) AS versions
FROM mods
""",
)
sql(
    "model_comparison",
    """
SELECT model_name, avg(accuracy) AS avg_accuracy, avg(precision_score) AS avg_precision,
  avg(recall) AS avg_recall, avg(f1_score) AS avg_f1, count(*) AS version_count,
  CAST(CAST(max(training_date) AS DATE) AS VARCHAR) AS latest_training
FROM mods GROUP BY 1
""",
)
sql(
    "model_evolution",
    "SELECT model_name, CAST(CAST(training_date AS DATE) AS VARCHAR) AS training_date, f1_score, id FROM mods",
)
sql(
    "best_model",
    "SELECT model_name, id, 1 - accuracy AS error FROM mods WHERE accuracy IS NOT NULL ORDER BY 1 - accuracy, id LIMIT 1",
)
sql(
    "predictions_summary",
    f"""
SELECT CAST(CAST(prediction_date AS DATE) AS VARCHAR) AS date, predicted_severity,
  min(confidence_score) AS confidence_score, count(*) AS prediction_count,
  avg(confidence_score) AS avg_confidence
FROM pred WHERE prediction_date >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1, 2
""",
)
sql(
    "prediction_timeline",
    """
SELECT CAST(CAST(prediction_date AS DATE) AS VARCHAR) AS date, predicted_severity, count(*) AS count
FROM pred GROUP BY 1, 2
""",
)
sql(
    "prediction_accuracy",
    """
SELECT p.prediction_id, CAST(CAST(p.prediction_date AS DATE) AS VARCHAR) AS date,
  p.predicted_severity, a.actual_severity,
  abs(p.predicted_severity - a.actual_severity) AS error, p.confidence_score
FROM pred p JOIN pred a ON p.prediction_id = a.prediction_id
WHERE a.actual_severity IS NOT NULL
ORDER BY p.prediction_date DESC, p.prediction_id LIMIT 1000
""",
)
sql(
    "confusion_matrix",
    """
SELECT actual_severity AS actual,
  CAST(round_even(predicted_severity + (prediction_id % 3) / 2, 0) AS INT) AS predicted,
  count(*) AS count,
  CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY actual_severity) AS share
FROM scored GROUP BY 1, 2
""",
)
sql(
    "confidence_histogram",
    """
SELECT CAST(least(floor(confidence_score * 20) + 1, 20) AS INT) AS bin, count(*) AS count,
  (least(floor(confidence_score * 20) + 1, 20) - 1) / 20 AS bin_start
FROM pred GROUP BY 1, 3
""",
)
sql(
    "error_box",
    """
, q AS (
  SELECT predicted_severity AS p, quantile_cont(CAST(error AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST(error AS DOUBLE), 0.5) AS median,
    quantile_cont(CAST(error AS DOUBLE), 0.75) AS q3
  FROM scored GROUP BY 1),
f AS (
  SELECT s.*, q.*, error BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM scored s JOIN q ON q.p = s.predicted_severity)
SELECT predicted_severity, any_value(q1) AS q1, any_value(median) AS median,
  any_value(q3) AS q3, CAST(min(error) FILTER (inside) AS DOUBLE) AS whisker_low,
  CAST(max(error) FILTER (inside) AS DOUBLE) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers, count(*) AS count
FROM f GROUP BY 1
""",
)
sql(
    "model_scores",
    """
, labels_of AS (
  SELECT model_id, actual_severity AS label FROM scored
  UNION SELECT model_id, predicted_severity FROM scored),
per AS (
  SELECT l.model_id, l.label,
    count(*) FILTER (s.actual_severity = l.label) AS support,
    count(*) FILTER (s.predicted_severity = l.label) AS called,
    count(*) FILTER (s.predicted_severity = l.label AND s.actual_severity = l.label) AS hits
  FROM labels_of l JOIN scored s ON s.model_id = l.model_id GROUP BY 1, 2)
SELECT model_id, CAST(sum(support) AS BIGINT) AS samples,
  round(CAST(sum(hits) AS DOUBLE) / sum(support), 6) AS accuracy,
  round(avg(CASE WHEN called = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / called END), 6) AS precision_score,
  round(avg(CASE WHEN support = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / support END), 6) AS recall,
  round(avg(CAST(2 * hits AS DOUBLE) / (called + support)), 6) AS f1_score
FROM per GROUP BY 1
""",
)
sql(
    "describe_numeric",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, count({c}) AS count, avg({c}) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        + ", ".join(
            f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS q{int(p * 100)}"
            for p in (0.25, 0.5, 0.75)
        )
        + f", CAST(max({c}) AS DOUBLE) AS max FROM inc"
        for name, c in (
            ("Severity", "severity"), ("Start_Lat", "start_lat"),
            ("Start_Lng", "start_lng"), ("Temperature(F)", "temperature_f"),
            ("Humidity(%)", "humidity_pct"), ("Pressure(in)", "pressure_in"),
            ("Wind_Speed(mph)", "wind_speed_mph"),
        )
    ),
)
_ABSENT = " + ".join(f"(count(*) - count({c}))" for c, _ in _TYPES.values())
sql(
    "completeness",
    f"""
SELECT count(*) AS total_rows, CAST({len(_TYPES)} AS INT) AS total_columns,
  {_ABSENT} AS missing_values,
  round(100 - CAST(({_ABSENT}) * 100 AS DOUBLE) / (count(*) * {len(_TYPES)}), 1) AS completeness_pct
FROM inc
""",
)
sql(
    "mart_summary",
    """
SELECT (SELECT count(*) FROM freq)
    + (SELECT count(*) FROM (SELECT DISTINCT "Weather_Category", "Severity" FROM obs))
    + (SELECT count(*) FROM trend) AS total_records,
  (SELECT string_agg(weather_category, ',' ORDER BY weather_category)
   FROM (SELECT DISTINCT weather_category FROM freq)) AS weather_categories,
  '2025-01-03' AS date_from, '2025-01-03' AS date_to,
  (SELECT avg(accident_count) FROM freq) AS avg_accident_count,
  (SELECT weather_category FROM freq GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_common_weather
""",
)
sql(
    "column_range",
    "SELECT min(severity_score) AS min_value, max(severity_score) AS max_value FROM impact",
)

# ---------------------------------------------------------------------------
# Listings

sql(
    "list_mart_page",
    """
SELECT *, '2025-01-03' AS analysis_date FROM trend WHERE weather_category = 'Rainy'
ORDER BY period_month, weather_category LIMIT 50 OFFSET 10
""",
)
sql(
    "get_by_id",
    """
SELECT * EXCLUDE (training_date), CAST(CAST(training_date AS DATE) AS VARCHAR) AS training_date
FROM mods WHERE id = 42
""",
)
# Changes in order of seq: what precedes the last delete or create of an id is void.
sql(
    "apply_changes",
    """
, cut AS (SELECT id, max(seq) FILTER (op <> 'update') AS cut FROM chg GROUP BY 1),
live AS (
  SELECT c.* FROM chg c JOIN cut USING (id) WHERE (cut IS NULL OR seq >= cut) AND op <> 'delete'),
masked AS (
  SELECT *, CASE WHEN sets IS NULL THEN model_name IS NOT NULL
      ELSE list_contains(string_split(sets, ','), 'model_name') END AS m1,
    CASE WHEN sets IS NULL THEN accuracy IS NOT NULL
      ELSE list_contains(string_split(sets, ','), 'accuracy') END AS m2,
    CASE WHEN sets IS NULL THEN f1_score IS NOT NULL
      ELSE list_contains(string_split(sets, ','), 'f1_score') END AS m3
  FROM live),
last AS (
  SELECT id, bool_or(op = 'create') AS created, bool_or(m1) AS s1, bool_or(m2) AS s2,
    bool_or(m3) AS s3,
    (max({'seq': seq, 'v': model_name}) FILTER (m1)).v AS model_name,
    (max({'seq': seq, 'v': accuracy}) FILTER (m2)).v AS accuracy,
    (max({'seq': seq, 'v': f1_score}) FILTER (m3)).v AS f1_score
  FROM masked GROUP BY 1),
base AS (
  SELECT m.id, m.model_name, m.accuracy, m.f1_score FROM mods m
  LEFT JOIN cut USING (id) WHERE cut IS NULL)
SELECT coalesce(b.id, l.id) AS id,
  CASE WHEN s1 THEN l.model_name ELSE b.model_name END AS model_name,
  CASE WHEN s2 THEN l.accuracy ELSE b.accuracy END AS accuracy,
  CASE WHEN s3 THEN l.f1_score ELSE b.f1_score END AS f1_score
FROM base b FULL JOIN last l ON b.id = l.id
WHERE b.id IS NOT NULL OR l.created
""",
)
sql(
    "apply_filters",
    """
SELECT *, avg_severity AS severity_score FROM daily
WHERE date BETWEEN '1996-01-01' AND '1999-12-31'
  AND weather_condition IN ('Rainy', 'Snow/Ice', 'Storm') AND avg_severity BETWEEN 2.0 AND 3.5
""",
)
sql(
    "top_n_sorted",
    """
SELECT "ID", "Duration_Hours", "Temperature_F" FROM cl ORDER BY "Duration_Hours" DESC, "ID" LIMIT 200
""",
)
sql(
    "page_of",
    'SELECT "ID", "Severity", "State" FROM cl ORDER BY "ID" LIMIT 25 OFFSET 150',
)
sql(
    "page_count",
    "SELECT count(*) AS total_rows, CAST(ceil(count(*) / 25.0) AS BIGINT) AS total_pages FROM cl",
)
sql(
    "head_formatted",
    """
SELECT id AS "ID", CASE WHEN temperature_f IS NULL THEN '' ELSE printf('%.2f', temperature_f) END
  AS "Temperature_F", severity AS "Severity"
FROM inc ORDER BY id, tie_a, tie_b, tie_c LIMIT 100
""",
)
sql(
    "model_listing",
    """
SELECT * EXCLUDE (training_date), CAST(CAST(training_date AS DATE) AS VARCHAR) AS training_date FROM mods
""",
)
sql(
    "top_features",
    """
SELECT feature_name, importance_score, model_name, model_version
FROM feats JOIN mods ON model_id = id WHERE model_name = 'ECONOMY'
ORDER BY importance_score DESC, feature_name, model_name, model_version LIMIT 15
""",
)
sql(
    "latest_active_model",
    """
SELECT id, model_name, model_version, CAST(CAST(training_date AS DATE) AS VARCHAR) AS training_date
FROM mods WHERE is_active
QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY training_date DESC, model_version, id) = 1
""",
)

# ---------------------------------------------------------------------------
# Features and metrics

sql(
    "haversine_km",
    """
SELECT id AS "ID", round(2 * 6371 * asin(sqrt(pow(sin(radians(39.828125 - start_lat) / 2), 2)
  + cos(radians(start_lat)) * cos(radians(CAST(39.828125 AS DOUBLE)))
  * pow(sin(radians(-98.5625 - start_lng) / 2), 2))), 6) AS km
FROM inc
""",
)
sql(
    "median_impute",
    """
SELECT id AS "ID",
  coalesce(temperature_f, (SELECT quantile_cont(temperature_f, 0.5) FROM inc)) AS temperature,
  coalesce(humidity_pct, (SELECT quantile_cont(humidity_pct, 0.5) FROM inc)) AS humidity
FROM inc
""",
)

_LATR = _GRID.format(c='"Latitude"')
_LNGR = _GRID.format(c='"Longitude"')
sql(
    "geo_features",
    f"""
, c AS (SELECT "City" AS c, count(*) AS n FROM cl GROUP BY 1),
top AS (SELECT c FROM c ORDER BY n DESC, c LIMIT 50),
st AS (SELECT "State" AS s, dense_rank() OVER (ORDER BY "State") - 1 AS code
  FROM (SELECT DISTINCT "State" FROM cl))
SELECT "ID", {_LATR} AS lat_rounded, {_LNGR} AS lng_rounded,
  "Latitude" * "Longitude" AS lat_lng_interaction, CAST(code AS INT) AS state_encoded,
  n AS city_frequency, CAST("City" IN (SELECT c FROM top) AS INT) AS is_major_city
FROM cl JOIN c ON c.c = "City" JOIN st ON s = "State"
""",
)
_WAVES = ", ".join(
    f"round({fn}({col} * (2 * pi() / {period})), 6) AS {name}_{fn}"
    for name, col, period in (
        ("hour", "hour(t)", 24), ("month", "month(t)", 12), ("day", "(dayofweek(t) + 1)", 7),
    )
    for fn in ("sin", "cos")
)
sql(
    "temporal_features",
    f"""
, x AS (SELECT "ID", "Start_Time" AS t, "Duration_Hours" AS h FROM cl)
SELECT "ID", CAST(hour(t) AS INT) AS hour, CAST(dayofweek(t) + 1 AS INT) AS day_of_week,
  CAST(month(t) AS INT) AS month, CAST(year(t) AS INT) AS year,
  CAST(dayofyear(t) AS INT) AS day_of_year,
  CAST(dayofweek(t) IN (0, 6) AS INT) AS is_weekend,
  CAST(hour(t) BETWEEN 7 AND 9 OR hour(t) BETWEEN 17 AND 19 AS INT) AS is_rush_hour,
  CAST(hour(t) >= 22 OR hour(t) <= 6 AS INT) AS is_night, {_WAVES},
  CAST(CASE WHEN month(t) IN (12, 1, 2) THEN 0 WHEN month(t) <= 5 THEN 1
    WHEN month(t) <= 8 THEN 2 ELSE 3 END AS INT) AS season,
  greatest(0.0, least(24.0, h)) AS duration_hours
FROM x
""",
)
_ALL_FLAGS = (
    "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout",
    "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop",
)
sql(
    "env_features",
    'SELECT "ID", '
    + ", ".join(f'CAST("{f}" AS INT) AS {f.lower()}_flag' for f in _ALL_FLAGS)
    + ", "
    + " + ".join(f'CAST("{f}" AS INT)' for f in _ALL_FLAGS)
    + f" AS road_features_count, {_FLAGS11} AS road_complexity_score FROM cl",
)
sql(
    "label_encode",
    f"""
, x AS (SELECT "ID", "State", {_period('"Start_Time"')} AS "Time_Period", "Source",
  {_COMPLEX} AS "Road_Complexity_Category", {_LABEL.format(s='"Severity"')} AS "Severity_Category"
  FROM cl)
SELECT *, CAST(dense_rank() OVER (ORDER BY "State") - 1 AS INT) AS state_encoded,
  CAST(dense_rank() OVER (ORDER BY "Time_Period") - 1 AS INT) AS time_period_encoded,
  CAST(dense_rank() OVER (ORDER BY "Road_Complexity_Category") - 1 AS INT) AS road_complexity_encoded,
  CAST(dense_rank() OVER (ORDER BY "Severity_Category") - 1 AS INT) AS severity_category_encoded,
  CAST(dense_rank() OVER (ORDER BY "Source") - 1 AS INT) AS source_encoded
FROM x
""",
)
sql(
    "zscore",
    'SELECT "ID", '
    + ", ".join(
        f'round(("{c}" - avg("{c}") OVER ()) / stddev_pop("{c}") OVER (), 6) AS "{c}"'
        for c in ("Temperature_F", "Humidity_Pct", "Pressure_In")
    )
    + " FROM cl",
)
_KIND = """CASE WHEN regexp_matches(lower(feature_name), 'lat|lng|coord|state|city') THEN 'geographic'
  WHEN regexp_matches(lower(feature_name), 'hour|day|month|time|season|weekend') THEN 'temporal'
  WHEN regexp_matches(lower(feature_name), 'bump|junction|signal|road|traffic') THEN 'infrastructure'
  WHEN regexp_matches(lower(feature_name), 'source|severity|duration') THEN '{last}'
  ELSE 'other' END"""
sql(
    "feature_catalog",
    f"""
SELECT *, {_KIND.format(last='accident_context')} AS feature_type,
  {_KIND.format(last='accident')} AS feature_category,
  CASE feature_name WHEN 'lat_rounded' THEN 'Rounded latitude coordinate'
    WHEN 'hour' THEN 'Hour of the day when accident occurred'
    WHEN 'is_weekend' THEN 'Whether accident occurred on weekend'
    WHEN 'road_features_count' THEN 'Count of road infrastructure features present'
    ELSE concat('Feature: ', feature_name) END AS description
FROM feats
""",
)
sql(
    "feature_stats",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature_name, CAST(min({c}) AS DOUBLE) AS min_value, "
        f"CAST(max({c}) AS DOUBLE) AS max_value, avg({c}) AS mean_value, "
        f"round(stddev_pop({c}), 6) AS std_value, "
        f"CAST(((count(*) - count({c})) * 20000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100"
        " AS null_percentage FROM inc"
        for name, c in (
            ("temperature", "temperature_f"), ("humidity", "humidity_pct"),
            ("Start_Lat", "start_lat"), ("Severity", "severity"),
        )
    ),
)
sql(
    "regression_metrics",
    """
, x AS (
  SELECT CASE WHEN bucket < 60 THEN 'train' WHEN bucket < 80 THEN 'validation' ELSE 'test' END AS split,
    CAST(severity AS DOUBLE) AS y, humidity_pct / 32 AS p
  FROM inc WHERE bucket % 7 <> 0 AND severity IS NOT NULL AND humidity_pct IS NOT NULL)
SELECT split, count(*) AS samples, round(avg(abs(y - p)), 6) AS mae,
  round(avg((y - p) * (y - p)), 6) AS mse, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2
FROM x GROUP BY 1
""",
)
sql(
    "confidence_formula",
    """
, v AS (SELECT "ID", "Temperature_F" / 64 AS a, "Humidity_Pct" / 64 AS b, "Pressure_In" / 64 AS c FROM cl),
m AS (SELECT *, (a + b + c) / 3 AS mean, (abs(a) + abs(b) + abs(c)) / 3 AS size FROM v)
SELECT "ID", round(greatest(0.0, least(1.0, 1 - sqrt(((a - mean) * (a - mean) + (b - mean) * (b - mean)
  + (c - mean) * (c - mean)) / 3) / size)), 6) AS confidence
FROM m
""",
)
