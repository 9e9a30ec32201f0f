"""Subject tables: weather, location and accidents, all 1:1 on ID."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiered import specs
from tiered.functions.exprs import (
    below_cuts,
    first_match,
    flag_sum,
    lookup,
    lookup_members,
    within_ranges,
    year_text,
)
from tiered.operators.cleaning import available


def weather_category(c: Column) -> Column:
    return first_match(c, specs.WEATHER_RULES, specs.WEATHER_DEFAULT)


def temperature_category(c: Column) -> Column:
    return below_cuts(c, specs.TEMPERATURE_CUTS, specs.TEMPERATURE_TOP)


def weather_score(category: Column) -> Column:
    return lookup(category, specs.WEATHER_SCORES, specs.WEATHER_SCORE_DEFAULT)


def region_of_state(state: Column) -> Column:
    return lookup_members(state, specs.REGIONS, specs.REGION_DEFAULT)


def area_type(city: Column) -> Column:
    return F.when(city.isNotNull() & (city != "Unknown"), F.lit("Urban")).otherwise(
        F.lit("Rural")
    )


def time_period(hour: Column) -> Column:
    return within_ranges(hour, specs.TIME_PERIODS, specs.TIME_PERIOD_DEFAULT)


def severity_label(severity: Column) -> Column:
    return lookup(severity, specs.SEVERITY_LABELS, "Unknown")


def complexity_label(score: Column) -> Column:
    return within_ranges(score, specs.COMPLEXITY_LABELS, specs.COMPLEXITY_TOP)


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Hour, day of week (1 = Sunday), month, year as text, weekend flag."""
    dow = F.dayofweek(ts)
    return {
        "Hour_of_Day": F.hour(ts),
        "Day_of_Week": dow,
        "Month": F.month(ts),
        "Year": year_text(ts),
        "Is_Weekend": dow.isin(1, 7),
    }


def weather_table(clean: DataFrame) -> DataFrame:
    measures = available(clean, [r.target for r in specs.RANGES])
    tail = available(clean, ["Weather_Condition", "Wind_Direction", "ingestion_date"])
    # The score is a second step: in one step the category, with its patterns,
    # would be evaluated again for every branch of the score.
    return clean.select(
        specs.KEY,
        "State",
        F.col("Start_Time").alias("Timestamp"),
        *measures,
        *tail,
        weather_category(F.col("Weather_Condition")).alias("Weather_Category"),
        temperature_category(F.col("Temperature_F")).alias("Temperature_Category"),
    ).withColumn("Weather_Severity_Score", weather_score(F.col("Weather_Category")))


def location_table(clean: DataFrame) -> DataFrame:
    lat, lng = F.col("Start_Lat"), F.col("Start_Lng")
    return clean.select(
        specs.KEY,
        lat.alias("Latitude"),
        lng.alias("Longitude"),
        *available(
            clean, ["State", "City", "County", "Zipcode", "Timezone", "ingestion_date"]
        ),
        region_of_state(F.col("State")).alias("Region"),
        area_type(F.col("City")).alias("Area_Type"),
        F.round(lat, 2).alias("Latitude_Rounded"),
        F.round(lng, 2).alias("Longitude_Rounded"),
    )


def accidents_table(clean: DataFrame) -> DataFrame:
    parts = calendar_parts(F.col("Start_Time"))
    score = flag_sum(available(clean, specs.COMPLEXITY_FLAGS))
    base = clean.select(
        specs.KEY,
        "Source",
        "Severity",
        "Start_Time",
        "End_Time",
        "Duration_Hours",
        *available(clean, ["State", "City", "County"]),
        F.col("Start_Lat").alias("Latitude"),
        F.col("Start_Lng").alias("Longitude"),
        *available(clean, specs.FLAGS),
        *available(clean, ["ingestion_date"]),
        *[c.alias(n) for n, c in parts.items()],
        score.alias("Road_Complexity_Score"),
    )
    return base.withColumns(
        {
            "Time_Period": time_period(F.col("Hour_of_Day")),
            "Severity_Category": severity_label(F.col("Severity")),
            "Road_Complexity_Category": complexity_label(F.col("Road_Complexity_Score")),
        }
    )


SUBJECTS = {
    "accidents_clean": accidents_table,
    "weather_clean": weather_table,
    "location_clean": location_table,
}


def observations(clean: DataFrame) -> DataFrame:
    """What the marts read, straight from the clean table.

    The subject tables are projections of one table with one row per ID, so
    their inner join on ID is again a projection of it. Reading the clean
    table gives the same rows without shuffling both sides.
    """
    category = weather_category(F.col("Weather_Condition"))
    return clean.select(
        specs.KEY,
        "Severity",
        "Start_Time",
        "Duration_Hours",
        "Temperature_F",
        "Humidity_Pct",
        "Wind_Speed_Mph",
        "Pressure_In",
        category.alias("Weather_Category"),
        temperature_category(F.col("Temperature_F")).alias("Temperature_Category"),
    )


def join_subjects(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner join of accidents and weather on ID, narrowed on both sides first."""
    a = accidents.select(specs.KEY, "Severity", "Start_Time", "Duration_Hours")
    w = weather.select(
        specs.KEY,
        "Temperature_F",
        "Humidity_Pct",
        "Wind_Speed_Mph",
        "Pressure_In",
        "Weather_Category",
        "Temperature_Category",
    )
    return a.join(w, specs.KEY, "inner")
