"""The three weather marts.

``measures`` projects incidents (``subjects.observations`` or
``subjects.join_subjects``) to the marts' dimensions and additive measures;
``cells`` sums them per dimension tuple. Every mart takes either form, so one
mart can be asked for alone, and all three can be built from one pass over the
incidents. Aggregates combine before the shuffle; windows run over the
aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiered import specs
from tiered.functions.exprs import lookup, month_text, ratio_half_up, try_decimal


def danger_score(labels: Mapping[str, float]) -> Column:
    """Hazard of a record: by label, else by wind, else by frost."""
    wind, wind_score = specs.DANGER_WIND
    frost, frost_score = specs.DANGER_FROST
    rest = (
        F.when(F.col("Wind_Speed_Mph") > wind, F.lit(wind_score))
        .when(F.col("Temperature_F") < frost, F.lit(frost_score))
        .otherwise(F.lit(specs.DANGER_DEFAULT))
    )
    return F.coalesce(lookup(F.col("Weather_Category"), labels, None), rest)


DIMENSIONS = (
    "period_month", "weather_category", "temperature_category", "severity_level",
)
ADDITIVE = ("n", "seconds", "tenths")


def measures(
    obs: DataFrame, labels: Mapping[str, float] = specs.DANGER_OBSERVED
) -> DataFrame:
    """One row per incident: dimensions, a count of one, duration and hazard.

    Durations are carried as whole seconds and hazard scores as whole tenths,
    which makes their means independent of the order of the rows.
    """
    return obs.select(
        month_text(F.col("Start_Time")).alias("period_month"),
        F.col("Weather_Category").alias("weather_category"),
        F.col("Temperature_Category").alias("temperature_category"),
        F.col("Severity").alias("severity_level"),
        F.lit(1).cast("bigint").alias("n"),
        F.round(F.col("Duration_Hours") * 3600).cast("bigint").alias("seconds"),
        F.round(danger_score(labels) * 10).cast("bigint").alias("tenths"),
    )


def cells(rows: DataFrame) -> DataFrame:
    """Measures summed per dimension tuple: months x labels x labels x 4 rows."""
    return rows.groupBy(*DIMENSIONS).agg(*[F.sum(c).alias(c) for c in ADDITIVE])


def frequency_mart(rows: DataFrame) -> DataFrame:
    """Count per (weather, temperature) and its share of all rows."""
    counts = rows.groupBy("weather_category", "temperature_category").agg(
        F.sum("n").alias("accident_count")
    )
    # At most labels x labels rows reach this window.
    total = F.sum("accident_count").over(Window.partitionBy())
    return (
        counts.withColumn("total_accidents", total)
        .withColumn(
            "frequency_percentage",
            ratio_half_up(
                F.col("accident_count") * 100, F.col("total_accidents"), 2
            ).cast("decimal(5,2)"),
        )
        .orderBy(F.desc("accident_count"), "weather_category", "temperature_category")
    )


def severity_mart(rows: DataFrame) -> DataFrame:
    """Count and mean duration per (weather, severity), mean hazard per weather.

    The mean per weather comes from the sums of its severity rows.
    """
    sums = rows.groupBy("weather_category", "severity_level").agg(
        *[F.sum(c).alias(c) for c in ADDITIVE]
    )
    w = Window.partitionBy("weather_category")
    return sums.select(
        "weather_category",
        "severity_level",
        F.col("n").alias("accident_count"),
        ratio_half_up(F.col("seconds"), F.col("n") * 3600, 2)
        .cast("decimal(8,2)")
        .alias("avg_duration_hours"),
        (F.sum("tenths").over(w) / (F.sum("n").over(w) * 10)).alias("correlation_score"),
    ).orderBy("weather_category", "severity_level")


def severity_corr(obs: DataFrame) -> DataFrame:
    """Pearson correlation of hazard and severity over all incidents."""
    scored = obs.select(
        "Severity", danger_score(specs.DANGER_MATCHING).alias("score")
    )
    return scored.agg(
        F.corr("score", "Severity").alias("correlation"),
        F.count(F.lit(1)).alias("accident_count"),
    )


def trend_mart(rows: DataFrame) -> DataFrame:
    """Per (month, weather): count, mean severity, seasonal factor and label.

    Seasonal factor: count over the mean count of the rows of the same
    calendar month, i.e. count * rows / sum, rounded half up in integers.
    """
    months = rows.groupBy("period_month", "weather_category").agg(
        F.sum("n").alias("total_accidents"),
        F.sum(F.col("severity_level") * F.col("n")).alias("severity_sum"),
    )
    # months of history x labels, split by calendar month.
    w = Window.partitionBy(F.substring("period_month", 6, 2))
    months = months.select(
        "*",
        F.count(F.lit(1)).over(w).alias("month_rows"),
        F.sum("total_accidents").over(w).alias("month_total"),
    )
    factor = ratio_half_up(
        F.col("total_accidents") * F.col("month_rows"), F.col("month_total"), 3
    )
    return (
        months.withColumn("factor", factor)
        .select(
            "period_month",
            "weather_category",
            "total_accidents",
            ratio_half_up(F.col("severity_sum"), F.col("total_accidents"), 2)
            .cast("decimal(3,2)")
            .alias("avg_severity"),
            F.when(F.col("factor") > F.lit(Decimal(specs.TREND_UP)), "Increasing")
            .when(F.col("factor") < F.lit(Decimal(specs.TREND_DOWN)), "Decreasing")
            .otherwise("Stable")
            .alias("trend_direction"),
            try_decimal(F.col("factor"), 5, 3).alias("seasonal_factor"),
        )
        .orderBy("period_month", "weather_category")
    )
