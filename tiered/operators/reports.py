"""Report queries and the aggregations behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiered import specs
from tiered.functions.exprs import below_cuts, is_missing, numeric_columns
from tiered.operators.quantiles import bracket_aggs, column_summary, refine

QUARTILES = (0.25, 0.5, 0.75)

# ---------------------------------------------------------------------------
# Weather impact


def impact_view(obs: DataFrame) -> DataFrame:
    """The rows the weather reports read: one per incident."""
    return obs.select(
        F.col(specs.KEY).alias("incident_id"),
        F.col("Weather_Category").alias("weather_condition"),
        F.col("Severity").alias("severity_score"),
        F.col("Temperature_F").alias("temperature"),
        F.col("Humidity_Pct").alias("humidity"),
        F.col("Wind_Speed_Mph").alias("wind_speed"),
        F.col("Pressure_In").alias("pressure"),
        F.to_date("Start_Time").alias("analysis_date"),
    )


def impact_summary(impact: DataFrame) -> DataFrame:
    return (
        impact.groupBy("weather_condition")
        .agg(
            F.count(F.lit(1)).alias("incident_count"),
            F.avg("severity_score").alias("avg_severity"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("wind_speed").alias("avg_wind_speed"),
        )
        .orderBy(F.desc("incident_count"), "weather_condition")
    )


def daily_by_condition(
    impact: DataFrame, date_from: str | None = None, date_to: str | None = None
) -> DataFrame:
    """Count and mean severity per (date, condition), optionally for a period."""
    if date_from:
        impact = impact.filter(F.col("analysis_date") >= F.lit(date_from).cast("date"))
    if date_to:
        impact = impact.filter(F.col("analysis_date") <= F.lit(date_to).cast("date"))
    return (
        impact.groupBy(F.to_date("analysis_date").alias("date"), "weather_condition")
        .agg(
            F.count(F.lit(1)).alias("incident_count"),
            F.avg("severity_score").alias("avg_severity"),
        )
        .orderBy(F.desc("date"), "weather_condition")
    )


def severity_bands(
    impact: DataFrame,
    cuts: Sequence[tuple[float, str]] = specs.SEVERITY_BANDS,
    top: str = specs.SEVERITY_BAND_TOP,
) -> DataFrame:
    """Count per (band, condition); the cut points are arguments."""
    band = below_cuts(F.col("severity_score"), cuts, top)
    return (
        impact.groupBy(band.alias("severity_category"), "weather_condition")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("severity_category", F.desc("count"), "weather_condition")
    )


def severity_band_totals(bands: DataFrame) -> DataFrame:
    return bands.groupBy("severity_category").agg(F.sum("count").alias("count"))


def correlation_rows(impact: DataFrame) -> DataFrame:
    """Rows where temperature, humidity and wind are all present."""
    return impact.select(
        "temperature", "humidity", "wind_speed", "pressure", "severity_score",
        "weather_condition",
    ).dropna(subset=["temperature", "humidity", "wind_speed"])


def ols_by_group(
    df: DataFrame, x: str, y: str, group: str = "weather_condition"
) -> DataFrame:
    """Least-squares line of y on x per group."""
    return df.groupBy(group).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def condition_day_pivot(daily: DataFrame, dates: Sequence) -> DataFrame:
    """Condition x date, mean of the daily counts, 0 for gaps.

    The dates are given, so no extra job looks for them and the width of the
    result is known. A date that is not among them is an error.
    """
    listed = F.col("date").isNull() | F.col("date").isin(list(dates))
    unlisted = F.raise_error(F.concat(F.lit("date outside the pivot: "), F.col("date")))
    rows = daily.withColumn("date", F.when(listed, F.col("date")).otherwise(unlisted.cast("date")))
    wide = rows.groupBy("weather_condition").pivot("date", list(dates)).agg(
        F.avg("incident_count")
    )
    return wide.fillna(0.0).orderBy("weather_condition")


def daily_series(daily: DataFrame) -> DataFrame:
    """Per date: sum of counts and the unweighted mean of the means."""
    return (
        daily.groupBy("date")
        .agg(
            F.sum("incident_count").alias("incident_count"),
            F.avg("avg_severity").alias("avg_severity"),
        )
        .orderBy("date")
    )


def condition_profile(summary: DataFrame) -> DataFrame:
    """Radar scales per condition."""
    return summary.groupBy("weather_condition").agg(
        (F.avg("avg_temperature") / 10).alias("temperature"),
        (F.avg("avg_humidity") / 10).alias("humidity"),
        F.avg("avg_wind_speed").alias("wind_speed"),
        F.avg("avg_severity").alias("severity"),
    )


def kpi_weather(summary: DataFrame) -> DataFrame:
    """Total, mean of means, top condition, number of conditions."""
    rank = F.struct(-F.col("incident_count"), F.col("weather_condition"))
    return summary.agg(
        F.sum("incident_count").alias("total_incidents"),
        F.avg("avg_severity").alias("average_severity"),
        F.min_by("weather_condition", rank).alias("top_condition"),
        F.count(F.lit(1)).alias("conditions"),
    )


# ---------------------------------------------------------------------------
# Models and predictions


def model_comparison(models: DataFrame) -> DataFrame:
    return (
        models.groupBy("model_name")
        .agg(
            F.avg("accuracy").alias("avg_accuracy"),
            F.avg("precision_score").alias("avg_precision"),
            F.avg("recall").alias("avg_recall"),
            F.avg("f1_score").alias("avg_f1"),
            F.count(F.lit(1)).alias("version_count"),
            F.max("training_date").alias("latest_training"),
        )
        .orderBy(F.desc("avg_f1"), "model_name")
    )


def kpi_models(models: DataFrame) -> DataFrame:
    """Active models, best F1 and its model (lowest id on a tie), versions.

    A model without an F1 is counted but never the best.
    """
    known = F.nanvl("f1_score", F.lit(None).cast("double"))
    rank = F.when(known.isNotNull(), F.struct(-known, F.col("id")))
    return models.agg(
        F.count_if("is_active").alias("active_models"),
        F.max(known).alias("best_f1"),
        F.min_by("model_name", rank).alias("best_model"),
        F.count(F.lit(1)).alias("versions"),
    )


def best_model(models: DataFrame, error: Column) -> DataFrame:
    """The model with the smallest error; the lowest id wins a tie.

    A model whose error is null or NaN is never the best.
    """
    known = F.nanvl(error.cast("double"), F.lit(None).cast("double"))
    rank = F.when(known.isNotNull(), F.struct(known, F.col("id")))
    return models.agg(
        F.min_by("model_name", rank).alias("model_name"),
        F.min_by("id", rank).alias("id"),
        F.min(known).alias("error"),
    )


def model_evolution(models: DataFrame) -> DataFrame:
    return models.select("model_name", "training_date", "f1_score", "id").orderBy(
        "model_name", "training_date", "id"
    )


def predictions_summary(predictions: DataFrame, days: int, as_of: str) -> DataFrame:
    """Last ``days`` days before ``as_of``, per (date, predicted severity)."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return (
        predictions.filter(F.col("prediction_date") >= since)
        .groupBy(F.to_date("prediction_date").alias("date"), "predicted_severity")
        .agg(
            F.min("confidence_score").alias("confidence_score"),
            F.count(F.lit(1)).alias("prediction_count"),
            F.avg("confidence_score").alias("avg_confidence"),
        )
        .orderBy(F.desc("date"), "predicted_severity")
    )


def prediction_timeline(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(F.to_date("prediction_date").alias("date"), "predicted_severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("date", "predicted_severity")
    )


def join_outcomes(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Predictions with their known outcome and absolute error."""
    known = outcomes.filter(F.col("actual_severity").isNotNull()).select(
        "prediction_id", "actual_severity"
    )
    return predictions.join(known, "prediction_id", "inner").withColumn(
        "error", F.abs(F.col("predicted_severity") - F.col("actual_severity"))
    )


def prediction_accuracy(
    predictions: DataFrame, outcomes: DataFrame, limit: int = 1000
) -> DataFrame:
    """The latest scored predictions, newest first."""
    return (
        join_outcomes(predictions, outcomes)
        .orderBy(F.desc("prediction_date"), "prediction_id")
        .limit(limit)
        .select(
            "prediction_id",
            F.to_date("prediction_date").alias("date"),
            "predicted_severity",
            "actual_severity",
            "error",
            "confidence_score",
        )
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Row-normalised confusion matrix in long form; halves go to the even label."""
    cells = scored.groupBy(
        F.bround("actual_severity").cast("int").alias("actual"),
        F.bround("predicted_severity").cast("int").alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("count"))
    row = F.sum("count").over(Window.partitionBy("actual"))
    return cells.withColumn("share", F.col("count") / row)


def confidence_histogram(
    df: DataFrame, column: str = "avg_confidence", bins: int = 20
) -> DataFrame:
    """Count per equal-width bin of 0..1; the value 1 belongs to the last bin."""
    bucket = F.least(F.width_bucket(F.col(column), F.lit(0.0), F.lit(1.0), F.lit(bins)),
                     F.lit(bins))
    return (
        df.groupBy(bucket.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("bin_start", (F.col("bin") - 1) / F.lit(bins))
        .orderBy("bin")
    )


def error_box(scored: DataFrame) -> DataFrame:
    """Box statistics of the error per predicted label; exact quartiles.

    Rows without an error are left out. The label is the key of the quantiles,
    which gather no label's errors in one task.
    """
    kind = scored.schema["predicted_severity"].dataType
    name = F.coalesce(F.col("predicted_severity").cast("string"), F.lit(""))
    error = F.col("error").cast("double")
    values = scored.select(name.alias("column_name"), error.alias("value")).filter(
        error.isNotNull() & ~F.isnan(error)
    )
    quartiles = (
        refine(values, values.groupBy("column_name").agg(*bracket_aggs(QUARTILES)), QUARTILES)
        .groupBy("column_name")
        .agg(
            *[
                F.max(F.when(F.col("p") == p, F.col("value"))).alias(q)
                for p, q in zip(QUARTILES, ("q1", "median", "q3"))
            ]
        )
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        values.join(quartiles, "column_name")
        .groupBy(F.col("column_name").try_cast(kind).alias("predicted_severity"))
        .agg(
            *[F.max(q).alias(q) for q in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
            F.count(F.lit(1)).alias("count"),
        )
        .orderBy("predicted_severity")
    )


def model_scores(scored: DataFrame) -> DataFrame:
    """Accuracy and macro precision, recall and F1 per model.

    Predicted and actual severity are rounded to labels first. A label without
    predictions has precision 0, as has one without hits.
    """
    cells = scored.groupBy(
        "model_id",
        F.bround("actual_severity").cast("int").alias("actual"),
        F.bround("predicted_severity").cast("int").alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("n"))
    # cells: labels x labels per model
    none = F.lit(0).cast("bigint")
    hits = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(none)

    def side(label: str, support: Column, called: Column, hit: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"), support.alias("support"),
            called.alias("called"), hit.alias("hits"),
        )

    sides = cells.select(
        "model_id",
        F.inline(
            F.array(
                side("actual", F.col("n"), none, hits),
                side("predicted", none, F.col("n"), none),
            )
        ),
    )
    per_label = sides.groupBy("model_id", "label").agg(
        F.sum("support").alias("support"),
        F.sum("called").alias("called"),
        F.sum("hits").alias("hits"),
    )
    precision = F.coalesce(F.try_divide("hits", "called"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(2 * F.col("hits"), F.col("called") + F.col("support")), F.lit(0.0)
    )
    return per_label.groupBy("model_id").agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg(precision).alias("precision_score"),
        F.avg(recall).alias("recall"),
        F.avg(f1).alias("f1_score"),
        F.sum("support").alias("samples"),
    )


# ---------------------------------------------------------------------------
# Table statistics


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column; NaN is missing."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    rows = [
        (c, x["n"], x["mean"], x["std"], x["min"], *[x[p] for p in QUARTILES], x["max"])
        for c, x in column_summary(df, columns, QUARTILES).items()
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column_name string, count bigint, mean double, std double, min double, q25 double, "
        "q50 double, q75 double, max double",
    )


def completeness(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and percent complete to one digit."""
    cells = F.count(F.lit(1)) * len(df.columns)
    per_column = [F.count_if(is_missing(df, c)) for c in df.columns]
    absent = sum(per_column[1:], per_column[0])
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        absent.alias("missing_values"),
        F.round(100 - F.try_divide(absent * 100, cells), 1).alias("completeness_pct"),
    )


def column_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def mart_summary(frequency: DataFrame, severity: DataFrame, trends: DataFrame) -> DataFrame:
    """Rows over the three marts, categories, date range, mean count, mode.

    The most frequent category is by number of mart rows, the first name on a
    tie. Only frequency rows carry a category; the other two marts meet in the
    null group, which adds to the row total alone.
    """
    facts = ("weather_category", "accident_count", "analysis_date")
    rows = frequency.select(*facts)
    for other in (severity, trends):
        rows = rows.unionByName(
            other.select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in facts])
        )
    per_category = rows.groupBy("weather_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("accident_count").alias("accidents"),
        F.min("analysis_date").alias("first_date"),
        F.max("analysis_date").alias("last_date"),
    )
    named = F.col("weather_category").isNotNull()
    rank = F.when(named, F.struct(-F.col("n"), F.col("weather_category")))
    return per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.sort_array(F.collect_list("weather_category")).alias("weather_categories"),
        F.min("first_date").alias("date_from"),
        F.max("last_date").alias("date_to"),
        F.coalesce(
            F.try_divide(F.sum("accidents"), F.sum(F.when(named, F.col("n")))), F.lit(0.0)
        ).alias("avg_accident_count"),
        F.coalesce(F.min_by("weather_category", rank), F.lit("Unknown")).alias(
            "most_common_weather"
        ),
    )
