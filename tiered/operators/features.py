"""Feature columns, fitted encoders and the persisted feature model."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiered import specs
from tiered.functions.exprs import is_missing, ratio_half_up
from tiered.operators.lineage import cut_lineage
from tiered.operators.numbers import Moments, medians_of, moments, scaled_vectors
from tiered.operators.quantiles import column_summary

CLUSTERS = 20
TOP_CITIES = 50
SEED = 42

# Columns that never become features, encoded columns and their
# labels of a missing value. Never features: identity, text, target and what is
# derived from the target.
EXCLUDED = (
    "ID", "Source", "Start_Time", "End_Time", "State", "City", "County",
    "Severity", "Severity_Category", "Time_Period", "Road_Complexity_Category",
    "ingestion_date", "Year",
)
LEAKY = "severity_category_encoded"

# Text column -> (encoded name, label of a missing value).
ENCODED = {
    "State": ("state_encoded", "Unknown"),
    "Time_Period": ("time_period_encoded", "Unknown"),
    "Road_Complexity_Category": ("road_complexity_encoded", "Simple"),
    "Source": ("source_encoded", "Unknown"),
}
LEAKY_ENCODED = {"Severity_Category": (LEAKY, "Unknown")}


# ---------------------------------------------------------------------------
# Expressions


def geo_columns() -> dict[str, Column]:
    lat, lng = F.col("Latitude"), F.col("Longitude")
    return {
        "lat_rounded": F.round(lat, 2),
        "lng_rounded": F.round(lng, 2),
        "lat_lng_interaction": lat * lng,
    }


def season(month: Column) -> Column:
    """0 winter (Dec-Feb), 1 spring, 2 summer, 3 autumn."""
    return F.floor(F.pmod(month, F.lit(12)) / 3).cast("int")


def _wave(c: Column, period: int) -> tuple[Column, Column]:
    angle = c * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def temporal_columns() -> dict[str, Column]:
    """Clock and calendar features of a subject row.

    Day of week is 1 = Sunday, as in the subject table. Night here is 22-6;
    ``Time_Period`` calls 22-5 night. Both meanings are kept.
    """
    start = F.col("Start_Time")
    hour, dow, month = F.hour(start), F.dayofweek(start), F.month(start)
    hour_sin, hour_cos = _wave(hour, 24)
    month_sin, month_cos = _wave(month, 12)
    day_sin, day_cos = _wave(dow, 7)
    rush = hour.between(7, 9) | hour.between(17, 19)
    return {
        "hour": hour,
        "day_of_week": dow,
        "month": month,
        "year": F.year(start),
        "day_of_year": F.dayofyear(start),
        "is_weekend": dow.isin(1, 7).cast("int"),
        "is_rush_hour": rush.cast("int"),
        "is_night": ((hour >= 22) | (hour <= 6)).cast("int"),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
        "day_sin": day_sin,
        "day_cos": day_cos,
        "season": season(month),
        "duration_hours": F.greatest(
            F.lit(0.0), F.least(F.lit(24.0), F.col("Duration_Hours"))
        ),
    }


def env_columns(df: DataFrame) -> dict[str, Column]:
    """A 0/1 column per road flag, their number (all twelve), complexity."""
    flags = [f for f in specs.FLAGS if f in df.columns]
    cols = {f"{f.lower()}_flag": F.col(f).cast("int") for f in flags}
    if flags:
        cols["road_features_count"] = sum(
            (F.col(f).cast("int") for f in flags[1:]), F.col(flags[0]).cast("int")
        )
    if "Road_Complexity_Score" in df.columns:
        cols["road_complexity_score"] = F.col("Road_Complexity_Score")
    return cols


def with_columns_new(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Add columns whose names may differ from existing ones by case only."""
    taken = {c.lower() for c in cols}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in cols.items()])


# ---------------------------------------------------------------------------
# Fitted lookups


def label_codes(df: DataFrame, encoded: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(column_name, value, code): codes 0..n-1 of each column's sorted values.

    ``encoded`` is as ENCODED. One pass for all columns; the ranking window
    sees one row per distinct value, split by column. Label columns are small
    dictionaries (states, periods, sources).
    """
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.coalesce(c, F.lit(missing)).alias("value")
        )
        for c, (_, missing) in encoded.items()
    ]
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    return (
        df.select(F.inline(F.array(*cells)))
        .distinct()
        .withColumn("code", (rank - 1).cast("int"))
    )


def label_encode(df: DataFrame, encoded: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add the code of each value; a missing value has a label of its own.

    The codes are written first. Their size is then known to the planner,
    which broadcasts them where they are small and shuffles where they are not.
    ``df`` is read twice: give a stored table where it is dear to compute.
    """
    codes = cut_lineage(label_codes(df, encoded))
    out = df.fillna({c: missing for c, (_, missing) in encoded.items()})
    for column, (name, _) in encoded.items():
        own = codes.filter(F.col("column_name") == column).select(
            F.col("value").alias(column), F.col("code").alias(name)
        )
        out = out.join(own, column)
    return out


def city_lookup(df: DataFrame, top: int = TOP_CITIES) -> DataFrame:
    """Per city: number of rows and whether it is among the ``top`` largest.

    Written out, so that the size of the lookup is known where it is joined.

    The count combines before the shuffle, so a city with a large share of all
    rows is one partial row per task. The top list is a bounded head.
    """
    counts = df.groupBy("City").agg(F.count(F.lit(1)).alias("city_frequency"))
    head = (
        counts.filter(F.col("City").isNotNull())
        .orderBy(F.desc("city_frequency"), "City")
        .limit(top)
        .select("City", F.lit(1).alias("is_major_city"))
    )
    # The head holds at most ``top`` rows.
    lookup = counts.join(F.broadcast(head), "City", "left").fillna({"is_major_city": 0})
    return cut_lineage(lookup)


def with_city_features(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Attach the fitted city features; an unseen or missing city has 0.

    No hint: the stored lookup is broadcast where its size allows it, and
    otherwise the skewed side of the join is split at run time.
    """
    return df.join(cities, "City", "left").fillna(
        {"city_frequency": 0, "is_major_city": 0}
    )


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column; one value per column comes back."""
    return {c: stats[0.5] for c, stats in column_summary(df, columns, [0.5]).items()}


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values replaced by the column's exact median."""
    return df.fillna(medians(df, columns))


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as (x - mean) / population deviation; a constant becomes 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    ).first()
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(stats[f"{c}__mean"])) / F.lit(stats[f"{c}__std"] or 1.0)
            for c in columns
        }
    )


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, mean, deviation and percent missing per feature; one scan."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        x = F.when(~is_missing(df, c), F.col(c).cast("double"))
        aggs += [
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
            F.avg(x).alias(f"mean{i}"), F.stddev_pop(x).alias(f"std{i}"),
            F.count_if(is_missing(df, c)).alias(f"gone{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("feature_name"),
            F.col(f"min{i}").alias("min_value"),
            F.col(f"max{i}").alias("max_value"),
            F.col(f"mean{i}").alias("mean_value"),
            F.col(f"std{i}").alias("std_value"),
            F.when(
                F.col("__rows") > 0,
                ratio_half_up(F.col(f"gone{i}") * 100, F.greatest("__rows", F.lit(1)), 2),
            ).otherwise(F.lit(0)).cast("decimal(5,2)").alias("null_percentage"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def feature_catalog(df: DataFrame, name: str = "feature_name") -> DataFrame:
    """Type, category and description of a feature by the first keyword hit.

    'duration' contains no earlier keyword but 'hour' does occur in
    'duration_hours', which is therefore temporal.
    """
    low = F.lower(F.col(name))
    kind = category = None
    for words, kind_label, category_label in specs.FEATURE_TYPES:
        hit = low.rlike("(" + "|".join(words) + ")")
        kind = F.when(hit, kind_label) if kind is None else kind.when(hit, kind_label)
        category = (
            F.when(hit, category_label)
            if category is None
            else category.when(hit, category_label)
        )
    text = None
    for feature, label in specs.FEATURE_DESCRIPTIONS.items():
        hit = F.col(name) == feature
        text = F.when(hit, label) if text is None else text.when(hit, label)
    other = F.lit(specs.FEATURE_TYPE_DEFAULT)
    return df.withColumns(
        {
            "feature_type": kind.otherwise(other),
            "feature_category": category.otherwise(other),
            "description": text.otherwise(F.concat(F.lit("Feature: "), F.col(name))),
        }
    )


# ---------------------------------------------------------------------------
# Feature model


def engineer(df: DataFrame) -> DataFrame:
    """All expression features of accident rows; text labels filled."""
    cols = geo_columns()
    cols.update(temporal_columns())
    cols.update(env_columns(df))
    # Subject columns that differ from a feature by case alone give way to it;
    # the only one with another value is the duration before clipping.
    cols["duration_hours_full"] = F.col("Duration_Hours")
    out = with_columns_new(df, cols)
    labels = {
        c: missing
        for c, (_, missing) in {**ENCODED, **LEAKY_ENCODED}.items()
        if c in out.columns
    }
    return out.fillna(labels)


def numeric_feature_columns(df: DataFrame, excluded: Sequence[str] = EXCLUDED) -> list[str]:
    """Numeric and boolean columns outside the exclude list."""
    drop = set(excluded)
    return [
        f.name
        for f in df.schema
        if f.name not in drop
        and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


@dataclass
class FeatureModel:
    """What scoring needs: fitted stages, the city lookup, the scaling of each column.

    ``scaling`` holds, in the order of the vector, a column's median, mean and
    deviation. ``stats`` describes every feature over the training rows, as
    ``feature_stats``; a loaded model has none.
    """

    stages: PipelineModel
    cities: DataFrame
    scaling: dict[str, tuple[float, float, float]]
    stats: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return list(self.scaling)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns plus the scaled ``features`` vector.

        A column seen at fit time and absent here counts as 0.
        """
        ready = with_city_features(engineer(df), self.cities)
        inputs = stage_inputs(ready, self._numeric(), list(self._coded()), keep)
        return self.vectorize(self.stages.transform(inputs), keep)

    def vectorize(self, inputs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Missing values get the median; then mean 0 and deviation 1."""
        rows = scaled_vectors(inputs, keep, NUMBERS, self.columns, *zip(*self.scaling.values()))
        return rows.withColumn("features", array_to_vector("features"))

    def _coded(self) -> dict[str, str]:
        indexer = self.stages.stages[0]
        return dict(zip(indexer.getInputCols(), indexer.getOutputCols()))

    def _numeric(self) -> list[str]:
        made = {*self._coded().values(), "coord_cluster"}
        return [c for c in self.columns if c not in made]

    def save(self, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        self.cities.write.mode("overwrite").parquet(f"{path}/cities")
        rows = [(i, c, *v) for i, (c, v) in enumerate(self.scaling.items())]
        # One row per feature: the width of the model, not of the data.
        self.cities.sparkSession.createDataFrame(
            rows, "place int, name string, middle double, mean double, deviation double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaling")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        rows = spark.read.parquet(f"{path}/scaling").orderBy("place").collect()
        scaling = {r["name"]: (r.middle, r["mean"], r.deviation) for r in rows}
        stages = PipelineModel.load(f"{path}/stages")
        return cls(stages, spark.read.parquet(f"{path}/cities"), scaling)


NUMBERS = "__numbers"
COORDINATES = ("Latitude", "Longitude")


def stage_inputs(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The columns the stages read: kept ones, labels, coordinates; numbers as doubles.

    The numbers are one struct, so that a join or a stage hands on one column: code
    that hands on dozens is too long for the JVM to compile.
    """
    have = set(df.columns)

    def number(c: str) -> Column:
        return (F.col(c).cast("double") if c in have else F.lit(0.0)).alias(c)

    flat = list(dict.fromkeys([*keep, *text]))
    return df.select(
        *[F.col(c) for c in flat],
        *[number(c) for c in COORDINATES if c not in flat],
        F.struct(*[number(c) for c in numeric]).alias(NUMBERS),
    )


def cluster_stages() -> list:
    """Twenty coordinate clusters; the assignment becomes a feature."""
    return [
        VectorAssembler(
            inputCols=list(COORDINATES), outputCol="__coords", handleInvalid="keep"
        ),
        KMeans(
            k=CLUSTERS, seed=SEED, featuresCol="__coords", predictionCol="coord_cluster"
        ),
    ]


def fit_clusters(df: DataFrame) -> PipelineModel:
    return Pipeline(stages=cluster_stages()).fit(df)


def label_stages(encoded: Mapping) -> list:
    return [
        StringIndexer(
            inputCols=list(encoded), outputCols=[name for name, _ in encoded.values()],
            stringOrderType="alphabetAsc", handleInvalid="keep",
        )
    ]


def fit_scaling(
    train: DataFrame, columns: Sequence[str]
) -> tuple[dict[str, tuple[float, float, float]], DataFrame]:
    """Per column the exact median, and mean and population deviation of filled values.

    All are fitted on ``train``. A column without a value counts as 0; a constant
    column is only centred. The second result is as ``feature_stats``.
    """
    seen = moments(train, columns)
    middle = {c: 0.0 for c in columns} | medians_of(train, columns, seen)
    scaling = {}
    for c, m in zip(columns, seen):
        mean, deviation = m.filled(middle[c])
        scaling[c] = (middle[c], mean, deviation or 1.0)
    return scaling, _described(train.sparkSession, columns, seen)


def _described(spark: SparkSession, columns: Sequence[str], seen: Sequence[Moments]) -> DataFrame:
    # One row per feature: the width of the model, not of the data.
    rows = spark.createDataFrame(
        [
            (c, *((m.low, m.high, m.mean, math.sqrt(m.squares / m.n)) if m.n else [None] * 4),
             m.missing, m.n + m.missing)
            for c, m in zip(columns, seen)
        ],
        "feature_name string, min_value double, max_value double, mean_value double,"
        " std_value double, gone bigint, rows bigint",
    )
    share = F.when(
        F.col("rows") > 0, ratio_half_up(F.col("gone") * 100, F.greatest("rows", F.lit(1)), 2)
    ).otherwise(F.lit(0))
    return rows.withColumn("null_percentage", share.cast("decimal(5,2)")).drop("gone", "rows")


def fit_features(
    df: DataFrame, fit_on: Column, keep: Sequence[str], leaky: bool = False
) -> tuple[FeatureModel, DataFrame]:
    """Fit encoders, clusters, medians and scaling on the rows of ``fit_on``.

    Returns the model and the columns of all rows, ready to be scaled. The rows
    they come from are cut from their lineage: every stage, and every round of
    the clustering, reads them. ``leaky`` adds the encoded severity label, which is the target in
    other words; it exists to compare numbers and is off.
    """
    encoded = {**ENCODED, **(LEAKY_ENCODED if leaky else {})}
    encoded = {c: v for c, v in encoded.items() if c in df.columns}
    # The rows are made once; the city counts are read from what is written.
    ready = engineer(df)
    own = numeric_feature_columns(ready, [*EXCLUDED, *keep])
    rows = cut_lineage(stage_inputs(ready, own, list(encoded), [*keep, "City"]))
    train = rows.filter(fit_on)
    cities = city_lookup(train)
    made = Pipeline(stages=[*label_stages(encoded), *cluster_stages()]).fit(train)
    coded = made.transform(with_city_features(rows, cities))
    added = [
        *numeric_feature_columns(cities), *[name for name, _ in encoded.values()], "coord_cluster"
    ]
    numbers = train.select(*[F.col(NUMBERS).getField(c).alias(c) for c in own])
    codes = cut_lineage(coded.filter(fit_on).select(*[F.col(c).cast("double") for c in added]))
    parts = [fit_scaling(numbers, own), fit_scaling(codes, added)]
    scaling = {c: v for some, _ in parts for c, v in some.items()}
    stats = parts[0][1].unionByName(parts[1][1])
    return FeatureModel(made, cities, scaling, stats), coded
