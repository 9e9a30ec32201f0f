"""Jobs: land a snapshot, build silver tables, build marts, run the models.

Layout: ``<bronze>/ingestion_date=D``, ``<silver>/<table>/ingestion_date=D``,
``<marts>/<mart>/analysis_date=D``, ``<models>/...``. Every job may be run again
for the same date and leaves the same tables; a date without rows is left empty.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiered import specs
from tiered.operators import (
    cleaning,
    features,
    listing,
    marts,
    models,
    sampling,
    subjects,
)
from tiered.operators.lineage import owned_tables
from tiered.sources import files, tables

STAGED = "staged"


# ---------------------------------------------------------------------------
# Bronze, silver, marts


def land_snapshot(
    spark: SparkSession, source: str, bronze: str, date: str, **csv_options
) -> None:
    """CSV to the cumulative snapshot of a date."""
    raw = files.read_csv(spark, source, **csv_options)
    wanted = cleaning.project_available(raw)
    files.write_dated(sampling.snapshot(wanted, date), bronze, date=date)


def build_silver(
    spark: SparkSession, bronze: str, silver: str, date: str,
    order: Sequence[str] | None = None,
) -> None:
    """Profile, staged table, three subject tables and the waterfall of a date.

    The unique rows are written once; the three subject tables are narrow
    projections of them without a shuffle.
    """
    raw = files.read_dated(spark, bronze, date)
    stamp = F.lit(date).cast("date").alias(files.DATE)
    profile = cleaning.null_profile(raw).select("*", stamp)
    files.write_dated(profile.coalesce(1), f"{silver}/null_profile", date=date)

    files.write_dated(cleaning.stage(raw, order), f"{silver}/{STAGED}", date=date)
    staged = files.read_slice(spark, f"{silver}/{STAGED}", date)
    clean = cleaning.standardize_staged(staged)
    waterfall = cleaning.staged_waterfall(raw, staged).select("*", stamp)
    outputs = {n: build(clean) for n, build in subjects.SUBJECTS.items()}
    outputs["quality_waterfall"] = waterfall.coalesce(1)
    # They only read the staged table, so their jobs share the cluster; the
    # tail of one write no longer leaves the other cores idle.
    with ThreadPoolExecutor(len(outputs)) as pool:
        writes = [
            pool.submit(
                inheritable_thread_target(spark)(files.write_dated), df, f"{silver}/{n}",
                date=date,
            )
            for n, df in outputs.items()
        ]
        for w in writes:
            w.result()


def mart_input(
    spark: SparkSession, silver: str, date: str, from_subjects: bool = False
) -> DataFrame:
    """One row per incident for the marts.

    By default from the staged table, which needs no join. ``from_subjects``
    joins the two stored subject tables on ID instead, for silver layers that
    hold only those.
    """
    if from_subjects:
        return subjects.join_subjects(
            files.read_dated(spark, f"{silver}/accidents_clean", date),
            files.read_dated(spark, f"{silver}/weather_clean", date),
        )
    staged = files.read_dated(spark, f"{silver}/{STAGED}", date)
    return subjects.observations(cleaning.standardize_staged(staged))


CELLS = "mart_cells"


def build_marts(
    spark: SparkSession, silver: str, base: str, date: str, from_subjects: bool = False
) -> None:
    """The three marts of a date, each replacing its slice.

    The incidents are read once, into a small table of cells; the marts are
    sums over the cells.
    """
    obs = mart_input(spark, silver, date, from_subjects)
    stamp = F.lit(date).cast("date").alias("analysis_date")
    rows = marts.cells(marts.measures(obs)).select("*", stamp).repartition(1)
    tables.replace_slice(rows, f"{base}/{CELLS}", {"analysis_date": date})
    cells = files.read_slice(spark, f"{base}/{CELLS}", date, "analysis_date")
    for name, mart in MARTS.items():
        tables.write_mart(mart(cells), name, base, date)


MARTS = {
    "frequency": marts.frequency_mart,
    "severity": marts.severity_mart,
    "weather": marts.trend_mart,
}


def layer_inventory(
    spark: SparkSession, bronze: str, silver: str,
    dates: tuple[str, ...] = specs.SNAPSHOT_DATES,
) -> DataFrame:
    """Files and bytes per layer and date, missing dates marked."""
    layers = {"bronze": bronze, **{n: f"{silver}/{n}" for n in subjects.SUBJECTS}}
    return files.layer_report(spark, layers, dates)


# ---------------------------------------------------------------------------
# Models


def load_accidents(spark: SparkSession, silver: str, date: str) -> DataFrame:
    """Accident rows of a date with a usable severity."""
    rows = files.read_dated(spark, f"{silver}/accidents_clean", date)
    return cleaning.filter_domain(rows.dropna(subset=["Severity"]))


def model_id(name: str, version: str) -> str:
    return f"{name}:{version}"


METRICS = "ml_metrics"


def convergence(trained: models.Trained) -> tuple[int | None, float | None]:
    """Rounds and final objective of a learner that works by rounds."""
    if not getattr(trained.model, "hasSummary", False):
        return None, None
    summary = trained.model.summary
    history = list(summary.objectiveHistory)
    return summary.totalIterations, float(history[-1]) if history else None


def save_metrics(
    spark: SparkSession, base: str, ident: str, trained: models.Trained, cv: DataFrame | None
) -> None:
    """One row a split, and the cross-validated error and convergence, per model."""
    rounds, objective = convergence(trained)
    folds = cv.first() if cv is not None else None
    rows = [
        (
            ident, split, m["samples"], m["mae"], m["mse"], m["rmse"], m["r2"],
            folds and folds.cv_mae_mean, folds and folds.cv_mae_std, rounds, objective,
        )
        for split, m in sorted(trained.metrics.items())
    ]
    fields = (
        "model_id string, split string, samples bigint, mae double, mse double, rmse double, "
        "r2 double, cv_mae_mean double, cv_mae_std double, iterations int, objective double"
    )
    table = spark.createDataFrame(rows, fields).repartition(1)
    tables.replace_slices(table, f"{base}/{METRICS}", "model_id", only=[{"model_id": ident}])


def register(
    spark: SparkSession, base: str, trained: models.Trained, name: str, version: str,
    importance: DataFrame,
) -> str:
    """Save the model and upsert its registry row; (name, version) is unique."""
    ident = model_id(name, version)
    path = f"{base}/artifacts/{name}/{version}"
    models.save_trained(trained, path)
    # One row per feature comes to the driver: the width of the model.
    weights = {r.feature_name: r.importance_score for r in importance.collect()}
    val = trained.metrics.get("validation", {})
    row = [
        (
            ident, name, version, "regression", trained.algorithm,
            len(trained.features.columns), trained.train_rows,
            val.get("samples", 0), val.get("mae"), val.get("mse"), val.get("rmse"),
            val.get("r2"), path, weights,
            {k: json.dumps(v) for k, v in trained.params.items()}, True,
        )
    ]
    fields = (
        "model_id string, model_name string, model_version string, "
        "model_type string, algorithm string, feature_count int, "
        "training_samples bigint, validation_samples bigint, mae_score double, "
        "mse_score double, rmse_score double, r2_score double, model_path string, "
        "feature_importance map<string,double>, hyperparameters map<string,string>, "
        "is_active boolean"
    )
    new = spark.createDataFrame(row, fields).withColumn(
        "training_date", F.current_timestamp()
    )
    tables.write_model_output(new.repartition(1), "models", base, [{"model_id": ident}])
    return ident


def registry(spark: SparkSession, base: str) -> DataFrame:
    return tables.read_table(spark, base, specs.MODELS)


def _metrics(trained: models.Trained, scored: DataFrame) -> dict:
    """Metrics per split, three rows at most."""
    rows = models.regression_metrics(scored).collect()
    return {r.split: r.asDict() for r in rows}


def _save_features(
    spark: SparkSession, base: str, ident: str, prepared: models.Prepared,
    importance: DataFrame,
) -> None:
    """Importance, kind and training statistics of every feature of a model."""
    rows = (
        features.feature_catalog(importance)
        .join(prepared.features.stats, "feature_name", "left")
        .withColumn("model_id", F.lit(ident))
    )
    tables.write_model_output(rows.repartition(1), "features", base, [{"model_id": ident}])


def fit_and_register(
    spark: SparkSession, base: str, prepared: models.Prepared,
    name: str, version: str, algorithm: str, tuned: bool = False, cross_validate: bool = True,
) -> tuple[str, models.Trained]:
    """Train (or tune), measure on every split and by folds, save, register."""
    if tuned:
        trained, _ = models.tune(prepared, algorithm)
    else:
        trained = models.train(prepared, algorithm)
    trained.metrics = _metrics(trained, trained.score(prepared.table))
    trained.val_mse = trained.metrics.get("validation", {}).get("mse", 1.0)
    importance = models.importance_table(trained)
    ident = register(spark, base, trained, name, version, importance)
    _save_features(spark, base, ident, prepared, importance)
    params = {k: v for k, v in trained.params.items() if v != models.PARAMS[algorithm].get(k)}
    cv = models.cv_mae(prepared, algorithm, **params) if cross_validate else None
    save_metrics(spark, base, ident, trained, cv)
    return ident, trained


MODEL_NAMES = {
    "random_forest": "accident_severity_rf",
    "gradient_boosting": "accident_severity_gb",
    "ridge": "accident_severity_ridge",
}


def run_severity_models(
    spark: SparkSession, silver: str, base: str, date: str, batch: str,
    version: str = "1.0", algorithms: Sequence[str] = tuple(MODEL_NAMES),
    sample: int | None = None, score_rows: int | None = None, cross_validate: bool = True,
) -> dict[str, float]:
    """Train the regressors of a date, pick the best, score the test split.

    All algorithms train on one feature table, of ``sample`` rows if that is
    given. All test rows are scored unless ``score_rows`` asks for a sample of
    them. Returns the validation MAE per model; the best comes first. Metrics of
    all splits and of the folds are in the table METRICS. Intermediate tables
    are dropped at the end.
    """
    with owned_tables(spark):
        return _run_severity_models(
            spark, silver, base, date, batch, version, algorithms, sample, score_rows,
            cross_validate,
        )


def _run_severity_models(
    spark: SparkSession, silver: str, base: str, date: str, batch: str, version: str,
    algorithms: Sequence[str], sample: int | None, score_rows: int | None, cross_validate: bool,
) -> dict[str, float]:
    rows = load_accidents(spark, silver, date)
    if sample is not None:
        rows = sampling.sample_n(rows, sample)
    source = sampling.train_val_test(rows)
    prepared = models.prepare(source)
    fitted = {}
    for algorithm in algorithms:
        name = MODEL_NAMES.get(algorithm, f"accident_severity_{algorithm}")
        ident, trained = fit_and_register(
            spark, base, prepared, name, version, algorithm, cross_validate=cross_validate
        )
        fitted[ident] = trained
    mae = {i: t.metrics.get("validation", {}).get("mae", float("inf"))
           for i, t in fitted.items()}
    ranked = sorted(mae, key=lambda i: (mae[i], i))
    best = ranked[0]
    test = source.filter(F.col("split") == "test").drop("split")
    if score_rows is not None:
        test = sampling.sample_n(test, score_rows)
    scored = models.prediction_rows(
        fitted[best], test, best, batch, F.current_timestamp()
    )
    pair = {"prediction_batch": batch, "model_id": best}
    tables.write_model_output(scored, "predictions", base, [pair])
    return {i: mae[i] for i in ranked}


def run_demo(
    spark: SparkSession, silver: str, base: str, date: str, batch: str
) -> dict[str, float]:
    """The forest alone on a sample of at most 500 rows; its test rows scored."""
    return run_severity_models(
        spark, silver, base, date, batch, algorithms=("random_forest",), sample=500
    )


def train_model(
    spark: SparkSession, source: DataFrame, base: str, name: str, version: str,
    algorithm: str = "random_forest", tuned: bool = False,
) -> str:
    rows = source if "split" in source.columns else sampling.train_val_test(source)
    with owned_tables(spark):
        prepared = models.prepare(rows)
        ident, _ = fit_and_register(
            spark, base, prepared, name, version, algorithm, tuned
        )
    return ident


def load_model(
    spark: SparkSession, base: str, name: str, version: str | None = None
) -> tuple[str, models.Trained]:
    """The newest active version of a model, or an exact one."""
    found = listing.latest_active_model(
        registry(spark, base).filter(F.col("model_name") == name), version, "model_id"
    ).head()
    if found is None:
        raise LookupError(f"model {name} {version or ''} not found")
    trained = models.load_trained(
        spark, found.model_path, found.algorithm, found.hyperparameters,
        float(found.mse_score if found.mse_score is not None else 1.0),
        found.training_samples,
    )
    return found.model_id, trained


def predict(
    spark: SparkSession, source: DataFrame, base: str, name: str,
    version: str | None = None, output: str | None = None, batch: str | None = None,
) -> DataFrame:
    """Score rows with a stored model; optionally to Parquet and to a batch."""
    ident, trained = load_model(spark, base, name, version)
    scored = models.prediction_rows(
        trained, source, ident, batch or "adhoc", F.current_timestamp()
    )
    if output:
        files.write_parquet(scored, output)
        scored = files.read_parquet(spark, output)
    if batch:
        pair = {"prediction_batch": batch, "model_id": ident}
        tables.write_model_output(scored, "predictions", base, [pair])
    return scored


def evaluate(
    spark: SparkSession, source: DataFrame, base: str, name: str,
    version: str | None = None,
) -> DataFrame:
    """MAE, MSE, RMSE, R2 and rows of a stored model on labelled rows."""
    _, trained = load_model(spark, base, name, version)
    rows = models.numeric_target(source)
    vectors = trained.features.transform(rows, keep=("ID", "label"))
    return models.regression_metrics(trained.score(vectors), by=())


def list_models(spark: SparkSession, base: str) -> DataFrame:
    return (
        registry(spark, base)
        .select(
            "model_name", "model_version", "algorithm", "training_date", "mae_score",
            "r2_score", "is_active",
        )
        .orderBy(F.desc("training_date"), "model_name", "model_version")
    )
