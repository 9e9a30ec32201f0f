"""Headline timings; prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times; the median counts and
the fastest and slowest run stand beside it. T1 writes the silver tables from landed records to Parquet, the others are drained
without a sink. The number of Spark jobs of one run stands beside each time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tiered import specs  # noqa: E402
from tiered.operators import models, sampling  # noqa: E402
from tiered.plans import jobs  # noqa: E402
from tiered.sources import files  # noqa: E402
from workload import views  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
DATE = specs.SNAPSHOT_DATES[-1]

DRAINED = (
    "null_profile", "quality_waterfall", "dedup_by_key", "frequency_mart",
    "severity_mart", "trend_mart", "impact_summary", "join_incidents_weather",
    "describe_numeric", "error_box", "confusion_matrix", "apply_changes",
    "top_n_sorted", "geo_features", "label_encode", "mart_summary",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def measure(spark: SparkSession, name: str, run, runs: int, warm: int = 1):
    for _ in range(warm):
        run()
    seconds, count = [], 0
    for i in range(runs):
        group = f"{name}-{i}"
        spark.sparkContext.setJobGroup(group, name)
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
        count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    span = [round(min(seconds), 3), round(max(seconds), 3)]
    return round(statistics.median(seconds), 3), count, span


def main() -> None:
    spark = session()
    base = tempfile.mkdtemp(prefix="bench-")
    bronze, silver, out = (f"{base}/{n}" for n in ("bronze", "silver", "models"))
    raw = views.incidents(spark, SF_DIR).drop("bucket")
    # Landed data has many files; the given table is a single row group.
    files.write_dated(
        raw.withColumn("ingestion_date", F.lit(DATE).cast("date")).repartition(
            int(CPUS)
        ),
        bronze,
    )
    times: dict[str, float] = {}
    counts: dict[str, int] = {}
    spans: dict[str, list[float]] = {}

    def take(name, run, runs=RUNS, warm=1):
        times[name], counts[name], spans[name] = measure(spark, name, run, runs, warm)

    source = f"{base}/raw.csv"
    raw.write.option("header", True).csv(source)
    take("land_snapshot", lambda: jobs.land_snapshot(spark, source, f"{base}/landed", DATE))
    take(
        "T1_build_silver",
        lambda: jobs.build_silver(spark, bronze, silver, DATE, views.TIES),
    )
    take("T2_build_marts", lambda: jobs.build_marts(spark, silver, f"{base}/marts", DATE))
    for name in DRAINED:
        take(name, lambda n=name: drain(QUERIES[n](spark, SF_DIR)))

    ready: list[models.Prepared] = []
    fitted: dict[str, models.Trained] = {}

    def prepare():
        rows = jobs.load_accidents(spark, silver, DATE)
        ready.append(models.prepare(sampling.train_val_test(rows)))

    def regressor(algorithm):
        fitted[algorithm] = models.train(ready[-1], algorithm)
        models.regression_metrics(fitted[algorithm].score(ready[-1].table)).collect()

    take("T5_prepare", prepare, runs=1, warm=0)
    for algorithm in ("random_forest", "gradient_boosting", "ridge"):
        take(f"T5_{algorithm}", lambda a=algorithm: regressor(a), runs=1, warm=0)
    take(
        "score_confidence",
        lambda: drain(models.score_confidence(fitted["random_forest"], ready[-1].table)),
        runs=1, warm=0,
    )
    take("cv_mae_ridge", lambda: drain(models.cv_mae(ready[-1], "ridge")), runs=1, warm=0)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "jobs": counts,
                "fastest_slowest": spans,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
