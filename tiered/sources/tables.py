"""Stored tables: conform to a schema, replace a slice, append, version, route."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiered import specs
from tiered.operators.cleaning import cast_strict
from tiered.sources import slices


def conform(df: DataFrame, spec: specs.TableSpec, **constants) -> DataFrame:
    """Select and cast to the table's schema.

    ``constants`` fill columns the frame lacks; ``created_at`` is the write
    time; other missing nullable columns are null. A missing required column is
    an error.
    """
    for name, value in constants.items():
        df = df.withColumn(name, F.lit(value))
    for f in spec.schema:
        if f.name in df.columns:
            continue
        if f.name == "created_at":
            df = df.withColumn(f.name, F.current_timestamp())
        elif f.nullable:
            df = df.withColumn(f.name, F.lit(None))
        else:
            raise ValueError(f"{spec.name} needs column {f.name}")
    return cast_strict(df, spec.schema)


def replace_slices(
    df: DataFrame, path: str, *partition_by: str,
    only: Sequence[Mapping[str, object]] | None = None,
) -> None:
    """Replace the slices present in the frame, or exactly those named, in one commit.

    The old slices stay readable until the new ones are committed, and stay for
    good where the write fails. See ``slices``.
    """
    slices.replace(df, path, partition_by, only)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def replace_slice(df: DataFrame, path: str, values: Mapping[str, object]) -> None:
    """Replace one slice, named by its column values, with the frame's rows.

    An empty frame leaves an empty slice: a date whose rows are all rejected
    does not keep those of an earlier run. Rows of another slice are an error,
    and leave the old rows as they are.
    """
    slices.replace(df, path, list(values), [values])


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """All live rows of a table that is written by slices."""
    return slices.read(spark, path)


def write_mart(df: DataFrame, name: str, base: str, analysis_date: str) -> str:
    """Route a mart by short name and replace its slice of the date."""
    spec = _route(specs.MART_ROUTES, name)
    path = f"{base}/{spec.name}"
    # A mart has a few thousand rows at most: one file per slice. Not coalesce,
    # which would pull the aggregate before it into the one task as well.
    rows = conform(df, spec, analysis_date=analysis_date).repartition(1)
    replace_slice(rows, path, {spec.partition_by: analysis_date})
    return path


def write_model_output(
    df: DataFrame, name: str, base: str, only: Sequence[Mapping[str, object]] | None = None
) -> str:
    """Route models, features and predictions by short name and replace their slices.

    Predictions are a slice for each batch and model: models of one batch stay
    side by side, and the same pair written again replaces itself. With ``only``
    the write is exactly those slices, so a pair without rows is cleared. Each
    registered model is a slice, so two that register at once are both kept.
    """
    spec = _route(specs.MODEL_ROUTES, name)
    path = f"{base}/{spec.name}"
    replace_slices(conform(df, spec), path, *spec.partition_by.split(","), only=only)
    return path


def _route(routes: dict[str, specs.TableSpec], name: str) -> specs.TableSpec:
    if name not in routes:
        raise ValueError(f"unknown output {name!r}; expected one of {sorted(routes)}")
    return routes[name]


def read_table(spark: SparkSession, base: str, spec: specs.TableSpec) -> DataFrame:
    return slices.read(spark, f"{base}/{spec.name}", spec.schema)


# ---------------------------------------------------------------------------
# Versioned tables: a change writes a whole new version next to the old one, so
# the files being read are never the files being written.


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    done = [
        s.getPath().getName()
        for s in fs.listStatus(folder)
        if s.isDirectory()
        and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return sorted(int(n.split("=", 1)[1]) for n in done if n.startswith("version="))


def write_version(df: DataFrame, path: str) -> int:
    """Write the frame as the next version; readers see it once it is complete.

    Its number is claimed first, so two writers never share a folder.
    """
    versions = _versions(df.sparkSession, path)
    n = versions[-1] + 1 if versions else 1
    while not _claim(df.sparkSession, f"{path}/_claims/{n}"):
        n += 1
    df.write.mode("overwrite").parquet(f"{path}/version={n}")
    return n


def _claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False where there is one already."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    fs = file.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(file.getParent())
    try:
        if fs.getUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates then, in two steps.
            local = jvm.java.nio.file.Paths.get(fs.makeQualified(file).toUri())
            jvm.java.nio.file.Files.createFile(local, spark.sparkContext._gateway.new_array(
                jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(file, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.toString()):
            return False
        raise
    return True


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType
) -> DataFrame | None:
    """The newest complete version, or None where there is no table yet."""
    versions = _versions(spark, path)
    if not versions:
        return None
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}")
