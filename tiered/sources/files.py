"""CSV and Parquet in, dated Parquet tables and CSV out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiered import specs
from tiered.sources import records, slices
from tiered.sources.tables import exists, replace_slice, replace_slices

DATE = "ingestion_date"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = specs.RAW_SCHEMA,
    multi_line: bool | None = None,
    corrupt_column: str | None = None,
    **options,
) -> DataFrame:
    """CSV with a header; declared types, no inference pass over the data.

    The header is read first and known columns get their declared type by
    name, so extra or reordered columns do no harm. Malformed values become
    null. Files are split over tasks, also where quoted values hold line
    breaks: a pass over the quotes tells where records begin (``records``).
    ``multi_line=False`` spares that pass where no value holds a line break;
    ``multi_line=True`` has Spark read each file in one task, which an escape
    other than the doubled quote needs.
    """
    base = {"header": True, "escape": '"', **options}
    whole = {**base, "multiLine": multi_line is not False}
    header = spark.read.options(**whole).csv(path).columns
    known = {f.name: f.dataType for f in schema}
    fields = [T.StructField(c, known.get(c, T.StringType())) for c in header]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType()))
        base["columnNameOfCorruptRecord"] = corrupt_column
    columns = T.StructType(fields)
    if multi_line is None and base["escape"] == base.get("quote", '"'):
        given = {k: v for k, v in base.items() if k != "header"}
        rows = records.read(spark, path, columns, given)
        if rows is not None:
            return rows
    reader = spark.read.options(mode="PERMISSIVE", **base, multiLine=bool(multi_line))
    return reader.schema(columns).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_folder(
    spark: SparkSession, path: str, skip_unreadable: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Every Parquet file below a folder; hidden files are passed over.

    A table that is written by slices is read through its pointers, so that
    replaced rows do not come back.

    With ``skip_unreadable`` give the schema as well: it is otherwise taken
    from one file, which may be a broken one.
    """
    if slices.is_table(spark, path):
        return slices.read(spark, path)
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", skip_unreadable)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_dated(
    df: DataFrame, path: str, column: str = DATE, date: str | None = None
) -> None:
    """Replace the frame's dates in a dated table; other dates stay.

    With ``date`` the frame is that date's and the date is cleared even where
    the frame has no row.
    """
    if date is None:
        replace_slices(df, path, column)
    else:
        replace_slice(df, path, {column: date})


def read_dated(spark: SparkSession, path: str, date: str, column: str = DATE) -> DataFrame:
    """One date of a dated table; a missing date is an error.

    The filter is on the partition column, so only that slice is read.
    """
    df = slices.read(spark, path).withColumn(column, F.col(column).cast("date"))
    part = df.filter(F.col(column) == F.lit(date).cast("date"))
    if part.isEmpty():
        raise FileNotFoundError(f"{path} has no rows for {date}")
    return part


def read_slice(spark: SparkSession, path: str, date: str, column: str = DATE) -> DataFrame:
    """One date of a dated table that a job has just written, which may be empty."""
    rows = slices.read(spark, path, only={column: date})
    return rows.withColumn(column, F.col(column).cast("date"))


def slice_rows(spark: SparkSession, path: str, date: str, column: str = DATE) -> int:
    """Rows stored for a date; answered from the file footers."""
    return slices.read(spark, path, only={column: date}).count()


def export_csv(df: DataFrame, path: str) -> None:
    """Any report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def layer_report(
    spark: SparkSession, layers: dict[str, str], dates: tuple[str, ...] = specs.SNAPSHOT_DATES
) -> DataFrame:
    """Files and bytes per (layer, expected date); missing dates are marked.

    A layer that was never written has all its dates missing.
    Only file listings are read; the binary source leaves contents alone when
    they are not selected.
    """
    expected = spark.createDataFrame(
        [(n, d) for n in layers for d in dates], "layer string, date string"
    )
    found = spark.createDataFrame([], "layer string, date string, length bigint")
    for name, path in layers.items():
        if slices.is_table(spark, path):
            held = slices.folders(spark, path)
        else:
            held = [path] if exists(spark, path) else []
        if not held:
            continue
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(held)
            .select(
                F.lit(name).alias("layer"),
                F.regexp_extract("path", f"{DATE}=([0-9-]+)", 1).alias("date"),
                "length",
            )
        )
        found = found.unionByName(files)
    sizes = found.groupBy("layer", "date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    return (
        expected.join(sizes, ["layer", "date"], "left")
        .withColumn("is_missing", F.col("files").isNull())
        .fillna({"files": 0, "bytes": 0})
        .orderBy("layer", "date")
    )
