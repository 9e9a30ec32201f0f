"""JDBC in and out; the caller names the database by its URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    writers: int = 8,
    **properties: str,
) -> None:
    """Write a frame to a table. ``writers`` bounds the open connections.

    The rows are repartitioned rather than coalesced, so the work that makes
    them keeps its own parallelism.
    """
    (
        df.repartition(writers)
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("truncate", True)
        .options(**properties)
        .mode(mode)
        .save()
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple[str, str] | None = None,
    readers: int = 8,
    **properties: str,
) -> DataFrame:
    """Read a table, in ``readers`` ranges of ``column`` where one is given.

    Without a column the table comes through one connection, which suits only
    small tables.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", 10_000)
        .options(**properties)
    )
    if column is not None and bounds is not None:
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", readers)
        )
    return reader.load()
