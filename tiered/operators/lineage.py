"""Cutting long lineage on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            shared = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


_OWNED: list[list[str]] = []


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[None]:
    """Drops, at the end, the tables that ``cut_lineage`` wrote inside.

    For jobs whose results are stored elsewhere by then. Outside of it tables
    stay until the shared folder is cleared.
    """
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame that several jobs read as a table in the shared folder.

    A lost executor costs a re-read. Unlike a checkpointed RDD the plan runs
    once, and readers take only the columns they use.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
