"""Helpers of the corpus operators: inputs, tables in the shared folder, small columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tiered.llm.shingles import mixed

CHUNK_ROWS = "chunk int, cells binary"
#: Bits of a filter of keys: 16 a key up to the most, beyond which more rows pass.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
PROBES = 4
_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, on a cluster always.

    Only a local master, where everything is one machine, gets a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _LOCAL[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/llm-{name}-{uuid.uuid4().hex}"


def free(name: str, taken: list[str]) -> str:
    """`name`, made longer until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` once to the shared folder and reads it back: lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes a staged table that nothing will read again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file.rpartition("/")[0])
        if "/llm-" not in folder.toString():
            raise ValueError(f"{folder} is not a staged table")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fold(key: Column, modulus: int) -> Column:
    """crc32 of a key written as text, modulo a number; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deals rows to spark.sql.shuffle.partitions tasks by hash of the keys."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def merged(parts: DataFrame, kind: str, combine: np.ufunc) -> dict[int, np.ndarray]:
    """Combines equally long arrays by chunk number, streaming; the chunks are bounded."""

    def fold(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in rows:
            for chunk, cells in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(cells, kind)
                whole[chunk] = combine(whole[chunk], part) if chunk in whole else part
        if whole:
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole, pa.int32()), pa.array([w.tobytes() for w in whole.values()])],
                ["chunk", "cells"],
            )

    done = spread(parts, "chunk").mapInArrow(fold, CHUNK_ROWS).collect()
    return {r["chunk"]: np.frombuffer(r["cells"], kind) for r in done}


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places of each key in a filter."""
    whole = mixed(keys.view(np.uint64))
    step = mixed(whole) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [
            ((whole + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64)
            for k in range(PROBES)
        ]


def passes(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which keys a filter may hold; those that it holds are always among them."""
    passed = np.ones(len(keys), bool)
    for place in _places(keys, 64 * len(held)):
        passed &= (held[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
    return passed


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; with each, what Arrow holds on to of those before goes back to the system.

    A worker process stays when its task ends, and serves the next one.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        yield batch
        del batch
        pool.release_unused()


def key_filter(keys: DataFrame) -> Broadcast:
    """A filter of the keys in the only column: bounded, whatever their number."""
    spark = keys.sparkSession
    bits = LEAST_BITS
    wanted = 16 * keys.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2

    def places(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            every = np.unique(np.concatenate(_places(batch.column(0).to_numpy(), bits)))
            ones = np.left_shift(np.uint64(1), (every & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(every >> 6), pa.array(ones)], ["at", "ones"])

    # At most one short row for 64 bits.
    found = (
        keys.mapInArrow(places, "at long, ones long")
        .groupBy("at").agg(F.bit_or("ones").alias("ones")).toArrow()
    )
    held = np.zeros(bits // 64, np.uint64)
    held[found.column("at").to_numpy()] = found.column("ones").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(held)


def may_have(keys: DataFrame) -> Callable[[Column], Column]:
    """Marks the hashes that a bounded filter of the only column holds, and a few others."""
    held = key_filter(keys)

    @F.pandas_udf(BooleanType())
    def may(key: pd.Series) -> pd.Series:
        return pd.Series(passes(key.to_numpy(), held.value))

    return may


def placed(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """`rows` with place (from 0, in the order of `order` within its group) and n (group size).

    Rows are dealt by range of group and order to tasks, so one group may span many of them;
    a row's place is its number in its part plus the sizes of the group's parts before it.
    Groups must not be null; nulls of `order` come first. Equal rows are interchangeable: a
    running number deals them to several tasks. The dealt rows are one table in the shared
    folder. `part`, `place`, `n` and `tie` must not be names of `rows`.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order, "tie"]
    dealt = staged(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(count, *keys)
        .withColumn("part", F.spark_partition_id()),
        name,
    )
    whole = Window.partitionBy(*group)
    before = F.sum("size").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row for each part that a group meets.
    sizes = (
        dealt.groupBy(*group, "part").agg(F.count("*").alias("size"))
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .withColumn("n", F.sum("size").over(whole))
        .drop("size")
    )
    here = Window.partitionBy(*group, "part").orderBy(*order, "tie")
    return (
        dealt.join(sizes, [*group, "part"])
        .withColumn("place", F.row_number().over(here) - 1 + F.col("before"))
        .drop("before", "tie")
    )
