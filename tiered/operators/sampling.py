"""Keyed splits, cumulative snapshots, seeded samples and distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiered import specs


def key_bucket(key: str = specs.KEY) -> Column:
    """Bucket 0..99 of a key: the same for a key on every run and cluster."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(100)).cast("int")


def hash_split(
    df: DataFrame,
    cuts: Sequence[int] = specs.SNAPSHOT_CUTS,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``part``: 1..n by the cumulative percent cut the key falls under."""
    bucket = key_bucket() if bucket is None else bucket
    part = None
    for i, cut in enumerate(cuts, 1):
        part = F.when(bucket < cut, i) if part is None else part.when(bucket < cut, i)
    return df.withColumn("part", part)


def snapshot(
    df: DataFrame,
    date: str,
    dates: Sequence[str] = specs.SNAPSHOT_DATES,
    cuts: Sequence[int] = specs.SNAPSHOT_CUTS,
    bucket: Column | None = None,
) -> DataFrame:
    """Cumulative snapshot of a date: parts 1..n in one scan, stamped with it."""
    if date not in dates:
        raise ValueError(f"not a snapshot date: {date}; expected one of {list(dates)}")
    bucket = key_bucket() if bucket is None else bucket
    return df.filter(bucket < cuts[list(dates).index(date)]).withColumn(
        "ingestion_date", F.lit(date).cast("date")
    )


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def sample_n(df: DataFrame, n: int, key: str = specs.KEY, ties: Sequence[str] = ()) -> DataFrame:
    """Fixed-size repeatable sample: the n smallest key digests.

    Plans as TakeOrderedAndProject: each task keeps n rows.
    """
    digest = F.md5(F.col(key).cast("string"))
    return df.orderBy(digest, F.col(key), *[F.col(t) for t in ties]).limit(n)


def train_val_test(df: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Add ``split``: 60 % train, 20 % validation, 20 % test by key."""
    bucket = key_bucket() if bucket is None else bucket
    return df.withColumn(
        "split",
        F.when(bucket < 60, "train").when(bucket < 80, "validation").otherwise("test"),
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
