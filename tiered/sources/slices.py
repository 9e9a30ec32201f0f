"""Tables of slices: a slice is replaced as a whole by one small pointer file.

Layout::

    <table>/commit=<name>/<column>=<value>/part-*.parquet    rows, never rewritten
    <table>/_pointers/<name>.json                            the slices that a commit sets

A write goes to a folder of its own; nothing sees it until its pointer appears, under its
final name in one rename. Of the commits that set a slice the one with the highest name is
live; names begin with a number above all that the writer saw. So a write that fails leaves
the old rows, a reader gets the old rows or the new ones, an empty write clears its slices,
and two writers of different slices never lose each other's: they write different pointers.
Two writers of one slice leave the rows of one of them. Rows of replaced commits stay
readable for readers that began earlier, until ``clean`` removes them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTERS = "_pointers"


@dataclass(frozen=True)
class Commit:
    """Slices (as partition paths) with whether they hold rows, and the rows' schema."""

    name: str
    slices: dict[str, bool]
    schema: T.StructType


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _listed(spark: SparkSession, path: str) -> list:
    fs, folder = _files(spark, path)
    return list(fs.listStatus(folder)) if fs.exists(folder) else []


def _remove(spark: SparkSession, path: str) -> None:
    fs, folder = _files(spark, path)
    fs.delete(folder, True)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _files(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, name: str, text: str) -> None:
    """Puts a whole file in place by renaming it to a name that nothing else has."""
    fs, hidden = _files(spark, f"{path}/{_POINTERS}/.{name}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _, final = _files(spark, f"{path}/{_POINTERS}/{name}.json")
    if not fs.rename(hidden, final):
        raise OSError(f"cannot publish {final.toString()}")


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All published commits, oldest first."""
    found = []
    for status in _listed(spark, f"{path}/{_POINTERS}"):
        file = status.getPath().getName()
        if file.endswith(".json") and not file.startswith("."):
            held = json.loads(_read_text(spark, status.getPath().toString()))
            schema = T.StructType.fromJson(held["schema"])
            found.append(Commit(file.removesuffix(".json"), held["slices"], schema))
    return sorted(found, key=lambda c: c.name)


def live(found: Sequence[Commit]) -> dict[str, Commit]:
    """The commit behind each slice."""
    return {s: c for c in found for s in c.slices}


def is_table(spark: SparkSession, path: str) -> bool:
    fs, folder = _files(spark, f"{path}/{_POINTERS}")
    return fs.exists(folder)


def _name(spark: SparkSession, values: Mapping[str, object], columns: Sequence[str]) -> str:
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    if set(values) != set(columns):
        raise ValueError(f"a slice needs a value of each of {list(columns)}: {dict(values)}")
    return "/".join(utils.getPartitionPathString(c, str(values[c])) for c in columns)


def _written(spark: SparkSession, folder: str, columns: Sequence[str], above: str = "") -> list[str]:
    if not columns:
        return [above]
    names = [s.getPath().getName() for s in _listed(spark, f"{folder}/{above}") if s.isDirectory()]
    inner = [f"{above}/{n}" if above else n for n in names if n.startswith(f"{columns[0]}=")]
    return [x for n in inner for x in _written(spark, folder, columns[1:], n)]


def _inside(df: DataFrame, wanted: Sequence[Mapping[str, object]]) -> DataFrame:
    """The rows, with an error for one that is in none of the slices."""
    here = F.lit(False)
    for values in wanted:
        one = F.lit(True)
        for c, value in values.items():
            one = one & F.col(c).eqNullSafe(F.lit(value).cast(df.schema[c].dataType))
        here = here | one
    column = df.columns[0]
    # In the value of a stored column, so that no plan can leave the check out.
    stopped = F.raise_error(F.lit(f"row outside {[dict(w) for w in wanted]}"))
    checked = F.when(here, F.col(column)).otherwise(stopped.cast(df.schema[column].dataType))
    return df.withColumn(column, checked)


def replace(
    df: DataFrame, path: str, columns: Sequence[str],
    only: Sequence[Mapping[str, object]] | None = None,
) -> str:
    """Replaces slices by the frame's rows in one commit; returns its name.

    Without ``only`` the slices are those the frame has rows of. With it they are exactly
    those named: one without rows becomes empty, a row of another slice is an error and
    nothing changes.
    """
    spark = df.sparkSession
    number = max((int(c.name.split("-")[0]) for c in commits(spark, path)), default=0) + 1
    name = f"{number:09d}-{uuid.uuid4().hex[:12]}"
    folder = f"{path}/commit={name}"
    named = {_name(spark, values, columns): False for values in only or ()}
    rows = df if only is None else _inside(df, only)
    try:
        rows.write.partitionBy(*columns).parquet(folder)
    except Exception:
        _remove(spark, folder)
        raise
    held = named | dict.fromkeys(_written(spark, folder, columns), True)
    _publish(spark, path, name, json.dumps({"slices": held, "schema": df.schema.jsonValue()}))
    return name


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of all live slices that hold rows."""
    chosen = live(commits(spark, path))
    return [f"{path}/commit={c.name}/{s}" for s, c in sorted(chosen.items()) if c.slices[s]]


def read(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    only: Mapping[str, object] | None = None,
) -> DataFrame:
    """The live rows, of all slices or of one.

    The schema is that of the newest commit unless one is given. Slices are partitions, so
    a filter on their columns leaves their files unread.
    """
    found = commits(spark, path)
    if not found:
        raise FileNotFoundError(f"{path} has no slices")
    schema = schema or found[-1].schema
    chosen = live(found)
    if only is not None:
        name = _name(spark, only, list(only))
        chosen = {s: c for s, c in chosen.items() if s == name}
    paths = [f"{path}/commit={c.name}/{s}" for s, c in sorted(chosen.items()) if c.slices[s]]
    if not paths:
        return spark.createDataFrame([], schema)
    fields = T.StructType([*schema, T.StructField("commit", T.StringType())])
    rows = spark.read.option("basePath", path).schema(fields).parquet(*paths)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema])


def clean(spark: SparkSession, path: str, older_than_hours: float = 24) -> int:
    """Removes the files of replaced slices and of failed writes; returns the folders removed.

    Only commits older than the given time go, so readers that began before a replacement
    and writers at work keep their files. Pointers of which no slice is live go last.
    """
    before = (time.time() - older_than_hours * 3600) * 1000
    found = {c.name: c for c in commits(spark, path)}
    chosen = live(list(found.values()))
    removed = 0
    for status in _listed(spark, path):
        name = status.getPath().getName().removeprefix("commit=")
        if not status.getPath().getName().startswith("commit=") or status.getModificationTime() > before:
            continue
        folder = status.getPath().toString()
        held = found[name].slices if name in found else {}
        kept = {s for s in held if held[s] and chosen[s].name == name}
        dead = [folder] if not kept else [f"{folder}/{s}" for s in held if held[s] and s not in kept]
        for one in dead:
            fs, gone = _files(spark, one)
            removed += bool(fs.delete(gone, True))
        # A pointer that sets a live slice, be it an empty one, still counts.
        if name in found and not any(chosen[s].name == name for s in held):
            _remove(spark, f"{path}/{_POINTERS}/{name}.json")
    return removed
