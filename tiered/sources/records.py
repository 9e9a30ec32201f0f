"""CSV records whose values hold line breaks, read by many tasks.

A quote opens or closes a value and a doubled quote does both, so a line begins inside a
value exactly if the quotes before it in its file are odd in number. Files are split and
read as lines. One pass counts the quotes of each block of a file; prefix sums over a
file's blocks tell where each begins. Then tasks cut their blocks into records; only the
pieces of records that cross the end of a block, at most two a block, meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Blocks that are sent to all tasks at most; beyond it lines are dealt to their block.
BROADCAST_BLOCKS = 500_000
_CUT = "file string, block long, kind int, first boolean, record string"
_WHOLE, _REST, _BEGUN = 0, 1, 2


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of a block in order, one after another."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value",
    )


def blocks(text: DataFrame, quote: str) -> DataFrame:
    """One row a block: whether it begins and ends inside a value, its odd lines, and whether
    lines of its file end with a carriage return, which is then no part of a value."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    # The line end of a file is that of its first line.
    numbered = text.withColumn("line", F.monotonically_increasing_id())
    counted = numbered.groupBy("file", "block").agg(
        F.sum(quotes).alias("quotes"), F.count_if(quotes % 2 == 1).alias("odd"),
        F.min_by(F.col("value").endswith("\r"), "line").alias("returns"),
    )
    whole = Window.partitionBy("file").orderBy("block")
    upto = F.sum("quotes").over(whole.rowsBetween(Window.unboundedPreceding, 0))
    return counted.select(
        "file", "block", "odd", ((upto - F.col("quotes")) % 2 == 1).alias("inside"),
        (upto % 2 == 1).alias("open"), F.first("returns").over(whole).alias("returns"),
    )


def _cutter(quote: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, inside, kind, first, out = None, [], False, _WHOLE, False, []

        def emit(what: int) -> None:
            out.append((*key, what, first, "\n".join(held)))
            held.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["file", "block", "kind", "first", "record"],
            )

        for batch in batches:
            for file, block, begins, returns, value in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (file, block):
                    if held:
                        emit(_REST if kind == _REST else _BEGUN)
                    key, inside = (file, block), begins
                    kind, first = _REST if begins else _WHOLE, block == 0
                held.append(value.removesuffix("\r") if returns else value)
                inside ^= value.count(quote) % 2 == 1
                if not inside:
                    emit(kind)
                    kind, first = _WHOLE, False
            if out:
                yield batch_of()
        if held:
            emit(_REST if kind == _REST else _BEGUN)
            yield batch_of()

    return cut


def records(spark: SparkSession, path: str, quote: str, table: DataFrame, count: int) -> DataFrame:
    """(record): every record of the files but each file's first, which is its header."""
    marks = table.select("file", "block", "inside", "returns")

    def cut(text: DataFrame, known: DataFrame, few: bool) -> DataFrame:
        if few:
            met = text.join(F.broadcast(known), ["file", "block"])
        else:
            numbered = text.withColumn("line", F.monotonically_increasing_id())
            met = numbered.join(known, ["file", "block"]).repartition("file", "block")
            met = met.sortWithinPartitions("file", "block", "line")
        return met.select("file", "block", "inside", "returns", "value").mapInArrow(_cutter(quote), _CUT)

    few = count <= BROADCAST_BLOCKS
    whole = cut(lines(spark, path), marks, few).where(F.col("kind") == _WHOLE)
    crossed = table.where("inside or open").select(*marks.columns)
    pieces = cut(lines(spark, path), crossed, few).where(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.sum(F.when(F.col("kind") == _BEGUN, 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = (
        pieces.withColumn("number", number)
        .groupBy("file", "number")
        .agg(
            F.max("first").alias("first"),
            F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"),
        )
        .select("first", F.array_join("parts.record", "\n").alias("record"))
    )
    found = whole.select("first", "record").unionByName(joined)
    return found.where("not first and record <> ''").select("record")


def read(
    spark: SparkSession, path: str, schema, options: Mapping[str, object]
) -> DataFrame | None:
    """Rows of CSV files with a header; None if no value holds a line break.

    In that case Spark's own reader splits the files already. A file whose quotes do not
    pair up is an error: a single quote inside an unquoted value has no place in them.
    """
    quote = str(options.get("quote", '"'))
    table = blocks(lines(spark, path), quote)
    last = F.max_by("open", "block")
    files = table.groupBy("file").agg(
        last.alias("open"), F.sum("odd").alias("odd"), F.count("*").alias("blocks")
    )
    odd, unpaired, count = files.agg(
        F.sum("odd"), F.max(F.when(F.col("open"), F.col("file"))), F.sum("blocks")
    ).first()
    if unpaired:
        raise ValueError(f"{unpaired} has a quote without its pair")
    if not odd:
        return None
    given = {k: str(v) for k, v in options.items()} | {"multiLine": "true", "mode": "PERMISSIVE"}
    rows = records(spark, path, quote, table, count)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("record", F.lit(ddl), given)
    return rows.select(parsed.alias("row")).select("row.*")
