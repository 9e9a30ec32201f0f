"""Corpus pipeline: quality, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and
returns the columns of documents, whatever further columns they have; the last one returns
the packed pieces. A stage's result is written as Parquet and read again for the next. A stage
called alone leaves the session with small batches, as its result is computed later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiered.llm import decontaminate, jaccard, packing, personal, quality, shared, tokens

SEQUENCE = 2048
#: Rows that Spark hands to Python at once: whole texts go through every stage, and what a
#: batch takes outside the heap is not given back between stages.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: As many rows, and no more, are read from a file at once: of whole texts, megabytes.
_READ = "spark.sql.parquet.columnarReaderBatchSize"
#: Words whose token ids a worker process keeps: it goes on to serve other stages.
REMEMBER = 100_000


def _small_batches(spark: SparkSession) -> None:
    """Batches of at most BATCH_ROWS rows from here on, fewer where the session says so.

    Every stage asks for them. Its result is computed after it has returned, so the session
    keeps them; `run` sets back what was.
    """
    for name in (_BATCH, _READ):
        if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))


def _beside(docs: DataFrame) -> DataFrame:
    """Rows in one column beside the text, so no added column meets a name of theirs.

    Their fields are numbered: names may hold blanks or signs that a schema's text cannot. The
    text is not among them: it would go to Python twice.
    """
    fields = [c.alias(f"c{k}") for k, c in enumerate(_all(docs)) if docs.columns[k] != "text"]
    return docs.select(F.struct(*fields).alias("row"), "text")


def _rows(found: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `docs` again, from rows that went beside; those of `changed` instead."""
    fields = {c: F.col(f"row.c{k}") for k, c in enumerate(docs.columns)}
    fields |= {"text": F.col("text"), **changed}
    return found.select(*[fields[c].alias(c) for c in docs.columns])


def _all(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    _small_batches(spark)
    labels = shared.table(spark, sf_dir, "labels")
    learned = labels.where(shared.fold(F.col("doc_id"), 4) != 2)
    model = quality.fit(docs, learned)
    return _rows(quality.score(_beside(docs), model).where("predicted = 1"), docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the smallest id, then the first row.

    Rows are linked and dropped by a number of their own where ids are null or repeated. Known
    ids go before null ones, repeated rows are copies, and different texts of one id are
    different documents. Rows without words stay.
    """
    _small_batches(spark)
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 or doc_id is null").isEmpty():
        linked = jaccard.link_documents(docs)
        dropped = linked.where("doc_id <> component_id").select("doc_id")
        return _without(docs, dropped, "doc_id").select(*_all(docs))
    # Written once, so that a row has the same number in every pass.
    row = shared.free("__row", docs.columns)
    numbered = shared.staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    linked = shared.staged(
        jaccard.link_documents(numbered.select(row, "text"), key=row).select(
            F.col("doc_id").alias(row), "component_id"
        ),
        "linked",
    )
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", row)
    first = (
        linked.join(numbered.select(row, "doc_id"), row)
        .groupBy("component_id").agg(F.min(order).alias("first"))
        .select(F.col(f"first.{row}").alias(row))
    )
    dropped = linked.select(row).join(first, row, "left_anti")
    return _without(numbered, dropped, row).select(*_all(docs))


def _without(docs: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    # Few against all documents, so Spark can send this side where the documents are.
    return docs.join(shared.staged(dropped, "dropped"), key, "left_anti")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    _small_batches(spark)
    items = shared.table(spark, sf_dir, "benchmark")
    return _rows(decontaminate.decontaminate(_beside(docs), items).where("n_hit = 0"), docs)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and what discloses it in the texts; counts their characters."""
    _small_batches(spark)
    found = personal.sanitise(_beside(docs))
    changed = {}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        was = F.col(f"row.c{docs.columns.index('n_chars')}")
        changed["n_chars"] = F.when(F.size("pii_spans") > 0, length).otherwise(was)
    return _rows(found, docs, **changed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    _small_batches(spark)
    return packing.pack_documents(
        docs, SEQUENCE, tokens.default_vocabulary(), remember=REMEMBER
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_clean),
    ("personal_data", hide_personal),
    ("packing", pack),
]

#: Learned scores and token ids have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is a table in the shared folder."""
    docs = shared.table(spark, sf_dir, "documents")
    before = {name: spark.conf.get(name) for name in (_BATCH, _READ)}
    try:
        for name, stage in STAGES[:-1]:
            docs = shared.staged(stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
