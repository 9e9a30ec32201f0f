"""Rows that every operator must take: nulls, blanks, long texts, repeats, clashing names."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet consectetur " * 6000
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from here"
ROWS = [
    (1, PLAIN),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, LONG),
    (6, PLAIN),
    (6, PLAIN),
    (None, PLAIN + " now"),
    (7, "Ünïcödé   日本 𝔘𝔫𝔦   \u0085 x"),
    (8, "one two"),
    (9, "!!! ??? ---"),
]
#: Names that operators use inside or add.
CLASHES = [
    "key", "row", "rep", "part", "size", "score", "predicted", "n_words", "n_hit", "n_items",
    "items_sha256", "spans", "pii_spans", "lang_pred", "rejected", "text_key", "draw", "kind",
    "digest", "bucket", "chunk", "cells", "sequence_id", "offset", "piece", "start", "length",
    "a-b", "a b", "__row", "__text_key", "__terms",
]


def documents(spark, rows=None):
    rows = ROWS if rows is None else rows
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(
        [(*r, *["kept"] * len(CLASHES)) for r in rows], f"doc_id long, text string, {extra}"
    )


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
