"""CSV with line breaks inside values, cut by many tasks, against Spark's one-task reader."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from tiered.sources import files, records

COLUMNS = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "note", "city")]).add("n", T.IntegerType())


def write(path, n, ending, seed):
    rng = random.Random(seed)
    notes = [
        "plain", '"a\nb"', '"say ""x""\n\n""y"""', '"\n\n\n"', '""', '"c, d"', '"""\n"""', '"e\r\nf"',
        '"' + "long line\n" * 40 + '"', " padded ", '"ü\n日本"',
    ]
    lines = ["id,note,city,n"]
    for k in range(n):
        lines.append(f"{k},{rng.choice(notes)},{rng.choice(['Rome', '', chr(34) + 'New' + chr(10) + 'York' + chr(34)])},{rng.choice(['1', '', 'x', '7'])}")
        if rng.random() < 0.05:
            lines.append("")
    path.write_bytes((ending.join(lines) + (ending if seed % 2 else "")).encode())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (int(r[0]), repr(r)))


@pytest.mark.parametrize("size", [64, 700, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_equals_the_reader_of_whole_files(spark, tmp_path, size, ending):
    for k in range(3):
        write(tmp_path / f"{k}.csv", 120, ending, k)
    want = rows(files.read_csv(spark, str(tmp_path), COLUMNS, multi_line=True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = files.read_csv(spark, str(tmp_path), COLUMNS)
        assert "MapInArrow" in found._jdf.queryExecution().toString()
        got = rows(found)
        if size < 1000:
            assert records.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert len(got) == 360 and got == want


def test_many_blocks_are_dealt_instead_of_sent(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", 200, "\n", 5)
    want = rows(files.read_csv(spark, str(tmp_path), COLUMNS, multi_line=True))
    monkeypatch.setattr(records, "BROADCAST_BLOCKS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        assert rows(files.read_csv(spark, str(tmp_path), COLUMNS)) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_without_breaks_take_the_plain_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,city,n\n1,"a ""b""",Rome,2\n2,,"x, y",z\n')
    found = files.read_csv(spark, str(tmp_path), COLUMNS)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    assert rows(found) == [("1", 'a "b"', "Rome", 2), ("2", None, "x, y", None)]


def test_a_quote_without_its_pair_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,city,n\n1,"open,Rome,2\n2,b,c,3\n')
    with pytest.raises(ValueError, match="without its pair"):
        files.read_csv(spark, str(tmp_path), COLUMNS)


def test_broken_values_are_kept_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,city,n\n1,"a\nb",Rome,two\n2,c,Bonn,3\n')
    found = files.read_csv(spark, str(tmp_path), COLUMNS, corrupt_column="_bad")
    assert [(r.note, r.n, r._bad) for r in found.orderBy("id").collect()] == [
        ("a\nb", None, '1,"a\nb",Rome,two'), ("c", 3, None)]
