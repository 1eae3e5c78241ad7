"""A3/A5: a table is replaced as a whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from churnlens.sources import io


def ids(spark, root):
    return sorted(r.id for r in io.read_table(spark, root, "gold/t").collect())


def versions(root):
    return {f for f in os.listdir(f"{root}/gold/t") if f.startswith("v-")}


def test_replaced(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, root, "gold/t")
    for n in (3, 5, 2, 0):
        io.write_table(spark.range(n), root, "gold/t")
        assert ids(spark, root) == list(range(n)) and len(versions(root)) <= 2


def test_reads_the_table_it_replaces(spark, tmp_path):
    root = str(tmp_path)
    io.write_table(spark.range(4), root, "gold/t")
    began = io.read_table(spark, root, "gold/t")
    io.write_table(began.select(F.col("id") + 1), root, "gold/t", None)
    assert [r[0] for r in io.read_table(spark, root, "gold/t").orderBy(F.col("(id + 1)")).collect()] == [1, 2, 3, 4]
    assert sorted(r.id for r in began.collect()) == [0, 1, 2, 3]  # a reader that had begun


def test_lost_write(spark, tmp_path, monkeypatch):
    """A task that fails, or the job lost before the switch: the old rows stay, the next write succeeds."""
    root = str(tmp_path)
    io.write_table(spark.range(3), root, "gold/t")
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        io.write_table(broken, root, "gold/t")
    assert ids(spark, root) == [0, 1, 2]

    def killed(*_):
        raise RuntimeError("killed")
    switch = io._switch
    monkeypatch.setattr(io, "_switch", killed)
    with pytest.raises(RuntimeError):
        io.write_table(spark.range(7), root, "gold/t")
    assert ids(spark, root) == [0, 1, 2]
    monkeypatch.setattr(io, "_switch", switch)
    assert io.remove_unfinished(spark, root, "gold/t") >= 1 and len(versions(root)) == 1
    io.write_table(spark.range(2), root, "gold/t")
    assert ids(spark, root) == [0, 1] and len(versions(root)) == 2


def test_partitioned(spark, tmp_path):
    root = str(tmp_path)
    for months in (["2001-01-01", "2001-02-01"], ["2001-02-01"]):
        rows = spark.createDataFrame([(i, m) for i, m in enumerate(months)], "id long, month_start string")
        io.write_table(rows, root, "gold/t", ["month_start"])
        found = {f for f in os.listdir(io.table_path(spark, root, "gold/t")) if f.startswith("month_start=")}
        assert found == {f"month_start={m}" for m in months}
