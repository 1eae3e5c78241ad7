"""A1: quoted CSV read by many tasks per file gives the rows of Spark's one-task reader."""

import random

import pytest

from churnlens.sources import quoted_csv

NAMES = ["id", "name", "note"]


def one_task(spark, path):
    schema = "id string, name string, note string, _corrupt string"
    return (spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt")
            .csv(path, header=True, multiLine=True, escape='"', mode="PERMISSIVE"))


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))
    yield use
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def value(r, hard):
    kind = r.random()
    plain = "".join(r.choice("ab é1") for _ in range(r.randrange(6)))
    if kind < 0.4:
        return plain
    if kind < 0.5 and hard:  # a quote inside a plain value opens nothing
        return plain + 'x"' + plain
    inside = "".join(r.choice(['a', ',', '""', '\n', '\n\n', ' ', 'é', '""\n']) for _ in range(r.randrange(25)))
    return f'"{inside}"'


def record(r, hard, fields=3):
    return ",".join(value(r, hard) for _ in range(fields))


@pytest.mark.parametrize("seed,size", [(1, 40), (2, 64), (3, 200), (4, 1000), (5, 7)])
def test_equals_one_task_reader(spark, tmp_path, small_splits, seed, size):
    r = random.Random(seed)
    lines = [record(r, True, r.choice((3, 3, 3, 3, 2, 4))) for _ in range(60)]
    (tmp_path / "a.csv").write_text("id,name,note\n" + "\n".join(lines) + "\n")
    expected = key(one_task(spark, str(tmp_path)).collect())
    small_splits(size)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1
    found = quoted_csv.read(spark, str(tmp_path), NAMES, "_corrupt")
    assert key(found.collect()) == expected and len(expected) > 40


def test_value_longer_than_splits(spark, tmp_path, small_splits):
    """A value over many splits, some of them without any quote; a quote that is never closed at the end."""
    text = "id,name,note\n1,a,b\n2,\"" + "line\n" * 500 + "end\",c\n3,\"" + 'x""\n' * 200 + "\",d\n4,e,f"
    (tmp_path / "a.csv").write_text(text)
    expected = key(one_task(spark, str(tmp_path)).collect())
    small_splits(100)
    found = key(quoted_csv.read(spark, str(tmp_path), NAMES, "_corrupt").collect())
    assert found == expected and len(found) == 4


def test_headers_of_their_own(spark, tmp_path, small_splits):
    """Files with their columns in other orders, further columns, quoted names, a byte-order mark, empty files."""
    (tmp_path / "a.csv").write_text("id,name,note\n1,a,\"x\ny\"\n")
    (tmp_path / "b.csv").write_text("﻿note,more,id,name\nn,m,2,b\n\"q\nr\",m,3,\n")
    (tmp_path / "c.csv").write_text('"name","note","id"\r\nc,"s\r\nt",4\r\n\r\n')
    (tmp_path / "d.csv").write_text("id,name,note\n")
    (tmp_path / "e.csv").write_text("")
    for size in (5, 1000):
        small_splits(size)
        found = key(quoted_csv.read(spark, str(tmp_path), NAMES, "_corrupt").collect())
        assert found == key([("1", "a", "x\ny", None), ("2", "b", "n", None), ("3", None, "q\nr", None), ("4", "c", "s\r\nt", None)])


def test_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,a\n")
    with pytest.raises(ValueError, match="note"):
        quoted_csv.read(spark, str(tmp_path), NAMES, "_corrupt")
    (tmp_path / "b.csv").write_text("id,name,note\n1,a,b\n")
    with pytest.raises(Exception, match="no header with the columns"):
        quoted_csv.read(spark, str(tmp_path), NAMES, "_corrupt").collect()
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    assert quoted_csv.read(spark, str(tmp_path / "none"), NAMES, "_corrupt").columns == [*NAMES, "_corrupt"]
