"""Quoted line breaks read by many tasks, against the reader that takes a file whole."""

import random

import pytest
from pyspark.errors import PySparkException

from siltworks.sources import delimited, quoted


def lines_of(seed, n, longest=6):
    """Records with line breaks, doubled quotes, separators and empty fields inside quotes."""
    draw = random.Random(seed)

    def field():
        kind = draw.random()
        if kind < 0.4:
            return "".join(draw.choice("abcé 1") for _ in range(draw.randint(0, 8)))
        inner = "".join(draw.choice(["x", '""', "\n", ";", "\r\n", "long text ", "ü"]) for _ in range(draw.randint(0, longest)))
        return f'"{inner}"'

    return [f"{k};{field()};{field()}" for k in range(n)]


@pytest.fixture
def many_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def whole_reader(spark, path):
    return spark.read.options(header=True, sep=";", escape='"', multiLine=True).schema("k string, a string, b string").csv(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_whole_reader(spark, tmp_path, many_splits, end):
    for name, seed in (("one.csv", 1), ("two.csv", 2)):
        (tmp_path / name).write_bytes(("k;a;b" + end + end.join(lines_of(seed, 6000)) + end).encode())
    (tmp_path / "small.csv").write_bytes(b'k;a;b\n1;"x\ny";z')
    read = delimited.read_delimited(spark, str(tmp_path), multiline=True)
    assert len(quoted.openings(quoted._lines(spark, [str(tmp_path)]))) == 2
    assert any(inside.any() for _, inside, _ in quoted.openings(quoted._lines(spark, [str(tmp_path)])).values())
    assert read.rdd.getNumPartitions() > 10
    wanted = [tuple(r) for r in whole_reader(spark, str(tmp_path)).collect()]
    assert len(wanted) == 12_001 and sorted(map(str, map(tuple, read.collect()))) == sorted(map(str, wanted))


def test_a_field_longer_than_a_split(spark, tmp_path, many_splits):
    long = "\n".join(f"line {k} of a long note" for k in range(4000))
    (tmp_path / "t.csv").write_text(f'k;a;b\n1;x;y\n2;"{long}";z\n3;"p\nq";r\n')
    rows = {r["k"]: (r["a"], r["b"]) for r in delimited.read_delimited(spark, str(tmp_path), multiline=True).collect()}
    assert rows == {"1": ("x", "y"), "2": (long, "z"), "3": ("p\nq", "r")}


def test_open_and_stray_quotes_are_refused(spark, tmp_path):
    for name, text in (("open.csv", 'k;a;b\n1;"x;y\n2;z;w\n'), ("stray.csv", 'k;a;b\n1;5" pipe;y\n2;6" pipe;w\n3;u;v\n')):
        (tmp_path / name).write_text(text)
        path = str(tmp_path / name)
        with pytest.raises(PySparkException, match="quote not closed|too many fields"):
            delimited.read_delimited(spark, path, multiline=True).collect()
        good, bad = delimited.read_delimited_tolerant(spark, path, multiline=True)
        assert bad.count() == 1 and bad.first()["record"].startswith("1;")
        assert not delimited.can_read(spark, path, multiline=True)


def test_long_and_short_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text('k;a;b\n1;"x\ny"\n\n2;"x\ny";z;w\n3;a;b\n')
    good, bad = delimited.read_delimited_tolerant(spark, str(tmp_path), multiline=True)
    assert sorted(tuple(r) for r in good.collect()) == [("1", "x\ny", None), ("3", "a", "b")]
    assert [r["record"] for r in bad.collect()] == ['2;"x\ny";z;w']
    with pytest.raises(PySparkException, match="too many fields"):
        delimited.read_delimited(spark, str(tmp_path), multiline=True).collect()


def test_other_splits_than_those_counted_are_refused(spark, tmp_path, many_splits):
    (tmp_path / "t.csv").write_text("k;a;b\n" + "\n".join(lines_of(3, 4000)))
    read = delimited.read_delimited(spark, str(tmp_path), multiline=True)
    read.count()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    with pytest.raises(PySparkException, match="split otherwise"):
        delimited.read_delimited(spark, str(tmp_path), multiline=True)
        quoted_lines = quoted._lines(spark, [str(tmp_path)])
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        known = quoted.openings(quoted_lines)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        quoted._lines(spark, [str(tmp_path)]).mapInArrow(quoted._assembled(known, pieces=False), quoted._RECORDS).collect()
