import pytest
from pyspark.errors import PySparkException

from siltworks.operators import ingest as ing
from siltworks.sources import delimited, files


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_delimiter_is_found_and_text_kept(spark, tmp_path, sep):
    lines = [sep.join([" Age ", "JOB", "note"]), sep.join(["1", " x ", f'"a{sep}b"']), sep.join(["", '""', "NA"])]
    path = write(tmp_path / "t.csv", "\n".join(lines) + "\n")
    assert delimited.detect_delimiter(spark, path) == sep
    rows = ing.apply_null_tokens(ing.normalize_header(delimited.read_delimited(spark, path)), ("", "NA")).collect()
    assert [tuple(r) for r in rows] == [("1", " x ", f"a{sep}b"), (None, None, None)]
    assert rows[0].asDict().keys() == {"age", "job", "note"}


def test_delimiter_inside_quotes_does_not_count(spark, tmp_path):
    path = write(tmp_path / "t.csv", '"a;b;c;d",e\n1,2\n')
    assert delimited.detect_delimiter(spark, path) == ","


def test_headers_with_special_characters(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a.b;c d;`e`\n1;2;3\n1;2;3;4\n")
    good, bad = delimited.read_delimited_tolerant(spark, path)
    assert [tuple(r) for r in good.collect()] == [("1", "2", "3")]
    assert bad.count() == 1


RAGGED = 'a;b;c\n1;2;3\n4;5\n\n6;7;8;9\n"x;y";;""\n'


def test_short_rows_are_padded_and_blank_lines_skipped(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a;b;c\n1;2;3\n4;5\n\n")
    assert sorted(tuple(r) for r in delimited.read_delimited(spark, path).collect()) == [("1", "2", "3"), ("4", "5", None)]


@pytest.mark.parametrize("use", [lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("b").collect()])
def test_long_rows_fail_a_strict_read(spark, tmp_path, use):
    path = write(tmp_path / "t.csv", RAGGED)
    with pytest.raises(PySparkException, match="too many fields"):
        use(delimited.read_delimited(spark, path))


def test_long_rows_are_set_apart(spark, tmp_path):
    path = write(tmp_path / "t.csv", RAGGED)
    good, bad = delimited.read_delimited_tolerant(spark, path)
    assert good.count() == 3
    assert [r["record"] for r in bad.collect()] == ["6;7;8;9"]


def test_readability_per_file(spark, tmp_path):
    write(tmp_path / "good.csv", "a;b\n1;2\n3\n")
    write(tmp_path / "bad.csv", "a;b\n1;2;3\n4;5\n")
    found = {r["file_path"].split("/")[-1]: r for r in delimited.readable_files(spark, str(tmp_path)).collect()}
    assert (found["good.csv"]["n_rows"], found["good.csv"]["readable"]) == (2, True)
    assert (found["bad.csv"]["n_too_long"], found["bad.csv"]["readable"]) == (1, False)


def test_columns_of_several_files_meet_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "contact_id;age;balance\n1;40;100\n")
    write(tmp_path / "b.csv", "contact_id;balance;age\n2;200;41\n")
    write(tmp_path / "c.csv", 'contact_id,age,balance\n3,"4,2",300\n')
    rows = delimited.read_delimited(spark, str(tmp_path)).orderBy("contact_id").collect()
    assert [r.asDict() for r in rows] == [
        {"contact_id": "1", "age": "40", "balance": "100"},
        {"contact_id": "2", "age": "41", "balance": "200"},
        {"contact_id": "3", "age": "4,2", "balance": "300"},
    ]
    assert delimited.can_read(spark, str(tmp_path))


def test_files_with_other_columns_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "a;b\n1;2\n")
    write(tmp_path / "b.csv", "a;b\n1;2\n")
    write(tmp_path / "c.csv", "a;c\n1;2\n")
    with pytest.raises(ValueError, match="different columns"):
        delimited.read_delimited(spark, str(tmp_path))
    found = {r["file_path"].split("/")[-1]: r["reason"] for r in delimited.readable_files(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": "", "b.csv": "", "c.csv": "other columns"}


def test_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'k;note;n\n1;"a\nb";100\n2;"say ""x""";200\n')
    with pytest.raises(PySparkException, match="quote not closed"):
        delimited.read_delimited(spark, path).collect()
    assert not delimited.can_read(spark, path)
    rows = delimited.read_delimited(spark, path, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1", "a\nb", "100"), ("2", 'say "x"', "200")]
    assert delimited.can_read(spark, path, multiline=True)


def test_damaged_files_are_findings(spark, tmp_path):
    import gzip

    write(tmp_path / "good.csv", "a;b\n1;2\n")
    (tmp_path / "no.csv.gz").write_bytes(b"this is no gzip")
    whole = gzip.compress(b"a;b\n" + b"".join(b"%d;%d\n" % (k * k, k) for k in range(50_000)))
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    write(tmp_path / "blank.csv", "\n\n")
    found = {r["file_path"].split("/")[-1]: r["readable"] for r in delimited.readable_files(spark, str(tmp_path)).collect()}
    assert found == {"good.csv": True, "no.csv.gz": False, "cut.csv.gz": False, "blank.csv": False}
    assert not delimited.can_read(spark, str(tmp_path))


def test_unreadable_paths(spark, tmp_path):
    absent = str(tmp_path / "absent.csv")
    assert [r["readable"] for r in delimited.readable_files(spark, absent).collect()] == [False]
    assert not delimited.can_read(spark, absent)
    assert not delimited.can_read(spark, write(tmp_path / "empty.csv", ""))
    assert delimited.can_read(spark, write(tmp_path / "fine.csv", "a,b\n1,2\n"))


def test_file_facts(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    write(tmp_path / "d" / "x.csv", "12345")
    write(tmp_path / "d" / "e" / "y.csv", "123")
    assert tuple(files.dir_bytes(spark, str(tmp_path / "d")).first()) == (2, 8)
    assert tuple(files.dir_bytes(spark, str(tmp_path / "absent")).first()) == (0, 0)
    found = files.source_inventory(spark, [str(tmp_path / "d"), str(tmp_path / "absent")]).collect()
    assert sorted((r["available"], r["n_files"], r["size_bytes"]) for r in found) == [(False, 0, 0), (True, 2, 8)]
    with pytest.raises(FileNotFoundError):
        files.require_source(spark, str(tmp_path / "absent"))


def test_sample_is_the_first_rows_by_key(spark):
    df = spark.range(100).selectExpr("99 - id AS k").repartition(7)
    assert [r["k"] for r in files.table_sample(df, ["k"], 3).collect()] == [0, 1, 2]


ODD_NAMES = ["a b.csv", "a[1].csv", "100%.csv", "a%20b.csv", "x,y;z.csv", "{k}.csv", "q?.csv", "s*.csv", "ü#é.csv", "back\\slash.csv"]


def test_file_names_of_any_signs(spark, tmp_path):
    folder = tmp_path / "in [2024], {all} 50%"
    folder.mkdir()
    for k, name in enumerate(ODD_NAMES):
        # a second order of columns, so that files are read by name
        write(folder / name, f"k;v\n{k};a{k}\n" if k % 3 else f"v,k\na{k},{k}\n")
    rows = delimited.read_delimited(spark, str(folder)).collect()
    assert {(r["k"], r["v"]) for r in rows} == {(str(k), f"a{k}") for k in range(len(ODD_NAMES))}
    found = {r["file_path"].split("/")[-1]: (r["n_rows"], r["readable"]) for r in delimited.readable_files(spark, str(folder)).collect()}
    assert found == {name: (1, True) for name in ODD_NAMES}
    for name in ODD_NAMES[:3]:
        assert delimited.read_delimited(spark, str(folder / name)).count() == 1
        assert delimited.can_read(spark, str(folder / name))


def test_files_of_one_header_are_read_as_a_folder(spark, tmp_path):
    for k in range(60):
        write(tmp_path / f"{k}.csv", f"a;b\n{k};x\n{k};y\n")
    write(tmp_path / "blank.csv", "\n")
    [layout] = delimited.layouts(spark, str(tmp_path))
    assert layout.paths == (str(tmp_path),) and layout.header == "a;b"
    assert delimited.read_delimited(spark, str(tmp_path)).count() == 120


def test_headers_of_many_files_take_few_jobs(spark, tmp_path):
    from pyspark import SparkContext

    for k in range(150):
        write(tmp_path / f"{k}.csv", "a;b\n1;2\n" if k % 2 else "b;a\n1;2\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        assert len(delimited.layouts(spark, str(tmp_path))) == 2
        assert len(tracker.getJobIdsForGroup("headers")) <= 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert isinstance(SparkContext._active_spark_context, SparkContext)


def test_headers_of_large_files_are_read_from_their_beginning(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "SMALL_FILE", 1000)
    write(tmp_path / "small.csv", "a;b\n1;2\n")
    write(tmp_path / "large.csv", "\n﻿b;a\r\n" + "1;2\r\n" * 40_000)
    found = {layout.header: layout.paths for layout in delimited.layouts(spark, str(tmp_path))}
    assert found.keys() == {"a;b", "b;a"}
    assert [len(h.collect()) for h in delimited._header_lines(spark, str(tmp_path))] == [1, 1]


def test_a_damaged_file_among_many_is_found_alone(spark, tmp_path):
    for k in range(20):
        write(tmp_path / f"{k}.csv", f"a;b\n{k};x\n")
    (tmp_path / "no.csv.gz").write_bytes(b"no gzip")
    found = {r["file_path"].split("/")[-1]: r["readable"] for r in delimited.readable_files(spark, str(tmp_path)).collect()}
    assert len(found) == 21 and [n for n, ok in found.items() if not ok] == ["no.csv.gz"]
    with pytest.raises(Exception):
        delimited.read_delimited(spark, str(tmp_path)).collect()
