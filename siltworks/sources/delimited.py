"""Delimited text: delimiter and header of each file, strict and tolerant reads, readability per file."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siltworks.functions import sql
from siltworks.operators.ingest import header_map
from siltworks.sources import quoted

# The delimiters that are tried, in the order that decides ties.
DELIMITERS = (",", ";", "\t", "|")

RECORD, FILE = "_record", "_file"

#: what a scan of a damaged file raises, on the driver or in a task
READ_ERRORS = (PySparkException, Py4JJavaError, ValueError)

#: smaller files are read whole for their header, many to a task; of larger ones a task reads the beginning
SMALL_FILE = 4 << 20


class Layout(NamedTuple):
    """Files that share a header line, and so a delimiter and an order of columns.

    ``paths`` is what a reader takes: names of files, or the folder if all its files are alike.
    """

    sep: str
    header: str
    paths: tuple[str, ...]
    sample: str


# ---- names of files ------------------------------------------------------------

_PATTERN_SIGNS = re.compile(r"([\\{}\[\]*?])")


def _escaped(path: str) -> str:
    """A name for a reader, to which brackets and the like would be a pattern."""
    return _PATTERN_SIGNS.sub(r"\\\1", path)


def reader_path(uri: str) -> str:
    """What a reader takes for a file that a scan has named: scans write blanks and percent signs as codes."""
    return _escaped(unquote(uri))


def source_path(spark: SparkSession, path: str) -> str:
    """``path`` for a reader: as it is, or as the name of a file that looks like a pattern."""
    try:
        spark.read.text(path)
    except AnalysisException:
        if not _PATTERN_SIGNS.search(path):
            raise
        spark.read.text(_escaped(path))
        return _escaped(path)
    return path


def _plain(path: str) -> str:
    """One spelling of a file's address: listings and scans differ in slashes after the scheme."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def _files(spark: SparkSession, source: str) -> list[str]:
    return sorted(map(_plain, spark.read.text(source).inputFiles()))


# ---- headers -------------------------------------------------------------------


def _first_lines(stop_early: bool):
    """The first line with text of each file, from the lines of one task."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[str] = set()
        for batch in batches:
            begins = pc.and_(pc.equal(batch.column(2), 0), pc.greater(pc.utf8_length(pc.utf8_trim(batch.column(0), " ")), 0))
            lines = batch.filter(begins)
            names = lines.column(1).dictionary_encode()
            first = {}
            for at, code in enumerate(names.indices.to_pylist() if len(names.dictionary) > 1 else [0] * min(1, len(names))):
                first.setdefault(code, at)
            new = [at for code, at in first.items() if names.dictionary[code].as_py() not in done]
            if new:
                made = lines.take(pa.array(new, pa.int64()))
                done.update(made.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([made.column(1), made.column(0)], names=["file", "header"])
            if stop_early and (done or batch.column(2)[0].as_py()):
                return

    return found


def _header_lines(spark: SparkSession, source: str) -> list[DataFrame]:
    """(file, header) of all files, read in the tasks: one table for small files, one for large ones.

    Files of which nothing can be read are missing. The sessions have settings of their own for how files
    are dealt to tasks; a large file is one task's, which stops after the first lines.
    """
    found = []
    for small, pack_bytes in ((True, 64 << 10), (False, 1 << 40)):
        own = spark.newSession()
        own.conf.set("spark.sql.files.openCostInBytes", str(pack_bytes))
        if not small:
            own.conf.set("spark.sql.files.maxPartitionBytes", str(pack_bytes))
        lines = own.read.option("ignoreCorruptFiles", "true").text(source)
        size, begin = F.col("_metadata.file_size"), F.col("_metadata.file_block_start")
        chosen = lines.filter(size < SMALL_FILE if small else size >= SMALL_FILE).select(
            "value", F.col("_metadata.file_path").alias("file"), begin.alias("at")
        )
        heads = chosen.mapInArrow(_first_lines(stop_early=not small), "file string, header string")
        # a mark at the very beginning and a carriage return at the end belong to no name
        found.append(heads.withColumn("header", F.regexp_replace("header", "^\ufeff|\r$", "")))
    return found


def _delimiter_of(header: str) -> str:
    bare = re.sub(r'"(?:[^"]|"")*"', "", header)
    return max(DELIMITERS, key=bare.count)


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that occurs most often in the header, outside quotes; files must agree."""
    found = {layout.sep for layout in layouts(spark, path)}
    if len(found) != 1:
        raise ValueError(f"files under {path} have different delimiters: {sorted(found)}")
    return found.pop()


def layouts(spark: SparkSession, path: str, sep: str | None = None) -> list[Layout]:
    """The files of a folder by header line, the layout of most files first.

    Two jobs read the first lines of all files in the tasks and bring back each different header once.
    Only where there are several do names of files come back, for readers that need them.
    """
    source = source_path(spark, path)
    lines = _header_lines(spark, source)
    counts: dict[str, list] = {}
    for heads in lines:
        for r in heads.groupBy("header").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file")).collect():
            known = counts.setdefault(r["header"], [0, r["file"]])
            known[0], known[1] = known[0] + r["n"], min(known[1], r["file"])
    if not counts:
        raise ValueError(f"no header line in {path}")
    if len(counts) == 1:
        [(header, (_, sample))] = counts.items()
        return [Layout(sep or _delimiter_of(header), header, (source,), reader_path(sample))]
    files: dict[str, list[str]] = {h: [] for h in sorted(counts, key=lambda h: (-counts[h][0], counts[h][1]))}
    for heads in lines:
        for r in heads.collect():
            files[r["header"]].append(_plain(r["file"]))
    # files without a header are empty or damaged: the first reader will tell
    headless = set(_files(spark, source)).difference(*files.values())
    files[next(iter(files))] += sorted(headless)
    return [
        Layout(sep or _delimiter_of(h), h, tuple(reader_path(f) for f in sorted(own)), reader_path(counts[h][1]))
        for h, own in files.items()
    ]


# ---- rows ----------------------------------------------------------------------


class Parsed(NamedTuple):
    """All columns as text, the record of a malformed row and its file, and what may be wrong with a row."""

    rows: DataFrame
    names: list[str]
    is_long: Column
    is_broken: Column


def _parsed(spark: SparkSession, layout: Layout, multiline: bool) -> Parsed:
    form = {"sep": layout.sep, "escape": '"', "unescapedQuoteHandling": "RAISE_ERROR", "multiLine": multiline}
    names = spark.read.options(header=True, **form).csv(layout.sample).columns
    header_map(names)  # raises on headers that become the same column
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, RECORD)])
    if multiline:
        text = quoted.records(spark, list(layout.paths))
        form |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
        parsed = text.select("record", "closed", "file", F.from_csv("record", schema.toDDL(), {k: str(v) for k, v in form.items()}).alias("r"))
        rows = parsed.select(*[F.col("r").getField(n).alias(n) for n in (*names, RECORD)], F.col("file").alias(FILE), "record", "closed")
        # a quote inside an unquoted field joins lines that do not belong together
        breaks = [f"length({c}) - length(replace({c}, '\n', ''))" for c in ("record", *[f"coalesce({sql.name(n)}, '')" for n in names])]
        unquoted = ~(F.col("record").startswith('"') | F.col("record").contains(layout.sep + '"'))
        joined = F.col("record").contains("\n") & (unquoted | F.expr(f"{breaks[0]} != {' + '.join(breaks[1:])}"))
        broken = ~F.col("closed") | joined
        # such a row is shown as it stands
        rows = rows.withColumn(RECORD, F.when(broken, F.col("record")).otherwise(F.col(RECORD)))
        is_broken = broken
    else:
        # without column pruning a row is judged by all its fields, whatever a query reads
        rows = (
            spark.read.schema(schema)
            .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, columnPruning=False, **form)
            .csv(list(layout.paths))
            .withColumn(FILE, F.col("_metadata.file_path"))
        )
        # a quote that is never closed: its field goes on in the next line, or the text is damaged
        quotes = F.length(RECORD) - F.length(F.replace(RECORD, F.lit('"'), F.lit("")))
        is_broken = F.col(RECORD).isNotNull() & (quotes % 2 == 1)
    # A short row is malformed too; only a long one fills one more column. The comparison
    # with the first field holds for every long row and makes each query read a field:
    # Spark refuses a scan of nothing but malformed records.
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    extra = F.from_csv(RECORD, wider, {"sep": layout.sep, "escape": '"', "multiLine": "true"})[f"c{len(names)}"]
    first = F.coalesce(F.col(sql.name(names[0])), F.lit(""))
    is_long = F.col(RECORD).isNotNull() & ~is_broken & extra.isNotNull() & (F.length(RECORD) > F.length(first))
    return Parsed(rows, names, is_long, is_broken)


def _by_name(spark: SparkSession, path: str, sep: str | None, multiline: bool, make: Callable[[Parsed], DataFrame]) -> DataFrame:
    """What ``make`` makes of every layout, columns matched by name."""
    parts = []
    for layout in layouts(spark, path, sep):
        part = make(_parsed(spark, layout, multiline))
        if parts and set(part.columns) != set(parts[0].columns):
            differing = sorted(set(part.columns) ^ set(parts[0].columns))
            raise ValueError(f"files under {path} have different columns: {differing} in {layout.sample}")
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, multiline: bool = False) -> DataFrame:
    """Every column as text, from all files under ``path``.

    Each file has its own header and delimiter; columns meet by name, and files with other
    columns are refused. Short rows are padded with nulls; a long row or a quote that
    its line does not close fails the job. With ``multiline`` quoted fields may hold
    line breaks (see :mod:`siltworks.sources.quoted`); a quote that its file does not close
    fails the job then. File names may hold any signs that the file system takes.
    """

    def strict(p: Parsed) -> DataFrame:
        long = F.raise_error(F.concat(F.lit("row with too many fields: "), F.col(RECORD))).cast("boolean")
        broken = F.raise_error(F.concat(F.lit("quote not closed in its line (see multiline): "), F.col(RECORD)))
        sound = F.when(p.is_broken, broken.cast("boolean")).when(p.is_long, long).otherwise(F.lit(True))
        return p.rows.filter(sound).select(*[F.col(sql.name(n)) for n in p.names])

    return _by_name(spark, path, sep, multiline, strict)


def read_delimited_tolerant(
    spark: SparkSession, path: str, sep: str | None = None, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine): long rows and rows with an open quote are set apart with their text and file."""

    def good(p: Parsed) -> DataFrame:
        return p.rows.filter(~p.is_long & ~p.is_broken).select(*[F.col(sql.name(n)) for n in p.names])

    def bad(p: Parsed) -> DataFrame:
        return p.rows.filter(p.is_long | p.is_broken).select(
            *[F.col(sql.name(n)) for n in p.names], F.col(RECORD).alias("record"), F.col(FILE).alias("file_path")
        )

    return _by_name(spark, path, sep, multiline, good), _by_name(spark, path, sep, multiline, bad)


# ---- readability ---------------------------------------------------------------

FILES_SCHEMA = "file_path string, n_rows bigint, n_too_long bigint, readable boolean, reason string"


def _judged(spark: SparkSession, layout: Layout, files: list[str], expected: set[str], multiline: bool) -> list[tuple]:
    """One row for each of the files of a layout, from a scan that has run."""
    p = _parsed(spark, layout, multiline)
    columns = set(p.names)
    counted = (
        p.rows.select(F.col(FILE).alias("f"), p.is_long.alias("long"), p.is_broken.alias("broken"))
        .groupBy("f")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("long").alias("long"), F.count_if("broken").alias("broken"))
        .collect()
    )
    found = {_plain(r["f"]): r for r in counted}
    rows = []
    for f in files:
        r = found.get(_plain(f))
        n, long, broken = (r["n"], r["long"], r["broken"]) if r else (0, 0, 0)
        reason = (
            "other columns" if columns != expected
            else "rows with too many fields" if long
            else "quote not closed" if broken
            else ""
        )
        rows.append((unquote(f), n, long, not reason, reason))
    return rows


def _judged_in_halves(spark: SparkSession, layout: Layout, files: list[str], expected: set[str], multiline: bool) -> list[tuple]:
    """As :func:`_judged`; where the scan fails, its files are halved until the damaged ones stand alone."""
    try:
        return _judged(spark, layout, files, expected, multiline)
    except READ_ERRORS as error:
        if len(files) == 1:
            return [(unquote(files[0]), 0, 0, False, type(error).__name__)]
    found = []
    for part in (files[: len(files) // 2], files[len(files) // 2 :]):
        own = tuple(reader_path(f) for f in part)
        found += _judged_in_halves(spark, layout._replace(paths=own, sample=own[0]), part, expected, multiline)
    return found


def readable_files(spark: SparkSession, path: str, sep: str | None = None, multiline: bool = False) -> DataFrame:
    """Per file: rows, rows with too many fields and whether it can be read, by reading it.

    Files whose columns differ from those of most files are not readable together with
    them. A damaged file is a finding and not an error; files are read in as many jobs as there are
    different headers, and in some more for each damaged file. A path that cannot be read at
    all gives one row that says so.
    """
    try:
        source = source_path(spark, path)
        files = _files(spark, source)
    except READ_ERRORS as error:
        return spark.createDataFrame([(path, 0, 0, False, type(error).__name__)], FILES_SCHEMA)
    by_header: dict[str, list[str]] = {}
    for heads in _header_lines(spark, source):
        for r in heads.collect():
            by_header.setdefault(r["header"], []).append(_plain(r["file"]))
    rows: list[tuple] = []
    expected: set[str] = set()
    for h, own in sorted(by_header.items(), key=lambda x: (-len(x[1]), min(x[1]))):
        own.sort()
        paths = tuple(reader_path(f) for f in own)
        layout = Layout(sep or _delimiter_of(h), h, paths if len(own) < len(files) else (source,), paths[0])
        if not expected:
            try:
                expected = set(_parsed(spark, layout, False).names)
            except READ_ERRORS:  # a header that no table can have
                pass
        rows += _judged_in_halves(spark, layout, own, expected, multiline)
    for f in sorted(set(files).difference(*by_header.values())):
        try:
            broken = not spark.read.text(reader_path(f)).filter(F.length(F.trim("value")) > 0).isEmpty()
            rows.append((unquote(f), 0, 0, False, "damaged" if broken else "no header line"))
        except READ_ERRORS as error:
            rows.append((unquote(f), 0, 0, False, type(error).__name__))
    return spark.createDataFrame(rows or [(path, 0, 0, False, "no files")], FILES_SCHEMA)


def can_read(spark: SparkSession, path: str, sep: str | None = None, multiline: bool = False) -> bool:
    """Can all rows of all files be read?"""
    return readable_files(spark, path, sep, multiline).filter(~F.col("readable")).isEmpty()
