"""Records of delimited text whose quoted fields hold line breaks, read by many tasks.

A line begins inside a quoted field if an odd number of quotes stands before it in its file. One
scan counts the quotes of every split of every file; the sums over the splits before tell how each
split begins, and a second scan then joins the lines of each record inside its split. Records that
go over the end of a split are put together from their pieces, of which each split has two at most.

Quotes have to be used as the format says: around a field, and doubled inside of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from siltworks.session import stage

_RECORDS = "record string, file string, at long, place int, closed boolean"

#: pieces of a record in the order in which a split has them: the end of an earlier one, or nothing but its
#: inside, comes before the beginning of another one
_ENDS, _INSIDE, _BEGINS = 0, 1, 2

#: by file with several splits: where they begin, whether inside quotes, and whether its first line ends in \r\n
Openings = dict[str, tuple[np.ndarray, np.ndarray, bool]]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines without their newline. A carriage return stays: only in files whose lines end with it, it is no text."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def openings(lines: DataFrame) -> Openings:
    """How each split begins. Nine bytes for each split of a file that has several are kept."""
    quotes = F.sum(F.expr("length(value) - length(replace(value, '\"', ''))"))
    # a split is one task's, which reads its lines in order
    ends = F.first(F.col("value").endswith("\r")).alias("returns")
    splits = lines.groupBy("file", "at").agg((quotes % 2 == 1).alias("odd"), ends)
    by_file = splits.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("at", "odd", "returns"))).alias("s"))
    found = {}
    for r in by_file.filter("size(s) > 1").collect():
        odd = np.array([s["odd"] for s in r["s"]], dtype=np.int64)
        found[r["file"]] = (np.array([s["at"] for s in r["s"]]), (np.cumsum(odd) - odd) % 2 == 1, r["s"][0]["returns"])
    return found


def _opening(known: Openings, name: str, at: int, first_line: str) -> tuple[bool, bool]:
    """(inside quotes?, do its lines end in \r\n?) of a split."""
    if at == 0:
        return False, first_line.endswith("\r")
    places, inside, returns = known.get(name, (np.zeros(0, dtype=np.int64), (), False))
    k = int(np.searchsorted(places, at))
    if k == len(places) or places[k] != at:
        raise RuntimeError(f"{name} is split otherwise than when its quotes were counted: read it again")
    return bool(inside[k]), returns


def _joined(lines: pa.Array, begins: np.ndarray) -> pa.Array:
    """The lines from each beginning to the next one, as one text each."""
    if len(begins) == len(lines):
        return lines
    offsets = pa.array(np.append(begins, len(lines)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _assembled(known: Openings, pieces: bool):
    """Records that lie in one split, or the pieces of those that do not."""

    def made(records: pa.Array, name: str, at: int, place: int, closed: bool) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [records, pa.array([name] * n, pa.string()), pa.array(np.full(n, at), pa.int64()), pa.array(np.full(n, place), pa.int32()), pa.array([closed] * n, pa.bool_())],
            names=["record", "file", "at", "place", "closed"],
        )

    def whole(records: pa.Array, name: str, at: int) -> Iterator[pa.RecordBatch]:
        if not pieces:
            records = records.filter(pc.not_equal(records, ""))
            yield made(records, name, at, _ENDS, True)

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, returns, waiting, own = None, False, False, [], True

        def leftover() -> Iterator[pa.RecordBatch]:
            if waiting and pieces:
                yield made(pa.array(["\n".join(waiting)]), *split, _BEGINS if own else _INSIDE, False)

        for batch in batches:
            if not batch.num_rows:
                continue
            at, names = batch.column(2).to_numpy(), batch.column(1).dictionary_encode().indices.to_numpy()
            borders = np.flatnonzero((np.diff(at) != 0) | (np.diff(names) != 0)) + 1
            for a, b in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
                key = (batch.column(1)[a].as_py(), int(at[a]))
                if key != split:
                    yield from leftover()
                    split, waiting = key, []
                    inside, returns = _opening(known, *key, batch.column(0)[a].as_py())
                    own = not inside  # whether what is waiting began in this split
                lines = batch.column(0).slice(a, b - a)
                if returns:
                    lines = pc.utf8_rtrim(lines, "\r")
                odd = pc.count_substring(lines, '"').to_numpy() % 2
                after = (np.cumsum(odd) + inside) % 2
                before = np.concatenate([[int(inside)], after[:-1]])
                begins = np.flatnonzero(before == 0)
                first = int(begins[0]) if len(begins) else len(lines)
                # up to the first beginning, lines belong to what is waiting
                if first and inside:
                    waiting += lines.slice(0, first).to_pylist()
                    if after[first - 1] == 0:
                        text = pa.array(["\n".join(waiting)])
                        if own:
                            yield from whole(text, *split)
                        elif pieces:
                            yield made(text, *split, _ENDS, True)
                        waiting, own = [], True
                inside = bool(after[-1])
                if len(begins):
                    last = int(begins[-1]) if inside else len(lines)
                    if last > first:
                        yield from whole(_joined(lines.slice(first, last - first), begins[begins < last] - first), *split)
                    if inside:
                        waiting, own = lines.slice(last).to_pylist(), True
        yield from leftover()

    return assembled


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(record, file, closed) of all records but the first of each file, which is its header.

    ``closed`` is false for a record whose quotes the end of its file leaves open. Empty lines
    between records are left out.
    """
    lines = _lines(spark, paths)
    known = openings(lines)
    inner = lines.mapInArrow(_without_header(_assembled(known, pieces=False)), _RECORDS).select("record", "file", "closed")
    parts = stage(lines.mapInArrow(_assembled(known, pieces=True), _RECORDS), "pieces_of_records")
    # a record begins with each piece that begins one; those that follow go on with it
    in_file = Window.partitionBy("file").orderBy("at", "place")
    numbered = parts.withColumn("number", F.sum(F.when(F.col("place") == _BEGINS, 1).otherwise(0)).over(in_file))
    pieces = F.array_sort(F.collect_list(F.struct("at", "place", "record")))
    put_together = numbered.groupBy("file", "number").agg(pieces.alias("p"), F.max("closed").alias("closed"))
    text = F.array_join(F.transform("p", lambda x: x["record"]), "\n")
    return inner.unionByName(put_together.select(text.alias("record"), "file", "closed"))


def _without_header(assembled):
    """All but the first record of each file."""

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headed: str | None = None
        for batch in assembled(batches):
            if batch.num_rows and batch.column(2)[0].as_py() == 0 and headed != batch.column(1)[0].as_py():
                headed = batch.column(1)[0].as_py()
                batch = batch.slice(1)
            if batch.num_rows:
                yield batch

    return rest
