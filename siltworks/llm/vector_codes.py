"""Product codes of vectors, with Orchard's search for the nearest codebook entry.

Components become integers and vectors are cut into equal parts; every position has a
codebook of its own that rounds of assignment and averaging refine. All sums and distances
are exact integers, so results do not depend on the order of rows or on lost tasks.

Orchard's search keeps for every entry the list of all entries by their distance from it. A
search holds one current entry and walks its list; a nearer entry becomes current and its
list is walked instead; entries met before are skipped. When the next entry of the list is
more than twice as far from the current entry as the searched point is, no entry behind it
can be as near, and the search is over. All points of a batch take their steps together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F, types as T

from siltworks.llm.common import SLICE_BYTES, col
from siltworks.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: integers beyond this are set to it, so that sums of any table have a type
LARGEST = 1 << 40
#: a label is hot if more than one row in so many has it; there are fewer hot labels than that
HOT_SHARE = 1000

#: entries of every part, as integers; all parts have the same number of entries and positions
Codebooks = np.ndarray


def integers(values: np.ndarray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x); Python integers where distances over ``width`` positions need more than 64 bits."""
    top = float(np.abs(values).max(initial=0.0))
    if top * scale <= math.isqrt((1 << 60) // max(1, width)):
        return np.floor(values * scale).astype(np.int64)
    flat = [max(-LARGEST, min(LARGEST, math.floor(Fraction(float(x)) * scale))) for x in values.ravel()]
    return np.array(flat, dtype=object).reshape(values.shape)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return (apart * apart).sum(axis=-1)


class Orchard:
    """Nearest entries of one codebook (entries x positions)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.apart = _squares(entries[:, None, :], entries[None, :, :])
        # neighbours of every entry, nearest first; it is the first of its own list
        self.lists = np.array([sorted(range(len(entries)), key=lambda e, c=c: (e != c, self.apart[c, e], e)) for c in range(len(entries))])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every point; of equally near entries the first one."""
        n, k = len(points), len(self.entries)
        current = np.zeros(n, dtype=np.int64)
        best = _squares(points, self.entries[0])
        place = np.ones(n, dtype=np.int64)
        visited = np.zeros((n, k), dtype=bool)
        visited[:, 0] = True
        active = np.arange(n) if k > 1 else np.arange(0)
        while len(active):
            now = current[active]
            entry = self.lists[now, place[active]]
            # distances are squared: beyond twice is beyond four times
            going = self.apart[now, entry] <= 4 * best[active]
            active, entry = active[going.astype(bool)], entry[going.astype(bool)]
            place[active] += 1
            fresh = ~visited[active, entry]
            rows, entry = active[fresh], entry[fresh]
            visited[rows, entry] = True
            found = _squares(points[rows], self.entries[entry])
            nearer = ((found < best[rows]) | ((found == best[rows]) & (entry < current[rows]))).astype(bool)
            rows, entry = rows[nearer], entry[nearer]
            current[rows], best[rows], place[rows] = entry, found[nearer], 1
            active = active[place[active] < k]
        return current, best


def _lists(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as a matrix; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _matrices(batches: Iterator[pa.RecordBatch], books: Codebooks, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their vectors as (rows, parts, positions), few at a time."""
    parts, _, each = books.shape
    width = parts * each
    for batch in batches:
        step = max(1, SLICE_BYTES // (8 * max(width, 1)))
        for at in range(0, batch.num_rows, step):
            rows = batch.slice(at, step)
            whole = integers(_lists(rows.column(rows.num_columns - 1), width), scale, width)
            if books.dtype == object:
                whole = whole.astype(object)
            yield rows, whole.reshape(len(whole), parts, each)


def _sums(kept: DataFrame, books: Codebooks, scale: int) -> list[Row]:
    """Per part, entry and position the sum and number of the parts that are nearest to the entry."""
    parts, entries, each = books.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(b) for b in books]
        total, n = np.zeros(books.shape, dtype=object), np.zeros((parts, entries), dtype=np.int64)
        for _, points in _matrices(batches, books, scale):
            for p in range(parts):
                nearest, _ = search[p].nearest(points[:, p])
                for e in np.unique(nearest):
                    own = points[nearest == e, p]
                    total[p, e] += own.sum(axis=0).astype(object)
                    n[p, e] += len(own)
        p, e, i = (x.ravel() for x in np.indices(books.shape))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()),
                pa.array([Decimal(int(x)) for x in total.ravel()], pa.decimal128(38, 0)),
                pa.array(np.broadcast_to(n[:, :, None], books.shape).ravel(), pa.int64()),
            ],
            names=["part", "entry", "position", "total", "n"],
        )

    found = kept.select("v").mapInArrow(partial, "part int, entry int, position int, total decimal(38,0), n long")
    # as many rows as the codebooks have numbers, whatever the table
    return found.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()


def _book(values: list, shape: tuple[int, int, int]) -> Codebooks:
    """64-bit integers where distances fit them."""
    top = max((abs(x) for x in values), default=0)
    small = top <= math.isqrt((1 << 60) // max(1, shape[0] * shape[2]))
    return np.array(values, dtype=np.int64 if small else object).reshape(shape)


def _usable(vector: str):
    """Rows whose vector has neither nulls nor numbers that are not finite."""
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return F.col(vector).isNotNull() & sound


def fit(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks of ``kept`` (id, v); None if it is empty.

    They start as the vectors with the smallest ids (equal ids by their vectors, rows
    without one last); there are fewer entries where there are fewer rows.
    """
    first = [r["v"] for r in kept.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()]
    if not first:
        return None
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    each = -(-longest // parts)
    padded = np.array([list(v) + [0.0] * (parts * each - len(v)) for v in first], dtype=np.float64)
    start = integers(padded, scale, parts * each).reshape(len(first), parts, each).swapaxes(0, 1)
    books = _book([int(x) for x in start.ravel()], start.shape)
    for _ in range(rounds):
        # entries that no part is nearest to stay
        moved = {(r["part"], r["entry"], r["position"]): int(r["total"]) // r["n"] for r in _sums(kept, books, scale) if r["n"]}
        books = _book([moved.get(at, int(x)) for at, x in np.ndenumerate(books)], books.shape)
    return books


def digest(books: Codebooks) -> str:
    """SHA-256 of all numbers by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def _assigned(kept: DataFrame, books: Codebooks, scale: int) -> DataFrame:
    schema = T.StructType([kept.schema["row"], T.StructField("code", T.StringType()), T.StructField("error", T.DecimalType(38, 0))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(b) for b in books]
        for rows, points in _matrices(batches, books, scale):
            found = [s.nearest(points[:, p]) for p, s in enumerate(search)]
            entry = np.stack([f[0] for f in found], axis=1).tolist()
            errors = [sum(int(d) for d in row) for row in zip(*[f[1].tolist() for f in found])]
            codes = ["".join(f"{e:02x}" for e in row) for row in entry]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(codes, pa.string()), pa.array(map(Decimal, errors), pa.decimal128(38, 0))],
                names=["row", "code", "error"],
            )

    return kept.select("row", "v").mapInArrow(assign, schema)


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the errors of its label summed, rows without a label together.

    The sums of hot labels, fewer than HOT_SHARE, go to the rows; all others meet
    their rows by label, of which none holds many.
    """
    totals = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label_errors")
    rows = totals.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE > F.lit(rows)
    hot, cold = (totals.filter(x).select(F.col("label").alias("l"), "label_error") for x in (is_hot, ~is_hot))
    same = F.col("label").eqNullSafe(F.col("l"))
    few = F.broadcast(hot)
    return (
        coded.join(few, same).drop("l")
        .unionByName(coded.join(few.select("l"), same, "left_anti").join(cold, same).drop("l"))
    )


def encode(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """((id, code, error, label_error, codebooks_sha256) of the usable rows, the codebooks).

    Rows whose vector is null or has a null or not finite component are left out; an empty
    table gives an empty one. Repeated rows and rows without an id are coded like any
    other; rows without a label have one label together. Vectors that are shorter than
    the longest one, or whose length the parts do not divide, end in zeros; an empty vector is
    all zeros. Integers beyond ``LARGEST`` count as it; errors that no long holds are
    null. Other columns are not read. At most 256 entries have two hex digits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    usable = vectors.select(
        col(id_column).alias("id"), col(label_column).alias("label"), col(vector_column).cast("array<double>").alias("v")
    ).filter(_usable("v"))
    kept = stage(usable, "vectors")
    books = fit(kept, parts, entries, rounds, scale)
    if books is None:
        none = kept.select("id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")])
        return none.withColumn("codebooks_sha256", F.lit("")), None
    coded = _assigned(kept.select(F.struct("id", "label").alias("row"), "v"), books, scale)
    landed = stage(coded.select("row.id", "row.label", "code", "error"), "codes")
    as_long = [F.expr(f"try_cast({c} AS BIGINT)").alias(c) for c in ("error", "label_error")]
    done = _with_label_error(landed).select("id", "code", *as_long, F.lit(digest(books)).alias("codebooks_sha256"))
    return done, books
