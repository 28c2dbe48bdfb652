"""Best-fit packing of token sequences with a bounded number of open bins.

A document is its token ids and an end id. It is cut only if it is longer than a
sequence. Pieces arrive one after the other; each goes to the open bin with the least
free space that still takes it. Open bins are found by a bitset with one bit for each
amount of free space, so a search is a shift and a lowest bit. When more bins are open
than allowed, the fullest one closes. Bins live in one task; the pieces are dealt at
random over as many tasks as their number asks for, a fixed number of pieces to each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import col, partitions_for, slices, text_hash
from siltworks.llm.tokens import encoder
from siltworks.session import stage

SEQUENCE_TOKENS = 2048
OPEN_BINS = 4096
#: pieces that one task packs, on average
PIECES_PER_GROUP = 1 << 13
#: tasks that the groups are dealt to at most; a task packs its groups one after the other
MOST_TASKS = 1 << 14


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = 0,
) -> DataFrame:
    """(id, text hash, piece, start, length, ids_crc32): every document cut to sequence length.

    Null and empty texts are the end id alone. Repeated rows and rows without an id are
    documents of their own; columns other than id and text are not read.
    """

    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in slices(batches):
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in batch.column(2).to_pylist()]
            out: list[tuple] = []
            for doc, mark, data in zip(ids, hashes, encode(texts)):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * sequence_tokens)):
                    part = data[at : at + 4 * sequence_tokens]
                    out.append((doc, mark, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                names=["id", "text_hash", "piece", "start", "length", "ids_crc32"],
            )

    source = docs.select(
        col(id_column).cast("long").alias("id"), text_hash(text_column).alias("text_hash"), col(text_column).alias("t")
    )
    return source.mapInArrow(cut, "id long, text_hash long, piece int, start long, length long, ids_crc32 long")


class OpenBins:
    """Best fit over at most ``most`` open bins of ``capacity``."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece that is no longer than the capacity."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        rest = free - length
        if rest:
            if self.open == self.most:  # the fullest closes, which may be this one
                fullest = (self.bits & -self.bits).bit_length() - 1
                if rest <= fullest:
                    return number, self.capacity - free
                self._take(fullest)
            self.by_free[rest].append(number)
            self.bits |= 1 << rest
            self.open += 1
        return number, self.capacity - free


def pack(
    parts: DataFrame,
    sequence_tokens: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    pieces_per_group: int = PIECES_PER_GROUP,
) -> DataFrame:
    """``parts`` (see :func:`pieces`) with sequence_id and offset.

    The pieces are written first: their number sets the number of groups. A group is
    bounded, as pieces are dealt by a hash of their order number, so that no document or
    group of copies can fill one. Inside a group longer pieces arrive first, which best
    fit packs closest.
    """
    kinds = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    landed = stage(parts.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    groups = partitions_for(landed.count(), pieces_per_group, most=1 << 30)
    dealt = (
        landed.withColumn("_group", F.pmod(F.xxhash64("_at"), F.lit(groups)))
        .repartition(min(groups, MOST_TASKS), "_group")
        .sortWithinPartitions("_group", F.desc("length"), "_at")
        .drop("_at")
    )
    names = list(kinds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bins = None, None
        for batch in batches:
            sequence, offset = [], []
            for group, length in zip(batch.column("_group").to_pylist(), batch.column("length").to_pylist()):
                if group != current:
                    current, bins = group, OpenBins(sequence_tokens, open_bins)
                number, at = bins.place(length)
                sequence.append(group << 32 | number)
                offset.append(at)
            columns = [batch.column(n) for n in names] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    return dealt.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences_of(lengths: Iterable[int], capacity: int, open_bins: int = OPEN_BINS) -> list[tuple[int, int]]:
    """The same packing of one list, for tests and small inputs."""
    bins = OpenBins(capacity, open_bins)
    return [bins.place(n) for n in lengths]
