"""Packing of token sequences that balances what attention costs.

A piece of n tokens costs ``linear * n + quadratic * n * n``: the layers that look at one
token, and attention among the tokens of one piece. Pieces are taken from the longest to the
shortest; each goes to the sequence with the lowest cost so far that still has room for it.
The sequences of a group are laid out before: as many full ones as its tokens fill, and for
the rest one for each power of two in it, so that no place is left to pad. A piece for which
no sequence has room as a whole fills up the cheapest one with room, and what is left of
it queues again by its length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import col, partitions_for, slices
from siltworks.llm.tokens import encoder

SEQUENCE_TOKENS = 2048
#: documents that are packed together, on average; each brings less than a sequence of tokens
DOCS_PER_GROUP = 1 << 12
#: what one token costs in the unit of one pair of tokens; six times the width of a model
LINEAR_COST = 6 * 1024
QUADRATIC_COST = 1

_FRAGMENTS = "doc_id long, at long, doc_tokens long, start long, length long, ids_crc32 long, ids binary"
_PACKED = (
    "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost long"
)


def cost(length: int, linear: int = LINEAR_COST, quadratic: int = QUADRATIC_COST) -> int:
    """The estimated cost of a piece."""
    return linear * length + quadratic * length * length


def capacities(tokens: int, sequence_tokens: int) -> list[int]:
    """Sequences that take exactly ``tokens``: full ones, then a power of two for each bit of the rest."""
    full, rest = divmod(tokens, sequence_tokens)
    return [sequence_tokens] * full + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def assign(
    lengths: Sequence[int], sequence_tokens: int, linear: int = LINEAR_COST, quadratic: int = QUADRATIC_COST
) -> list[tuple[int, int, int, int, int]]:
    """(index of the length, start in it, tokens, sequence, offset) of every piece of one group.

    Equal lengths go by their order, equal costs to the first sequence.
    """
    room = np.array(capacities(sum(lengths), sequence_tokens), dtype=np.int64)
    free, spent = room.copy(), np.zeros(len(room), dtype=np.int64)
    never = np.iinfo(np.int64).max
    queue = [(-n, k, 0) for k, n in enumerate(lengths)]
    heapq.heapify(queue)
    placed = []
    while queue:
        n, k, start = heapq.heappop(queue)
        n = -n
        costs = np.where(free >= n, spent, never)
        best = int(costs.argmin())
        taken = n
        if costs[best] == never:  # no room for all of it
            best = int(np.where(free > 0, spent, never).argmin())
            taken = int(free[best])
            heapq.heappush(queue, (taken - n, k, start + taken))
        placed.append((k, start, taken, best, int(room[best] - free[best])))
        free[best] -= taken
        spent[best] += cost(taken, linear, quadratic)
    return placed


def fragments(
    docs: DataFrame, tokenizer_path: str, id_column: str, text_column: str, sequence_tokens: int, end_id: int
) -> DataFrame:
    """Whole sequences of long documents, and what is left of every document with its token ids."""
    end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * sequence_tokens
    kinds = (*[pa.int64()] * 6, pa.binary())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in slices(batches):
            out: list[tuple] = []
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for doc, at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encode(texts)):
                ids += end
                tokens = len(ids) // 4
                for k in range(0, len(ids), step):
                    part = ids[k : k + step]
                    whole = len(part) == step
                    crc = zlib.crc32(part) if whole else None
                    out.append((doc, at, tokens, k // 4, len(part) // 4, crc, None if whole else part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                names=["doc_id", "at", "doc_tokens", "start", "length", "ids_crc32", "ids"],
            )

    source = docs.select(
        col(id_column).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("at"), col(text_column).alias("t")
    )
    return source.mapInArrow(cut, _FRAGMENTS)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = 1,
    linear: int = LINEAR_COST,
    quadratic: int = QUADRATIC_COST,
    docs_per_group: int = DOCS_PER_GROUP,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost) of all pieces of ``docs``.

    A document is its token ids and ``end_id``; null and empty texts are that id alone.
    Repeated rows and rows without an id are documents of their own, equal lengths are
    packed by the order of rows, other columns are not read, an empty table gives none.
    Documents are dealt to groups by a hash of their place in the table, so that neither
    copies nor long documents fill one: whole sequences of a long document need no packing
    and travel without their ids. A group holds at most ``docs_per_group`` rests on average.
    """
    groups = partitions_for(docs.count(), docs_per_group, most=1 << 30)

    def place(group: pa.Table) -> pa.Table:
        number = group.column("_group")[0].as_py()
        group = group.sort_by([("at", "ascending"), ("start", "ascending")])
        rows = {n: group.column(n).to_pylist() for n in ("doc_id", "doc_tokens", "start", "length", "ids_crc32")}
        rests = [k for k, crc in enumerate(rows["ids_crc32"]) if crc is None]
        ids = group.column("ids")
        out, last = [], -1
        for k, start, length, sequence, offset in assign(
            [rows["length"][k] for k in rests], sequence_tokens, linear, quadratic
        ):
            k = rests[k]
            crc = zlib.crc32(memoryview(ids[k].as_buffer())[4 * start : 4 * (start + length)])
            out.append((rows["doc_id"][k], rows["start"][k] + start, length, crc, rows["doc_tokens"][k], sequence, offset))
            last = max(last, sequence)
        for k, crc in enumerate(rows["ids_crc32"]):
            if crc is not None:
                last += 1
                out.append((rows["doc_id"][k], rows["start"][k], rows["length"][k], crc, rows["doc_tokens"][k], last, 0))
        columns = [pa.array(x, pa.int64()) for x in zip(*out)]
        columns[5] = pa.array([number << 32 | x[5] for x in out], pa.int64())
        columns.append(pa.array([cost(x[2], linear, quadratic) for x in out], pa.int64()))
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"]
        return pa.Table.from_arrays(columns, names=names)

    made = fragments(docs, tokenizer_path, id_column, text_column, sequence_tokens, end_id)
    dealt = made.withColumn("_group", F.pmod(F.xxhash64("at"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(place, _PACKED)
