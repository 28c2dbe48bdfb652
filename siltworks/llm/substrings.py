"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text, and a chunk ends at white space where the
hash falls on a fixed pattern. Where no such place is near, as in scripts without spaces and in
packed code, a chunk ends behind any character where the hash falls on another pattern.
The hash sees only the last few bytes, so that equal passages are cut alike wherever they
stand; an insertion changes the chunks it touches and no others. Chunks are known by digest, and
a stretch of neighbouring chunks by the digest of theirs. A stretch that is just long enough is
repeated if a document with a smaller id holds the whole of it, or the same document does
further up; repeated stretches that overlap or touch are one repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from siltworks.llm.common import col, slices, text_hash
from siltworks.session import stage

#: words that a stretch held by one other document has at least; a passage of 50 words loses no more than
#: its two outer chunks, which are a few words each
MIN_RUN_WORDS = 20
#: of the hash, these bits are zero at the end of a chunk: one in four words
CUT_BITS = np.uint32(0x3 << 14)
#: two cuts are at least so far apart
LEAST_BYTES = 16
#: of the hash, these bits are zero where longer chunks are cut again, at any character
INNER_BITS = np.uint32(0x7 << 13)
#: longer chunks are cut again; what even then is longer is cut at this distance
MOST_BYTES = 96
#: a chunk counts as many words as begin in it, but one for so many bytes at least
BYTES_PER_WORD = 9
#: bytes that are hashed at once
_BLOCK = 1 << 20


def _gear() -> np.ndarray:
    """Random numbers for the 256 bytes, the same in every process."""
    return np.array([xxhash.xxh32_intdigest(bytes([i]), 7) for i in range(256)], dtype=np.uint32)


GEAR = _gear()
#: the highest bit looked at is bit 15, which the last 16 bytes decide
WINDOW = 16

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The low 16 bits of h = 2 h + gear[byte], at every byte."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:  # doubling: h over 2 x step bytes from two halves
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h = h + shifted
        step *= 2
    return h


def _apart(ends: np.ndarray) -> np.ndarray:
    """The places before which no other one lies within the least distance."""
    far = np.ones(len(ends), dtype=bool)
    far[1:] = np.diff(ends) >= LEAST_BYTES
    return ends[far]


def cuts(data: bytes) -> np.ndarray:
    """The ends of all chunks of a text; the last one is its length.

    A place ends a chunk if it follows white space, the hash of the window before it
    fits, and no such place lies within the least distance before it. Chunks that are too long
    are cut by the same rule with another pattern, behind any character. This depends on the
    neighbourhood only, never on where the text begins.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    found, inner = [], []
    for at in range(0, n, _BLOCK):
        lead = max(0, at - WINDOW)
        part = raw[lead : at + _BLOCK]
        h = gear_hash(part)[at - lead :]
        found.append(np.flatnonzero((h & CUT_BITS == 0) & _SPACE[part[at - lead :]]) + at + 1)
        # not inside a character: the next byte begins one
        following = np.append(raw[at + 1 : at + _BLOCK + 1], np.uint8(0))[: len(h)]
        inner.append(np.flatnonzero((h & INNER_BITS == 0) & (following & 0xC0 != 0x80)) + at + 1)
    ends = _apart(np.concatenate(found))
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    lengths = np.diff(ends, prepend=0)
    if lengths.max() > MOST_BYTES:
        more = _apart(np.concatenate(inner))
        chunk = np.minimum(np.searchsorted(ends, more, "left"), len(ends) - 1)
        behind, before = more - (ends - lengths)[chunk], ends[chunk] - more
        more = more[(lengths[chunk] > MOST_BYTES) & (behind >= LEAST_BYTES) & (before >= LEAST_BYTES)]
        ends = np.sort(np.concatenate([ends, more]))
        lengths = np.diff(ends, prepend=0)
    if lengths.max() > MOST_BYTES:
        extra = (lengths - 1) // MOST_BYTES
        begin = np.repeat(ends - lengths, extra)
        number = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        last = begin + number * MOST_BYTES
        # not inside a character: back to its first byte
        for _ in range(3):
            inside = (raw[last] & 0xC0) == 0x80
            last[inside] -= 1
        ends = np.sort(np.concatenate([ends, last]))
    return ends


def digests(data: bytes, ends: np.ndarray) -> np.ndarray:
    digest, view, at, out = xxhash.xxh3_64_intdigest, memoryview(data), 0, []
    for end in ends.tolist():
        out.append(digest(view[at:end]))
        at = end
    return np.array(out, dtype=np.uint64).view(np.int64)


def words_before(data: bytes, ends: np.ndarray) -> np.ndarray:
    """How many words the chunks hold up to each end.

    A chunk counts the words that begin in it, or its bytes by ``BYTES_PER_WORD`` if that is more,
    so that text without spaces has a length too. Equal chunks count alike wherever they stand.
    """
    space = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    begins = ~space
    begins[1:] &= space[:-1]
    # few words begin, so their places take less memory than a sum at every byte
    found = np.searchsorted(np.flatnonzero(begins), ends, "left")
    return np.cumsum(np.maximum(np.diff(found, prepend=0), np.diff(ends, prepend=0) // BYTES_PER_WORD))


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def repeated_runs(repeated: np.ndarray, ends: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(first byte, end, words) of each run of repeated chunks with enough words."""
    if not repeated.any():
        return []
    edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    begin = np.concatenate([[0], ends])[first]
    count = words[last] - np.concatenate([[0], words])[first]
    return [(int(b), int(ends[k]), int(c)) for b, k, c in zip(begin, last, count) if c >= min_words]


def stretches(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last chunk of the shortest stretches with enough words, from each chunk on and up to each one.

    Any longer stretch is covered by those within it. ``words`` are counted up to the end of each chunk.
    """
    n = len(words)
    before = np.concatenate([[0], words])[:n]
    at = np.arange(n)
    last = np.searchsorted(words, before + min_words, "left")
    first = np.searchsorted(before, words - min_words, "right") - 1
    on, up = last < n, first >= 0
    both = np.unique(np.concatenate([at[on] * n + last[on], first[up] * n + at[up]]))
    return both // max(n, 1), both % max(n, 1)


def stretch_digests(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    digest, view = xxhash.xxh3_64_intdigest, memoryview(own.tobytes())
    found = [digest(view[8 * a : 8 * b + 8]) for a, b in zip(first.tolist(), last.tolist())]
    return np.array(found, dtype=np.uint64).view(np.int64)


def chunks(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_run_words: int = MIN_RUN_WORDS
) -> DataFrame:
    """(id, text_hash, stretch digests, chunk ends in bytes, words before each end) of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, places, words = [], [], []
            for text in batch.column(2).to_pylist():
                data = _utf8(text or "")
                ends = cuts(data)
                places.append(ends)
                words.append(words_before(data, ends) if len(ends) else ends)
                found.append(stretch_digests(digests(data, ends), *stretches(words[-1], min_run_words)))
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x).astype(t))
                )
                for x, t in ((found, np.int64), (places, np.int32), (words, np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists], names=["id", "text_hash", "digests", "ends", "words"]
            )

    source = docs.select(
        col(id_column).cast("long").alias("id"), text_hash(text_column).alias("text_hash"), col(text_column).alias("t")
    )
    return source.mapInArrow(
        cut, "id long, text_hash long, digests array<long>, ends array<int>, words array<int>"
    )


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the list of each row begins, and the numbers of all lists."""
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _passages_of(own: np.ndarray, ends: np.ndarray, words: np.ndarray, hits: np.ndarray, first_ids: np.ndarray, doc: int, min_words: int):
    """(start, end, words, id that keeps it) of each passage of one text.

    ``hits`` are its stretches that an earlier document holds, ``first_ids`` which one.
    """
    order = np.argsort(hits)
    hits, first_ids = hits[order], first_ids[order]
    at = np.minimum(np.searchsorted(hits, own), max(len(hits) - 1, 0))
    elsewhere = hits[at] == own if len(hits) else np.zeros(len(own), dtype=bool)
    _, where, kind = np.unique(own, return_index=True, return_inverse=True)
    again = elsewhere | (where[kind] < np.arange(len(own)))
    if not again.any():
        return
    source = np.where(elsewhere, first_ids[at], doc)[again] if len(hits) else np.full(int(again.sum()), doc)
    begin, last = (x[again] for x in stretches(words, min_words))
    # how many repeated stretches a chunk is in
    change = np.bincount(begin, minlength=len(ends) + 1) - np.bincount(last + 1, minlength=len(ends) + 1)
    for start, end, count in repeated_runs(np.cumsum(change)[:-1] > 0, ends, words, min_words):
        inside = (ends[last] > start) & (ends[last] <= end)
        ids, n = np.unique(source[inside], return_counts=True)
        yield start, end, count, int(ids[n.argmax()])  # the smallest of those that keep most


#: stands for a row without an id; it is larger than all others
_NO_ID = (1 << 63) - 1


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_run_words: int = MIN_RUN_WORDS
) -> DataFrame:
    """(id, text_hash, again, start, end, words, kept_id): each repeated passage, in bytes of the UTF-8 text.

    Every part of a passage lies in a stretch of ``min_run_words`` that one document holds
    without a gap. ``kept_id`` is the document that keeps most of these stretches: of each, the
    smallest id that has it (the row itself for what stands further up in it). Rows that
    share an id are one document's versions: what they share stays in each of them.

    Each row without an id is a document of its own, behind all others and in the order of text
    hashes; of equal texts without an id one is first, and ``again`` marks the others, of which
    the first holds all. Null and empty texts have no passages, an empty table gives none, other
    columns are not read.
    """
    landed = stage(
        chunks(docs, id_column, text_column, min_run_words).withColumn("at", F.monotonically_increasing_id()), "chunks"
    )
    # the order of documents: by id, then those without one by their text
    k, rest = F.coalesce(F.col("id"), F.lit(_NO_ID)).alias("k"), F.when(F.col("id").isNull(), F.col("text_hash")).alias("rest")
    single = landed.select(k, rest, "text_hash", F.explode(F.array_distinct("digests")).alias("digest"))
    first = single.groupBy("digest").agg(
        F.min("k").alias("first"), F.max("k").alias("last"), F.min("rest").alias("first_rest"), F.max("rest").alias("last_rest")
    )
    # written and merged, so that the join reads both sides by exchanges and a hot stretch can be split; the files
    # are a tenth of what a broadcast would take
    shared = stage(first.filter("first < last OR first_rest < last_rest").drop("last", "last_rest"), "shared")
    hits = single.join(shared.hint("merge"), "digest").filter("k > first OR rest > first_rest").select("k", "text_hash", "digest", "first")
    # a text has at most its own stretches here
    per_text = (
        hits.groupBy("k", "text_hash").agg(F.collect_set(F.struct("digest", "first")).alias("hits"))
        .select("k", "text_hash", F.col("hits.digest").alias("hits"), F.col("hits.first").alias("firsts"))
    )
    no_id = landed.filter("id IS NULL")
    leading = no_id.groupBy("text_hash").agg(F.min("at").alias("leader"))
    rows = landed.filter("id IS NOT NULL").withColumn("again", F.lit(False)).unionByName(
        no_id.join(leading, "text_hash").withColumn("again", F.col("at") > F.col("leader")).drop("leader")
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            columns = [_rows_of(c) for c in batch.columns[3:]]
            for r, (doc, mark, again) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:3]])):
                own, ends, words, found, firsts = (values[at[r] : at[r + 1]] for at, values in columns)
                ends, words, key = ends.astype(np.int64), words.astype(np.int64), _NO_ID if doc is None else doc
                if again:
                    passages = [(*x, _NO_ID) for x in repeated_runs(np.ones(len(ends), dtype=bool), ends, words, min_run_words)]
                else:
                    passages = _passages_of(own, ends, words, found, firsts, key, min_run_words)
                out += [(doc, mark, again, *x, None if kept == _NO_ID else kept) for *x, kept in passages]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*out), _PASSAGE)], schema=_PASSAGE
                )

    # a text without a hit elsewhere may still repeat itself
    joined = rows.withColumn("k", k).join(per_text, ["k", "text_hash"], "left")
    candidates = joined.filter("again OR hits IS NOT NULL OR size(array_distinct(digests)) < size(digests)")
    none = F.expr("CAST(array() AS array<bigint>)")
    filled = [F.coalesce(c, none).alias(c) for c in ("hits", "firsts")]
    return candidates.select("id", "text_hash", "again", "digests", "ends", "words", *filled).mapInArrow(
        find, "id long, text_hash long, again boolean, start int, end int, words int, kept_id long"
    )


_PASSAGE = pa.schema(
    [
        ("id", pa.int64()),
        ("text_hash", pa.int64()),
        ("again", pa.bool_()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("words", pa.int32()),
        ("kept_id", pa.int64()),
    ]
)


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without some stretches of its UTF-8 bytes, which begin and end between characters."""
    data, at, kept = _utf8(text), 0, []
    for start, end in sorted(spans):
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def remove_passages(docs: DataFrame, passages: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the passages found in them; a text of which nothing but white space is left goes.

    All columns stay; ``n_chars``, if there is one, is counted again for texts that change. Of
    equal texts without an id the first row of ``docs``, which should be a written table, is
    the one that others repeat. Texts that were null or blank before stay.
    """
    spans = passages.groupBy("id", "text_hash", "again").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_column).cast("long").alias("id"),
        text_hash(text_column).alias("text_hash"), F.monotonically_increasing_id().alias("at"),
    )
    no_id = rows.filter("id IS NULL")
    leading = no_id.groupBy("text_hash").agg(F.min("at").alias("leader"))
    marked = rows.filter("id IS NOT NULL").withColumn("again", F.lit(False)).unionByName(
        no_id.join(leading, "text_hash").withColumn("again", F.col("at") > F.col("leader")).drop("leader")
    )
    spans = spans.select(F.col("id").alias("sid"), F.col("text_hash").alias("shash"), F.col("again").alias("sagain"), "spans")
    matching = F.col("id").eqNullSafe(F.col("sid")) & (F.col("text_hash") == F.col("shash")) & (F.col("again") == F.col("sagain"))
    joined = marked.join(spans, matching, "left")
    same = joined.select(F.col("row").getField(text_column).alias("t"), "row", "spans")

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [
                t if s is None else cut_out(t, [(x["start"], x["end"]) for x in s])
                for t, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), batch.column(1), batch.column(2).is_valid()], names=["t", "row", "changed"]
            )

    schema = T.StructType([same.schema["t"], same.schema["row"], T.StructField("changed", T.BooleanType())])
    out = same.mapInArrow(applied, schema).filter(~(F.col("changed") & (F.trim(F.regexp_replace("t", r"\s+", " ")) == "")))

    def column(name: str):
        old = F.col("row").getField(name)
        if name == text_column:
            return F.col("t").alias(name)
        if name == "n_chars":
            return F.when(F.col("changed"), F.length("t").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return out.select(*[column(c) for c in docs.columns])
