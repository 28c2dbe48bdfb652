"""Spelling variants: words one edit apart, each led to a far more frequent neighbour.

The edits of every word are generated as hashes and probed against Bloom filters of the
vocabulary. A word generates its deletions and those replacements that put a later letter in,
so that each pair of near words is found from exactly one of its two words: the longer one, or
the one with the earlier letter. Only edits that a filter has seen become strings; they
meet the vocabulary in a join on the whole word, which removes the filter's errors.

Every length has a filter of its own, cut into blocks of 512 bits; a word sets one bit in each
of the eight 64-bit parts of one block. The filters of a round take ``FILTER_BYTES`` at most. A
vocabulary with larger filters is probed in rounds over ranges of their blocks, so that what is
broadcast does not grow with the corpus; nothing is left out.

Hashes of edits are polynomials modulo 2**64: an edit changes the hash of its word by one term,
or by what stands behind a deleted letter, so a word of any length costs the same for each edit.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import col, partitions_for, slices
from siltworks.session import stage

#: letters A to Z are lower-cased before, so that these are all the letters of words
RUN = "[a-zÀ-ÿ]"
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.uint64)
LEAST_LETTERS, LEAST_OCCURRENCES, TIMES_MORE = 7, 2, 10
#: one occurrence in so many, by a checksum, loses a letter; 0 for none
MISSPELT = 31

#: bytes of filters that are broadcast at once
FILTER_BYTES = 32 << 20
_PARTS = 8
_BLOCK_BYTES = 8 * _PARTS
#: words that a task counts before it hands its counts on
COUNTED_WORDS = 200_000
#: words whose edits one task probes, on average
WORDS_PER_TASK = 1 << 15
#: letters of words, or of a stretch of one very long word, that are edited at once
EDITED_LETTERS = 1 << 20

_WORD_COUNTS = "word string, n long"


def _count_words(least: int, misspelt: int):
    runs = re.compile(f"{RUN}{{{least},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])
            n.clear()
            return batch

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # bytes have no case but that of ASCII letters
                found = runs.findall(text.encode().lower().decode()) if text else ()
                if not misspelt:
                    n.update(found)
                    continue
                before = zlib.crc32(f"{doc if doc is not None else ''}:".encode())
                for word, times in Counter(found).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % misspelt == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    n[word] += times
            if len(n) >= COUNTED_WORDS:
                yield made()
        yield made()

    return counted


def vocabulary(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_occurrences: int = LEAST_OCCURRENCES,
    misspelt: int = MISSPELT,
) -> DataFrame:
    """(word, n) of all words of the texts that are long and frequent enough.

    Counts are summed in every task before the shuffle. Null and empty texts have no words; an
    id that is null counts as empty in the checksum.
    """
    source = docs.select(col(id_column).cast("string"), col(text_column))
    counts = source.mapInArrow(_count_words(least_letters, misspelt), _WORD_COUNTS)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_occurrences)


# ---- hashes of words and their edits ---------------------------------------------

# Odd, so that powers have inverses modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _powers(length: int) -> np.ndarray:
    steps = np.full(length, _BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _mixed(h: np.ndarray) -> np.ndarray:
    """All bits of a hash spread over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, mixed hash whose lower 48 bits choose a bit in each part of the block)."""
    mixed = _mixed(h)
    block = (mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    return block.astype(np.int64), _mixed(mixed)


def _letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def _hashes(letters: np.ndarray) -> np.ndarray:
    return (letters.astype(np.uint64) * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        found.setdefault(len(w), []).append(k)
    return found


# ---- filters ---------------------------------------------------------------------


class Span(NamedTuple):
    """Blocks ``begin`` to ``end`` of the filter for words of one length, which has ``blocks`` in all."""

    length: int
    blocks: int
    begin: int
    end: int


def _bits_per_word(length: int) -> int:
    """Enough for few false hits among all edits of a word, whatever its length."""
    return math.ceil(2 * math.log2(length * len(LETTERS)))


def rounds_of(words_by_length: dict[int, int], filter_bytes: int = FILTER_BYTES) -> list[list[Span]]:
    """The filters' blocks in the order of lengths, dealt to rounds of at most ``filter_bytes``."""
    rounds: list[list[Span]] = [[]]
    most = max(1, filter_bytes // _BLOCK_BYTES)
    left = most
    for length, words in sorted(words_by_length.items()):
        blocks = -(-words * _bits_per_word(length) // (8 * _BLOCK_BYTES))
        begin = 0
        while begin < blocks:
            if not left:
                rounds.append([])
                left = most
            end = min(blocks, begin + left)
            rounds[-1].append(Span(length, blocks, begin, end))
            left -= end - begin
            begin = end
    return rounds


def _filters(words: DataFrame, spans: list[Span]) -> dict[int, tuple[Span, np.ndarray]]:
    """The blocks of a round by word length. They reach the driver, FILTER_BYTES at most."""
    by_length = {s.length: s for s in spans}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 13):
            own = batch.column(0).to_pylist()
            for length, at in _by_length(own).items():
                span = by_length[length]
                block, bits = _places(_hashes(_letters([own[k] for k in at])), span.blocks)
                held = (block >= span.begin) & (block < span.end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(int(held.sum()), length), pa.int32()),
                        pa.array(block[held], pa.int64()),
                        pa.array(bits[held].view(np.int64), pa.int64()),
                    ],
                    names=["length", "block", "bits"],
                )

    wanted = words.filter(F.length("word").isin(list(by_length))).select("word")
    parts = [F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftright(bits, {6 * p}) & 63 AS INT))")).alias(f"p{p}") for p in range(_PARTS)]
    made = wanted.mapInArrow(placed, "length int, block long, bits long").groupBy("length", "block").agg(*parts).toArrow()
    lengths, blocks = (made.column(c).to_numpy() for c in ("length", "block"))
    parts = np.stack([made.column(f"p{p}").to_numpy() for p in range(_PARTS)], axis=1).view(np.uint64)
    found = {}
    for s in spans:
        bits = np.zeros((s.end - s.begin, _PARTS), dtype=np.uint64)
        own = lengths == s.length
        bits[blocks[own] - s.begin] = parts[own]
        found[s.length] = (s, bits)
    return found


def _seen(h: np.ndarray, span: Span, filled: np.ndarray) -> np.ndarray:
    """Positions of the hashes that the blocks of a span may hold."""
    block, bits = _places(h, span.blocks)
    at = np.flatnonzero((block >= span.begin) & (block < span.end))
    block, bits = block[at] - span.begin, bits[at]
    for p in range(_PARTS):
        hit = filled[block, p] >> ((bits >> np.uint64(6 * p)) & np.uint64(63)) & np.uint64(1) == 1
        at, block, bits = at[hit], block[hit], bits[hit]
        if not len(at):
            break
    return at


def _edited(letters: np.ndarray, filters: dict[int, tuple[Span, np.ndarray]], alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(word, position, letter put in or 0) of the edits of words of one length that a filter may hold."""
    n, length = letters.shape
    shorter, same = filters.get(length - 1), filters.get(length)
    powers = _powers(length)
    terms = letters * powers
    total = terms.sum(axis=1, dtype=np.uint64)
    before = np.zeros(n, dtype=np.uint64)
    step = max(1, EDITED_LETTERS // n)
    for begin in range(0, length, step):
        end = min(length, begin + step)
        here, own = letters[:, begin:end], terms[:, begin:end]
        if shorter:
            through = before[:, None] + np.add.accumulate(own, axis=1)
            h = through - own + (total[:, None] - through) * _BASE_INVERSE
            before = through[:, -1]
            # of equal letters in a row only the last one is deleted
            following = np.zeros_like(here)
            following[:, : length - 1 - begin] = letters[:, begin + 1 : end + 1]
            word, at = np.nonzero(here != following)
            hit = _seen(h[word, at], *shorter)
            yield word[hit], at[hit] + begin, np.zeros(len(hit), dtype=np.int64)
        if same:
            for letter in alphabet:
                word, at = np.nonzero(here < letter)
                if not len(word):
                    continue
                h = total[word] + (letter - here[word, at]) * powers[at + begin]
                hit = _seen(h, *same)
                yield word[hit], at[hit] + begin, np.full(len(hit), letter, dtype=np.int64)


def _candidates(words: DataFrame, filters: dict[int, tuple[Span, np.ndarray]], alphabet: list[int], tasks: int) -> DataFrame:
    """(candidate, word, n): edits of words that the filters of a round may hold."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(filters)
    lengths = sorted({x for length in filters for x in (length, length + 1)})

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, put = sent.value, np.array(alphabet, dtype=np.uint64)
        for batch in slices(batches, 1 << 13):
            own = batch.column(0).to_pylist()
            for length, at in _by_length(own).items():
                step = max(1, EDITED_LETTERS // length)
                for k in range(0, len(at), step):
                    some = at[k : k + step]
                    letters = _letters([own[x] for x in some]).astype(np.uint64)
                    for word, place, letter in _edited(letters, held, put):
                        rows = [some[x] for x in word.tolist()]
                        made = [
                            own[r][:p] + (chr(c) if c else "") + own[r][p + 1 :]
                            for r, p, c in zip(rows, place.tolist(), letter.tolist())
                        ]
                        if made:
                            source = batch.take(pa.array(rows, pa.int64()))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(made, pa.string()), *source.columns], names=["candidate", "word", "n"]
                            )

    wanted = words.filter(F.length("word").isin(lengths)).select("word", "n")
    # a small table, but much work for each word
    return wanted.repartition(tasks, "word").mapInArrow(probed, "candidate string, word string, n long")


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, other, other_n): every pair of ``words`` (word, n) one edit apart, once.

    ``words`` should be a written table of distinct words of the letters of ``RUN``: it is read
    twice in a round, and once before for its letters and lengths.
    """
    per_length = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()
    # as many rows as there are letters
    used = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    alphabet = sorted(ord(r["c"]) for r in used if r["c"])
    found, n = None, {r["length"]: r["words"] for r in per_length}
    for spans in rounds_of(n, filter_bytes):
        if not spans:
            continue
        edited = sum(n.get(x, 0) for x in {x for s in spans for x in (s.length, s.length + 1)})
        tasks = partitions_for(edited, WORDS_PER_TASK)
        hits = stage(_candidates(words, _filters(words, spans), alphabet, tasks), "spelling_candidates")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        none = words.limit(0)
        return none.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n"))
    exact = words.select(F.col("word").alias("candidate"), F.col("n").alias("other_n"))
    return found.join(exact, "candidate").select("word", "n", F.col("candidate").alias("other"), "other_n")


def forms(words: DataFrame, times_more: int = TIMES_MORE, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, n_near, form, form_n): each word's near words and the form it stands for, if any.

    The form is the near word that occurs most often, of equally frequent ones the first by code
    points, if it occurs at least ``times_more`` times as often as the word.
    """
    pairs = stage(near_pairs(words, filter_bytes), "near_words")
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    first = F.min(F.struct((-F.col("other_n")).alias("rank"), "other"))
    near = pairs.unionByName(back).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("first"))
    joined = words.join(near, "word", "left")
    leads = -F.col("first.rank") >= times_more * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(leads, F.col("first.other")).alias("form"),
        F.when(leads, -F.col("first.rank")).alias("form_n"),
    )


def with_root(formed: DataFrame) -> DataFrame:
    """``formed`` (see :func:`forms`) with the last word that forms lead to; the word itself without a form.

    Each round every open chain doubles what it has behind it; as each form is many times more
    frequent, chains are short and five rounds are enough for any count of words.
    """
    chains = stage(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(chains.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "roots")
        chains = moved.select("word", "root")
        if moved.filter("open").isEmpty():
            break
    return formed.join(chains, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_occurrences: int = LEAST_OCCURRENCES,
    times_more: int = TIMES_MORE,
    misspelt: int = MISSPELT,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``.

    Null and empty texts have no words; repeated rows count as often as they occur; very long
    texts and words are read whole; other columns are not read; an empty table gives none. Ties
    are settled by code points, so that results do not depend on the order of rows.
    """
    words = stage(vocabulary(docs, id_column, text_column, least_letters, least_occurrences, misspelt), "vocabulary")
    found = stage(forms(words, times_more, filter_bytes), "forms")
    return with_root(found).select("word", "form", "root", "n", "n_near", "form_n")
