"""Benchmark decontamination by random-walk embedding.

A window of a document matches a benchmark item if few word edits turn one into the
other. The random-walk (CGK) embedding reads both strings with one shared random walk:
at step j it writes the word under the pointer and moves on by one word or none, as a
random bit of (j, word) says. Strings a few edits apart fall into step again after each
edit, so their embeddings differ in few places (Hamming distance). Bit sampling finds
such pairs: a hash of a few sampled places of the embedding is equal with a probability
that can be measured, and it is repeated with other walks until the wanted recall is
reached. Longer items need more walks, so these are counted for each number of allowed edits.
Items that the most walks do not serve are sought exactly, by the word pairs that a match
must keep. Every candidate is verified by its exact edit distance.

Windows begin at every word of a document and are as long as the item needs. Before any
walk, a window is passed over if too few of its word pairs occur in items of its size: an
edit undoes two pairs at most, so a match must keep the others, and nothing is lost by this.
"""

from __future__ import annotations

import copy
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import col, map_text, slices, text_hash, unused_name

#: word edits in proportion to the item's words: a similarity of 0.8 or more
MAX_EDITS = 0.2
#: the share of matches at the very edge of the allowed edits that the hashes must meet
TARGET_RECALL = 0.98
#: places of an embedding that one hash samples
SAMPLED_PLACES = 3
#: repetitions are added until the target is met, simulated on edited items; items that so many do not serve are sought exactly
MOST_REPETITIONS = 256
#: longer items are sought exactly: their walks cost more than counting word pairs does
WALKED_WORDS = 256
#: items with fewer words are not sought; those under five allow no edit, so they are met word by word
LEAST_WORDS = 1
#: items are held by each task in blocks of at most so many words; with more items there are more blocks
BLOCK_WORDS = 500_000

#: windows that walk at once
_WINDOWS = 256
#: walks that a simulation tries at once
_TRIED = 32

#: what is neither a word's nor plain text's counts as a gap between words
_ODD = re.compile(r"[^\w\x00-\x7f]+")
#: letters of scripts without spaces are words of their own: Thai to Lao, Burmese, Khmer, kana and Han
_ALONE = re.compile("([\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
#: bytes of a text whose words are coded at once
_TEXT_BLOCK = (1 << 20) - 1

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so powers can be undone
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_IN_WORD = np.array([i >= 128 or chr(i).isalnum() or chr(i) == "_" for i in range(256)])
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _MULTIPLIER, dtype=np.uint64), np.full(n, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_codes(text: str | None) -> np.ndarray:
    """A 64-bit code for each word; words are runs of letters, digits and underscores, in lower case.

    A letter of a script without spaces is a word. The code is a polynomial in the word's bytes, taken for
    all words of a block at once from running sums; a word that goes over a block's end goes on in the next.
    """
    text = (text or "").lower()
    if not text.isascii():
        text = _ODD.sub(" ", _ALONE.sub(r" \1 ", text))
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    found, carried, length = [np.zeros(0, dtype=np.uint64)], np.uint64(0), 0
    for at in range(0, len(raw), _TEXT_BLOCK):
        part = raw[at : at + _TEXT_BLOCK]
        edge = np.flatnonzero(np.diff(_IN_WORD[part], prepend=False, append=False))
        begin, end = edge[::2], edge[1::2]
        goes_on = bool(length and len(begin) and begin[0] == 0)
        if length and not goes_on:
            found.append(np.array([carried]))
            length = 0
        if not len(begin):
            continue
        up, down = _powers(1 << max(16, len(part).bit_length()))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
        code = (total[end] - total[begin]) * down[begin]
        if goes_on:
            code[0] = np.uint64((int(carried) + int(code[0]) * pow(_MULTIPLIER, length, 1 << 64)) % (1 << 64))
        if end[-1] == len(part):  # it may go on
            length = int(end[-1] - begin[-1]) + (length if goes_on and len(begin) == 1 else 0)
            carried, code = code[-1], code[:-1]
        else:
            length = 0
        found.append(code)
    if length:
        found.append(np.array([carried]))
    code = np.concatenate(found)
    code ^= code >> np.uint64(32)
    return code * np.uint64(_MULTIPLIER) | np.uint64(1)


def pair_codes(codes: np.ndarray) -> np.ndarray:
    mixed = codes[:-1] * np.uint64(0xD6E8FEB86659FD93) + codes[1:]
    return mixed ^ (mixed >> np.uint64(29))


def allowed_edits(n_words: int, max_edits: float = MAX_EDITS) -> int:
    return int(max_edits * n_words + 1e-9)


class Walks:
    """Shared random walks and the places that each of them samples."""

    def __init__(self, repetitions: int, longest: int, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.repetitions = repetitions
        self.places = np.sort(draw.random((MOST_REPETITIONS, SAMPLED_PLACES)), axis=1)[:repetitions]
        self.seeds = draw.integers(1, 1 << 63, size=MOST_REPETITIONS, dtype=np.uint64)[:repetitions, None]
        #: by step and walk a multiplier; its product with a word's code has the random bit on top
        odd = draw.integers(1, 1 << 63, size=(2 * longest, MOST_REPETITIONS), dtype=np.uint64) * np.uint64(2)
        self.random = odd[:, :repetitions, None] + np.uint64(1)

    def part(self, first: int, end: int) -> Walks:
        """Some of these walks."""
        some = copy.copy(self)
        some.places, some.seeds, some.random = self.places[first:end], self.seeds[first:end], self.random[:, first:end]
        some.repetitions = len(some.places)
        return some

    def keys(self, codes: np.ndarray, starts: np.ndarray, n_words: int) -> np.ndarray:
        """By walk and window a hash of the sampled places, for windows of ``n_words`` at ``starts``.

        A walk moves on at every other step on average, so it has read about all words after
        two steps for each; places are drawn from these.
        """
        if len(starts) > _WINDOWS:
            parts = [self.keys(codes, starts[k : k + _WINDOWS], n_words) for k in range(0, len(starts), _WINDOWS)]
            return np.concatenate(parts, axis=1)
        steps, m = 2 * n_words, len(starts)
        # each window ends with a zero, at which a walk writes nothing and stays
        places = starts[:, None] + np.arange(n_words + 1)
        inside = (places < len(codes)) & (np.arange(n_words + 1) < n_words)
        words = np.where(inside, codes[np.minimum(places, len(codes) - 1)], np.uint64(0)).ravel()
        at = np.repeat(np.arange(m)[None, :] * (n_words + 1), self.repetitions, axis=0)
        written = np.empty((steps, *at.shape), dtype=np.uint64)
        bit = np.empty(at.shape, dtype=np.uint64)
        for j in range(steps):
            np.take(words, at, out=written[j])
            np.multiply(written[j], self.random[j], out=bit)
            np.right_shift(bit, np.uint64(63), out=bit)
            at += bit.view(np.int64)
        key = np.repeat(self.seeds, len(starts), axis=1)
        places = np.minimum((self.places * steps).astype(np.int64), steps - 1)
        for k in range(SAMPLED_PLACES):
            word = written[places[:, k], np.arange(self.repetitions)]
            key = (key ^ word) * np.uint64(_MULTIPLIER)
            key ^= key >> np.uint64(29)
        return key


def edit_distance_within(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the stretch of ``text`` nearest to ``item``; None if it is over ``most``.

    The whole item against any stretch of the text: the first row of the table is zero.
    Of equally near stretches the one that ends first, and of these the longest start, is taken.
    """
    n = len(text)
    row, start = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for i, word in enumerate(item.tolist(), 1):
        swap = row[:-1] + (text != word)
        drop = row[1:] + 1
        best = np.empty(n + 1, dtype=np.int64)
        origin = np.empty(n + 1, dtype=np.int64)
        best[0], origin[0] = i, 0
        take = swap <= drop
        best[1:] = np.where(take, swap, drop)
        origin[1:] = np.where(take, start[:-1], start[1:])
        # insertions run along the row: a running minimum of best - column
        shifted = best - steps
        least = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == least, steps, 0))
        row, start = least + steps, origin[source]
    end = int(np.argmin(row))
    if row[end] > most:
        return None
    return int(row[end]), int(start[end]), end


@dataclass(frozen=True)
class ItemBlock:
    """Some items as word codes."""

    ids: tuple[int, ...]
    codes: tuple[np.ndarray, ...]


class Index:
    """What a task needs to search texts for one block of items."""

    def __init__(self, block: ItemBlock, max_edits: float, repetitions: dict[int, int]):
        """``repetitions`` by allowed edits; items without an entry are sought exactly."""
        self.block, self.max_edits = block, max_edits
        self.by_size: dict[int, list[int]] = defaultdict(list)
        for k, codes in enumerate(block.codes):
            self.by_size[len(codes)].append(k)
        self._sizes = np.array(sorted(self.by_size), dtype=np.int64)
        self._pairs_needed = np.array([self._needed(n) for n in self._sizes.tolist()], dtype=np.int64)
        self.least_pairs = int(self._pairs_needed.min()) if len(self._sizes) else 0
        #: by word pair the sizes of the items that have it; sizes 64 apart share a bit, a few pairs an entry
        pairs = [pair_codes(c) for c in block.codes]
        self.mask = np.uint64((1 << max(16, 6 + sum(map(len, pairs)).bit_length())) - 1)
        self.pairs = np.zeros(int(self.mask) + 1, dtype=np.uint64)
        for found in pairs:
            self.pairs[found & self.mask] |= self._bit(len(found) + 1)
        served = {size: repetitions.get(allowed_edits(size, max_edits), 0) for size in self.by_size}
        walked = [size for size, n in served.items() if n]
        walks = Walks(max(served.values()), max(walked)) if walked else None
        #: by item size the walks; without them items are sought exactly
        self.walks = {size: walks.part(0, served[size]) for size in walked}
        #: for each item size the sorted keys of all walks, or else word pairs, and their items
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, items in self.by_size.items():
            if size in self.walks:
                flat = np.concatenate([block.codes[k] for k in items])
                keys = self.walks[size].keys(flat, np.arange(len(items)) * size, size).ravel()
                owners = np.tile(np.array(items), served[size])
            else:
                own = [np.unique(pairs[k]) for k in items]
                keys, owners = np.concatenate(own), np.repeat(np.array(items), [len(p) for p in own])
            order = np.argsort(keys, kind="stable")
            self.tables[size] = (keys[order], owners[order])

    @staticmethod
    def _bit(size: int) -> np.uint64:
        return np.uint64(1 << size % 64)

    def _needed(self, size: int) -> int:
        """Pairs of an item of this size that are left in every match."""
        return size - 1 - 2 * allowed_edits(size, self.max_edits)

    def windows(self, known: np.ndarray, size: int) -> np.ndarray:
        """Starts of the windows with enough pairs; ``known`` tells which pairs of the text items of this size have."""
        starts = np.arange(len(known) + 1)
        total = np.concatenate([[0], np.cumsum(known)])
        ends = np.minimum(starts + size + allowed_edits(size, self.max_edits) - 1, len(known))
        return starts[total[ends] - total >= self._needed(size)]

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, edits, first word, end word): the nearest stretch of each item that the text contains."""
        return self.search_codes(word_codes(text))

    def search_codes(self, own: np.ndarray) -> list[tuple[int, int, int, int]]:
        if not len(own) or not len(self._sizes):
            return []
        marks = self.pairs[pair_codes(own) & self.mask]
        some = marks[marks != 0]
        if len(some) < self.least_pairs:
            return []
        counts = np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
        best: dict[int, tuple[int, int, int]] = {}
        for size in self._sizes[counts[self._sizes % 64] >= self._pairs_needed].tolist():
            most = allowed_edits(size, self.max_edits)
            starts = self.windows(marks & self._bit(size) != 0, size)
            if not len(starts):
                continue
            met = self._by_walks(own, starts, size) if size in self.walks else self._by_pairs(own, starts, size)
            for k, stretch in _stretches(met, size, most, len(own)):
                found = edit_distance_within(self.block.codes[k], own[stretch], most)
                if found:
                    hit = (found[0], found[1] + stretch.start, found[2] + stretch.start)
                    if k not in best or hit < best[k]:
                        best[k] = hit
        return [(self.block.ids[k], *hit) for k, hit in sorted(best.items())]

    def _by_walks(self, own: np.ndarray, starts: np.ndarray, size: int) -> set[tuple[int, int]]:
        """(item, start) of the windows that a walk brings together with an item."""
        keys, items = self.tables[size]
        found = self.walks[size].keys(own, starts, size)
        low, high = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
        return {
            (int(k), int(starts[w]))
            for r, w in np.argwhere(high > low).tolist()
            for k in items[low[r, w] : high[r, w]].tolist()
        }

    def _by_pairs(self, own: np.ndarray, starts: np.ndarray, size: int) -> set[tuple[int, int]]:
        """(item, start) around all stretches that have as many of the item's pairs as every match has."""
        needed, widest = self._needed(size), size + allowed_edits(size, self.max_edits) - 1
        if needed <= 0:  # pairs rule nothing out
            return {(k, s) for k in self.by_size[size] for s in starts.tolist()}
        keys, items = self.tables[size]
        pairs = pair_codes(own)
        low, high = np.searchsorted(keys, pairs, "left"), np.searchsorted(keys, pairs, "right")
        places: dict[int, list[int]] = defaultdict(list)
        for at in np.flatnonzero(high > low).tolist():
            for k in items[low[at] : high[at]].tolist():
                places[k].append(at)
        met = set()
        for k, found in places.items():
            at = np.array(found)
            first, last = at[: len(at) - needed + 1], at[needed - 1 :]
            near = last - first < widest
            # a match begins between these two
            met.update((k, s) for s in first[near].tolist())
            met.update((k, max(0, s - widest + 1)) for s in last[near].tolist())
        return met


def _stretches(met: set[tuple[int, int]], size: int, most: int, n: int) -> Iterator[tuple[int, slice]]:
    """(item, stretch of the text around its candidate windows), windows that overlap taken together."""
    by_item: dict[int, list[int]] = defaultdict(list)
    for k, start in met:
        by_item[k].append(start)
    for k, starts in by_item.items():
        begin = end = None
        for s in sorted(starts):
            low, high = max(0, s - most), min(n, s + size + 2 * most)
            if begin is None or low > end:
                if begin is not None:
                    yield k, slice(begin, end)
                begin = low
            end = high
        yield k, slice(begin, end)


def repetitions_needed(block: ItemBlock, max_edits: float, target: float, trials: int = 200, seed: int = 5) -> dict[int, int]:
    """By allowed edits the repetitions that meet ``target`` on items edited as much as is allowed, at random places.

    Of the items with the same allowed edits the shortest are the hardest to meet, so all are cut to
    their size. What ``MOST_REPETITIONS`` do not serve has no entry.
    """
    bands: dict[int, list[np.ndarray]] = defaultdict(list)
    for codes in block.codes:
        bands[allowed_edits(len(codes), max_edits)].append(codes)
    walked = {edits: items for edits, items in bands.items() if max(map(len, items)) <= WALKED_WORDS}
    if not walked:
        return {}
    walks = Walks(MOST_REPETITIONS, max(len(c) for items in walked.values() for c in items))
    needed = {}
    for edits, items in walked.items():
        if not edits:  # equal words have equal keys
            needed[edits] = 1
            continue
        size, draw = min(map(len, items)), np.random.default_rng(seed)
        first = meetings(items, size, edits, walks, trials, math.ceil(target * trials), draw)
        if first is not None:
            needed[edits] = first
    return needed


def meetings(
    items: list[np.ndarray], size: int, edits: int, walks: Walks, trials: int, wanted: int, draw: np.random.Generator
) -> int | None:
    """After how many walks ``wanted`` of the trials have met; None if all walks are too few."""
    left = []
    for _ in range(trials):
        item = items[int(draw.integers(len(items)))][:size]
        left.append((item, np.append(edit(item, edits, draw), np.full(size, 1, dtype=np.uint64))))
    met: list[int] = []
    for begin in range(0, walks.repetitions, _TRIED):
        some, still = walks.part(begin, begin + _TRIED), []
        for item, text in left:
            own = some.keys(item, np.zeros(1, dtype=np.int64), size)
            meets = (own == some.keys(text, np.arange(edits + 1), size)).any(axis=1)
            if meets.any():
                met.append(begin + int(np.argmax(meets)) + 1)
            else:
                still.append((item, text))
        left = still
        if len(met) >= wanted:
            return sorted(met)[wanted - 1]
    return None


def edit(codes: np.ndarray, edits: int, draw: np.random.Generator) -> np.ndarray:
    """``codes`` after so many random replacements, insertions and deletions of words."""
    out = codes.tolist()
    for _ in range(edits):
        kind, at = int(draw.integers(3)), int(draw.integers(len(out))) if out else 0
        new = int(draw.integers(1, 1 << 63)) | 1
        if kind == 0 and out:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        elif out:
            del out[at]
    return np.array(out, dtype=np.uint64)


def item_blocks(items: DataFrame, id_column: str = "item_id", text_column: str = "text", least_words: int = LEAST_WORDS) -> Iterator[ItemBlock]:
    """The items with enough words, a bounded block at a time."""
    ids, codes, words = [], [], 0
    rows = items.select(col(id_column).cast("long"), col(text_column)).orderBy(col(id_column), col(text_column))
    for doc, text in rows.toLocalIterator():
        own = word_codes(text)
        if len(own) < least_words:
            continue
        ids.append(doc)
        codes.append(own)
        words += len(own)
        if words >= BLOCK_WORDS:
            yield ItemBlock(tuple(ids), tuple(codes))
            ids, codes, words = [], [], 0
    if ids:
        yield ItemBlock(tuple(ids), tuple(codes))


_indexes: dict[int, Index] = {}


class Searcher:
    """A block of items with its walks; the index is built once in each worker process."""

    def __init__(self, block: ItemBlock, max_edits: float, target_recall: float):
        self.block, self.max_edits = block, max_edits
        self.repetitions = repetitions_needed(block, max_edits, target_recall)
        self.key = hash((block.ids, max_edits, tuple(sorted(self.repetitions.items())), sum(int(c.sum()) for c in block.codes)))

    def index(self) -> Index:
        if self.key not in _indexes:
            _indexes.clear()
            _indexes[self.key] = Index(self.block, self.max_edits, self.repetitions)
        return _indexes[self.key]

    def hits(self, text: str | None) -> list[tuple[int, int, int, int]]:
        return self.index().search(text)


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_edits: float = MAX_EDITS,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """(id, text_hash, item_id, edits, item_words, first_word, end_word): each item found in each document.

    Words are lower-cased runs of letters, digits and underscores, and single letters of scripts without
    spaces. One row for a document and an item, for the stretch with the fewest edits; items under five
    words allow none. Null and empty texts hold no item, and items without a word are not sought; rows repeat
    as often as documents do, with and without an id; equal items have rows of their own; empty tables
    give none; other columns are not read. Texts of any length are searched whole.
    """
    found = None
    for block in item_blocks(items):
        searcher = Searcher(block, max_edits, target_recall)
        sizes = {i: len(c) for i, c in zip(block.ids, block.codes)}

        def search(batches: Iterator[pa.RecordBatch], searcher=searcher, sizes=sizes) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                out = [
                    (doc, mark, item, edits, sizes[item], first, end)
                    for doc, mark, text in zip(*[c.to_pylist() for c in batch.columns])
                    for item, edits, first, end in searcher.hits(text)
                ]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _HIT)], schema=_HIT)

        source = docs.select(
            col(id_column).cast("long").alias("id"), text_hash(text_column).alias("text_hash"), col(text_column).alias("t")
        )
        part = source.mapInArrow(search, _HITS)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], _HITS) if found is None else found


_HITS = "id long, text_hash long, item_id long, edits int, item_words int, first_word int, end_word int"
_HIT = pa.schema(
    [
        ("id", pa.int64()),
        ("text_hash", pa.int64()),
        ("item_id", pa.int64()),
        ("edits", pa.int32()),
        ("item_words", pa.int32()),
        ("first_word", pa.int32()),
        ("end_word", pa.int32()),
    ]
)


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    max_edits: float = MAX_EDITS,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """The rows of ``docs`` in whose texts no item is found, with all their columns.

    Null and empty texts stay, copies stay or go together, and without items all rows stay.
    """
    kept = docs
    for block in item_blocks(items):
        searcher = Searcher(block, max_edits, target_recall)

        def judge(texts: list[str | None], searcher=searcher) -> list[pa.Array]:
            return [pa.array([bool(searcher.hits(t)) for t in texts], pa.bool_())]

        marker = unused_name(docs, "_contaminated")
        kept = map_text(kept, text_column, f"{marker} boolean", judge).filter(~F.col(marker)).drop(marker)
    return kept
