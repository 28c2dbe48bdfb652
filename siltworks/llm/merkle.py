"""Merkle tree fingerprints of documents.

The leaves of a document are its clauses, a paragraph is a line of them, a section a
run of paragraphs, and the root stands for all sections. Where a section ends is decided
by the paragraphs themselves (a blank line, or a digest that falls on a fixed residue),
so that an edit changes the branches above it and no others. Equal roots mean equal
texts; two trees are compared downwards, and only branches that differ are opened.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from siltworks.llm.common import col, partitions_for, slices
from siltworks.session import stage

#: a clause without an end is cut after so many characters
LEAF_CHARS = 48
#: a paragraph in so many ends a section
SECTION_PARAGRAPHS = 8

_LEAF = re.compile(r"[^.!?,;:\n]{0,%d}[.!?,;:]*[ \t\r]*\n*" % LEAF_CHARS)

#: rows of one key range when documents are put in order, and the most ranges
RANGE_ROWS = 512
MOST_RANGES = 1 << 16
#: keys from which the borders of the ranges are drawn
SAMPLE_KEYS = 1 << 18


def _leaf(data: str) -> bytes:
    return hashlib.blake2b(b"\0" + data.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _node(kind: bytes, children: list[bytes]) -> bytes:
    return hashlib.blake2b(kind + b"".join(children), digest_size=16).digest()


@dataclass(frozen=True)
class Tree:
    """Digests from the root down to the leaves, and the characters below each of them."""

    root: str
    #: (digest, characters, paragraphs); a paragraph is (digest, characters, leaves); a leaf (digest, characters)
    sections: tuple
    n_chars: int


def build(text: str | None) -> Tree:
    """The tree of a text; null is an empty text, which has no sections."""
    text = text or ""
    sections, paragraphs, leaves = [], [], []

    def end_paragraph() -> bytes:
        digest = _node(b"\1", [d for d, _ in leaves])
        paragraphs.append((digest, sum(n for _, n in leaves), tuple(leaves)))
        leaves.clear()
        return digest

    def end_section() -> None:
        digest = _node(b"\2", [p[0] for p in paragraphs])
        sections.append((digest, sum(p[1] for p in paragraphs), tuple(paragraphs)))
        paragraphs.clear()

    for piece in _LEAF.findall(text):
        if not piece:
            continue
        leaves.append((_leaf(piece), len(piece)))
        if piece[-1] == "\n":
            digest = end_paragraph()
            if piece.endswith("\n\n") or digest[0] % SECTION_PARAGRAPHS == 0:
                end_section()
    if leaves:
        end_paragraph()
    if paragraphs:
        end_section()
    return Tree(_node(b"\3", [s[0] for s in sections]).hex(), tuple(sections), len(text))


def _shared(ours: tuple, theirs: tuple, depth: int) -> int:
    """Characters of ``ours`` below branches that both have, as often as both have them."""
    left = Counter(b[0] for b in theirs)
    mine, same = [], 0
    for branch in ours:
        if left[branch[0]] > 0:
            left[branch[0]] -= 1
            same += branch[1]
        else:
            mine.append(branch)
    if depth and mine:
        other = []
        for branch in theirs:
            if left[branch[0]] > 0:
                left[branch[0]] -= 1
                other.append(branch)
        same += _shared(
            tuple(x for b in mine for x in b[2]), tuple(x for b in other for x in b[2]), depth - 1
        )
    return same


def likeness(a: Tree, b: Tree) -> float:
    """The share of characters below equal branches, from 0 to 1 for equal texts."""
    if a.root == b.root:
        return 1.0
    return 2.0 * _shared(a.sections, b.sections, 2) / (a.n_chars + b.n_chars)


def first_difference(a: Tree, b: Tree) -> int | None:
    """The character at which the first differing leaf begins; none if the texts are equal."""
    if a.root == b.root:
        return None
    ours, theirs, at = a.sections, b.sections, 0
    for depth in range(3):
        k = 0
        while k < min(len(ours), len(theirs)) and ours[k][0] == theirs[k][0]:
            at += ours[k][1]
            k += 1
        if depth == 2 or k == len(ours) or k == len(theirs):
            return at
        ours, theirs = ours[k][2], theirs[k][2]
    return at


def edited(text: str, following: str) -> str:
    """The last third replaced by as many first characters of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, first_edit long"
)
_FIRST = -(1 << 63)


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how near both are.

    The next document is the one with the next smaller id; after the smallest comes the
    largest. Null ids are smaller than all others, rows of one id go by their texts, and
    a single row is its own next. Each row is compared with the tree of its edited text
    and with the next row's; ``first_edit`` is where the first edited leaf begins.

    Texts are shuffled once, into ranges of ids. The first row of each range is sent to
    the range before it as well, which is all that a range needs from another one.
    """
    key = F.coalesce(col(id_column).cast("long"), F.lit(_FIRST))
    keyed = docs.select(key.alias("k"), col(id_column).cast("long").alias("id"), F.coalesce(col(text_column), F.lit("")).alias("t"))
    keys = stage(keyed.select("k"), "keys")
    rows = keys.count()
    if not rows:
        return docs.sparkSession.createDataFrame([], _OUT)
    ranges = partitions_for(rows, RANGE_ROWS, least=16, most=MOST_RANGES)
    # a bounded sample only decides where ranges begin; all rows are in one of them
    drawn = keys.sample(min(1.0, SAMPLE_KEYS / rows), seed=7).limit(2 * SAMPLE_KEYS).toArrow().column(0).to_numpy()
    at = np.linspace(0, max(0, len(drawn) - 1), ranges + 1)[1:-1].astype(np.int64)
    borders = np.unique(np.sort(drawn)[at]) if len(drawn) else np.zeros(0, dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, k.to_numpy(np.int64), side="right").astype(np.int32))

    # one row for each range that has rows, the largest key first
    heads = sorted(keys.groupBy(range_of("k").alias("r")).agg(F.max("k").alias("k")).collect(), reverse=True)
    guest_of = {}
    for above, here in zip([heads[-1], *heads[:-1]], heads):
        guest_of[here["k"]] = above["r"]  # for the last row of the range above, or for the very last row
    head_keys = np.array(sorted(guest_of), dtype=np.int64)
    head_ranges = np.array([guest_of[k] for k in head_keys.tolist()], dtype=np.int32)

    @F.pandas_udf(T.IntegerType())
    def visits(k: pd.Series) -> pd.Series:
        k = k.to_numpy(np.int64)
        found = np.minimum(np.searchsorted(head_keys, k), len(head_keys) - 1)
        return pd.Series(np.where(head_keys[found] == k, head_ranges[found], -1).astype(np.int32))

    placed = keyed.withColumns({"r": range_of("k"), "v": visits("k")}).select(
        "k", "id", "t", F.explode(F.expr("array(struct(r, false AS guest), struct(nullif(v, -1) AS r, true AS guest))")).alias("at")
    )
    in_order = (
        placed.selectExpr("k", "id", "t", "at.r AS r", "at.guest AS guest")
        .filter("r IS NOT NULL")
        .repartition("r")
        .sortWithinPartitions("r", "guest", F.desc("k"), "t")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (range, id, text, tree) of the row that waits for its next
        for batch in slices(batches):
            out: list[tuple] = []
            for _, doc, text, r, guest in zip(*[c.to_pylist() for c in batch.columns]):
                if before is None or before[0] != r:
                    tree = None
                    if guest:  # a range begins with its own rows, so this is a second guest
                        continue
                tree = build(text)
                if before is not None and before[0] == r:
                    out.append(_row(before[1], before[2], before[3], text, tree))
                before = None if guest else (r, doc, text, tree)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*out), _ARROW)], schema=_ARROW
                )

    return in_order.mapInArrow(compared, _OUT)


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("first_edit", pa.int64()),
    ]
)


def _row(doc: int | None, text: str, tree: Tree, following: str, following_tree: Tree) -> tuple:
    changed = edited(text, following)
    other = build(changed)
    return (
        doc,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        tree.root,
        other.root,
        likeness(tree, other),
        likeness(tree, following_tree),
        first_difference(tree, other),
    )
