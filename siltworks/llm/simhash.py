"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are linked if they differ in at most ``max_bits`` bits. Anchors
are the words of a covering code: every fingerprint lies within the covering radius of
one, its home. A fingerprint within ``max_bits`` of another one is no farther than
radius plus ``max_bits`` from the other's home, so it is replicated to all anchors that
near, and every linked pair meets at an anchor.

The code is a product of perfect codes: two Golay codes of 23 bits (radius 3) and one
Hamming code of 15 bits (radius 1). In a product, differing bits fall into some blocks
and leave the others as they are, so a replica moves away from its own home only in
blocks that may differ: with two bits, any one block by up to two bits or any two blocks
by one each. That is about 150 replicas instead of the many millions of anchors
of the whole product within radius plus two. The three bits outside the blocks are
compared with all others when the pair meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import col, slices, text_hash
from siltworks.llm.components import connected_components
from siltworks.session import stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42

# Generator polynomials of the perfect codes, bit i is the coefficient of x^i.
GOLAY_23 = 0b101011100011
HAMMING_15 = 0b10011

#: (first bit, length, generator polynomial, covering radius)
BLOCKS = ((0, 23, GOLAY_23, 3), (23, 23, GOLAY_23, 3), (46, 15, HAMMING_15, 1))

#: shingles whose bits are counted at once
_CHUNK = 1 << 15

_NOWHERE = np.zeros(1, dtype=np.uint64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text; a bit is 1 if it is set in over half of all shingle hashes.

    Only A-Z are lower-cased, words are split at ASCII white space, repeated shingles
    count each time. Fewer words than a shingle are one shingle; no words give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = len(words) - shingle_words + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        stop = min(n, at + _CHUNK)
        runs = [words[at + k : stop + k] for k in range(shingle_words)]
        hashes = np.array([digest(join(s), SEED) for s in zip(*runs)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    ones = np.packbits(counts * 2 > n, bitorder="little")
    return int(ones.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(id, text_hash, fp): the fingerprint of every row as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["id", "text_hash", "fp"]
            )

    source = docs.select(
        col(id_column).cast("long").alias("id"), text_hash(text_column).alias("text_hash"), col(text_column).alias("t")
    )
    return source.mapInArrow(hashed, "id long, text_hash long, fp long")


class _Block:
    """Error patterns of one code by syndrome: what leads a word to the anchors near it."""

    def __init__(self, first: int, length: int, generator: int, radius: int, spread: int):
        self.first, self.mask, self.radius = np.uint64(first), np.uint64((1 << length) - 1), radius
        checks = generator.bit_length() - 1
        unit, power = [], 1
        for _ in range(length):  # x^i modulo the generator
            unit.append(power)
            power <<= 1
            if power >> checks & 1:
                power ^= generator
        self.unit = np.array(unit, dtype=np.int64)
        patterns: dict[int, list[list[int]]] = {s: [[] for _ in range(radius + spread + 1)] for s in range(1 << checks)}
        for weight in range(radius + spread + 1):
            for bits in combinations(range(length), weight):
                syndrome = 0
                for i in bits:
                    syndrome ^= unit[i]
                patterns[syndrome][weight].append(sum(1 << i for i in bits))
        self.home = np.zeros(1 << checks, dtype=np.uint64)
        #: for d differing bits: moves[d][syndrome] are the patterns to all anchors within radius + d, but the home
        self.moves: list[list[np.ndarray]] = [[] for _ in range(spread + 1)]
        for s, by_weight in patterns.items():
            in_order = [p for row in by_weight for p in row]
            self.home[s] = in_order[0]
            for d in range(spread + 1):
                near = sum(len(row) for row in by_weight[: radius + d + 1])
                self.moves[d].append(np.array(in_order[1:near], dtype=np.uint64) << self.first)
        self.home <<= self.first

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        bits, found = (words >> self.first) & self.mask, np.zeros(len(words), dtype=np.int64)
        for i, unit in enumerate(self.unit):
            found ^= ((bits >> np.uint64(i)) & np.uint64(1)).astype(np.int64) * unit
        return found


class AnchorCode:
    """Homes and replicas of fingerprints among the anchors of a product of perfect codes."""

    def __init__(self, blocks=BLOCKS, max_bits: int = MAX_BITS):
        self.max_bits = max_bits
        self.blocks = [_Block(*b, spread=max_bits) for b in blocks]
        self.mask = np.uint64(sum(((1 << n) - 1) << first for first, n, _, _ in blocks))
        #: how the differing bits may fall on the blocks, none of them left over
        spreads = [s for s in product(range(max_bits + 1), repeat=len(blocks)) if 0 < sum(s) <= max_bits]
        # one that is contained in another one brings nothing new
        self.spreads = [s for s in spreads if not any(t != s and all(x <= y for x, y in zip(s, t)) for t in spreads)]

    def anchors(self, fps: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(home of each fingerprint, all anchors near enough for each, its home first)."""
        syndromes = [b.syndrome(fps) for b in self.blocks]
        home = fps & self.mask
        for b, s in zip(self.blocks, syndromes):
            home = home ^ b.home[s]
        near = []
        for k in range(len(fps)):
            # moves start at the fingerprint; taken relative to its home in the block
            steps = [[m[x[k]] ^ b.home[x[k]] for m in b.moves] for b, x in zip(self.blocks, syndromes)]
            reached = [_NOWHERE]
            for spread in self.spreads:
                total = _NOWHERE
                for block, bits in zip(steps, spread):
                    if bits:
                        total = (total[:, None] ^ block[bits]).ravel()
                reached.append(total)
            found = np.concatenate(reached)
            # with two bits no anchor is reached in two ways
            near.append((np.unique(found) if self.max_bits > 2 else found) ^ home[k])
        return home, near


@lru_cache(maxsize=4)
def anchor_code(max_bits: int = MAX_BITS) -> AnchorCode:
    return AnchorCode(max_bits=max_bits)


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): every two different fingerprints (column ``fp``) that differ in at most ``max_bits`` bits, once."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = anchor_code(max_bits)
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            home = fps & code.mask
            for b in code.blocks:
                home = home ^ b.home[b.syndrome(fps)]
            yield pa.RecordBatch.from_arrays([pa.array(home.view(np.int64)), batch.column(0)], names=["anchor", "a"])

    def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = anchor_code(max_bits)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                fps = batch.column(0).slice(at, 512).to_numpy().view(np.uint64)
                _, near = code.anchors(fps)
                anchor = np.concatenate(near).view(np.int64)
                own = np.repeat(fps.view(np.int64), [len(x) for x in near])
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own)], names=["anchor", "b"])

    left = distinct.select("fp").mapInArrow(homes, "anchor long, a long")
    right = distinct.select("fp").mapInArrow(replicas, "anchor long, b long")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # merged by exchanges: Spark takes the replicas to be as few as the fingerprints and would broadcast them
    return left.join(right.hint("merge"), (left["anchor"] == right["anchor"]) & near).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, text_hash, fp, root, component_id) per row; component_id is the smallest id that can be reached.

    ``root`` tells components apart even where ids repeat: it is one of their fingerprints.

    Copies share a fingerprint, so links are sought between distinct fingerprints only.
    Null and empty texts have fingerprint 0. A null id is larger than all others: a
    component of rows without ids has a null component_id. Repeated rows come back as often as they came.
    """
    fps = stage(fingerprints(docs, id_column, text_column, shingle_words), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    joined = stage(connected_components(links(distinct, max_bits)), "components")
    # members and roots of components of two and more; all others are their own
    member = joined.select(F.col("node").alias("fp"), "root").unionByName(
        joined.select(F.col("root").alias("fp"), "root").distinct()
    )
    # written, so that the join below reads both sides by exchanges and a component of very many can be split
    smallest = stage(member.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    classes = (
        distinct.join(member, "fp", "left")
        .join(smallest, "root", "left")
        .select(
            "fp",
            F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
    return fps.join(stage(classes, "classes"), "fp").select("id", "text_hash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The row with the smallest id of each component, all its columns; of rows that tie one stays.

    Rows with null ids stay only if their whole component has no id.
    """
    found = near_duplicates(docs, id_column, text_column, **how)
    # the smallest text hash decides between rows of one id, and of rows without any
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.id").alias("keep_id"), F.col("first.text_hash").alias("mark"))
    packed = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"),
        col(id_column).cast("long").alias("id"),
        text_hash(text_column).alias("text_hash"),
    )
    kept = packed.join(first, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("mark")), "left_semi")
    # repeated rows are equal in id and text; any one of them will do
    numbered = kept.selectExpr("row", "row_number() OVER (PARTITION BY id, text_hash ORDER BY id) AS k").filter("k = 1")
    return numbered.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
