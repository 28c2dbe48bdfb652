"""Language identification by compression.

Each language has a dictionary of raw sample text. A text is cut into blocks, and every
block is compressed with each dictionary; the language with the smallest total wins,
for its dictionary already holds most of the text's words. Where the best two totals
are close, the answer is rejected. Only letters count: texts and samples are reduced to
their words in lower case, or else marks that repeat would outweigh the words.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from siltworks.llm.common import col, map_text, unused_name

UNKNOWN = "und"
#: sample excerpts of a language and the characters of each one
EXCERPTS = 96
EXCERPT_CHARS = 1024
#: bytes of one dictionary, and of all dictionaries together, which every worker holds
DICTIONARY_BYTES = 64 << 10
ALL_BYTES = 64 << 20
#: bytes of text compressed at once; a longer block would teach itself its own language
BLOCK_BYTES = 512
LEVEL = 9
#: syllables are shorter than what the compressor looks for by itself
MIN_MATCH = 3
#: stands before every block: the compressor gives up on short blocks that do not get smaller,
#: and their few matches would not count
PRIMER = b" " * 32
#: rejected below this share of the second best size
MIN_MARGIN = 0.002
#: or this many bytes: of 10,000 documents, a lead of two was right 12 times in 12, a smaller one 19 times in 59
MIN_LEAD_BYTES = 2

# signs for numbers, such as fractions, are word characters without being letters or digits
_NUMBERS = [c for c in map(chr, range(0x80, sys.maxunicode)) if unicodedata.category(c) in ("No", "Nl")]
# the set of those up to U+FFFF is a table, which is fast; few texts hold any others
_NUMBER, _RARE_NUMBER = (re.compile("[" + "".join(c for c in _NUMBERS if (c > "\uffff") is rare) + "]") for rare in (False, True))
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> bytes:
    """The words of a text in lower case, one space between them."""
    text = text.lower()
    if not text.isascii():
        text = _NUMBER.sub(" ", text)
        if len(text.encode("utf-16-le", "surrogatepass")) > 2 * len(text):
            text = _RARE_NUMBER.sub(" ", text)
    return " ".join(_WORD.findall(text)).encode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class LanguageModel:
    """Languages in alphabetical order and a dictionary for each."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def fold(id_column: Column) -> Column:
    """0 to 3, from the checksum of the id as text; fold 2 is held out of every fit."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4


def fit(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    excerpts: int = EXCERPTS,
    excerpt_chars: int = EXCERPT_CHARS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    all_bytes: int = ALL_BYTES,
) -> LanguageModel:
    """Dictionaries from a bounded random sample of the rows that have a text and a language.

    At most ``excerpts`` different texts of a language are used, copies once, from each a
    stretch of ``excerpt_chars`` that begins at a random place. With many languages dictionaries
    get smaller, so that all of them stay within ``all_bytes``. Without rows the model
    knows no language.
    """
    rows = docs.select(col(text_column).alias("t"), col(lang_column).cast("string").alias("l")).filter(
        "l IS NOT NULL AND t IS NOT NULL AND length(t) > 0"
    )
    # copies have one draw, so only different texts count; hashes are shuffled, no texts
    distinct = rows.select("l", F.xxhash64("t").alias("h")).distinct()
    counts = {r["l"]: r["n"] for r in distinct.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel((), ())
    if len(counts) > all_bytes // 1024:
        raise ValueError(f"{len(counts)} languages leave less than 1 KiB for each dictionary")
    # twice the wanted share passes this filter, so that ranking the rest is a small task for each language
    share = F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, 2.0 * (excerpts + 8) / n))])
    draw = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = (
        rows.withColumn("h", F.xxhash64("t"))
        .withColumn("draw", draw)
        .filter(F.col("draw") < share[F.col("l")])
        .selectExpr(
            "l",
            "h",
            "draw",
            f"substring(t, 1 + CAST(pmod(xxhash64(t, 1), greatest(length(t) - {excerpt_chars}, 0) + 1) AS INT),"
            f" {excerpt_chars}) AS t",
        )
        .distinct()  # each task leaves one excerpt of a text before the shuffle
        .selectExpr("l", "draw", "t", "row_number() OVER (PARTITION BY l ORDER BY draw, h, t) AS k")
        .filter(F.col("k") <= excerpts)
        .orderBy("l", "k")
        .collect()  # at most languages x excerpts short rows
    )
    each = min(dictionary_bytes, all_bytes // len(counts))
    samples: dict[str, list[bytes]] = {l: [] for l in sorted(counts)}
    for r in chosen:
        samples[r["l"]].append(letters(r["t"]))
    made = {l: b" ".join(t)[:each] for l, t in samples.items()}
    made = {l: d for l, d in made.items() if len(d) >= 8}  # shorter ones are no dictionary
    return LanguageModel(tuple(made), tuple(made.values()))


@lru_cache(maxsize=2)
def _compressors(model: LanguageModel) -> list[zstandard.ZstdCompressor]:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        source_size=len(PRIMER) + BLOCK_BYTES,
        dict_size=max(map(len, model.dictionaries)),
        min_match=MIN_MATCH,
        write_checksum=False,
        write_content_size=False,
        write_dict_id=False,
    )
    found = []
    for data in model.dictionaries:
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=params)
        found.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params))
    return found


def sizes(model: LanguageModel, data: bytes) -> list[int]:
    """The compressed bytes of all blocks with each dictionary."""
    blocks = [PRIMER + data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
    return [sum(len(c.compress(b)) for b in blocks) for c in _compressors(model)]


def identify(model: LanguageModel, text: str | None) -> tuple[str, float, int]:
    """(language, margin, lead): by how much the second best is larger, of its size (0 to 1) and in bytes.

    Texts without letters are unknown; equal sizes go to the language first in the alphabet.
    """
    data = letters(text or "")
    if not data or not model.languages:
        return UNKNOWN, 0.0, 0
    found = sizes(model, data)
    order = np.argsort(found, kind="stable")
    if len(order) == 1:
        return model.languages[0], 1.0, found[0]
    best, second = found[order[0]], found[order[1]]
    return model.languages[order[0]], (second - best) / second, second - best


def is_rejected(found: tuple[str, float, int], min_margin: float = MIN_MARGIN, min_lead: int = MIN_LEAD_BYTES) -> bool:
    """Is an answer of :func:`identify` too close to the next one?"""
    language, margin, lead = found
    return language == UNKNOWN or margin < min_margin or lead < min_lead


def predict(
    docs: DataFrame, model: LanguageModel, text_column: str = "text", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """All rows with lang_pred, score (the margin) and rejected.

    A text without letters (null and empty ones too), or with a margin under ``min_margin`` or
    ``MIN_LEAD_BYTES``, is rejected. Every row is judged for itself, whole texts of any length.
    Extra columns stay; a column that has one of the three names is replaced.
    """

    def judged(texts: list[str | None]) -> list[pa.Array]:
        found = [identify(model, t) for t in texts]
        return [
            pa.array([f[0] for f in found], pa.string()),
            pa.array([f[1] for f in found], pa.float64()),
            pa.array([is_rejected(f, min_margin) for f in found], pa.bool_()),
        ]

    return map_text(docs, text_column, "lang_pred string, score double, rejected boolean", judged)


def keep_identified(
    docs: DataFrame, model: LanguageModel, text_column: str = "text", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns.

    Null and empty texts and those without letters go; repeated rows have one fate; an empty table,
    or a model without languages, leaves none.
    """

    def judged(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([not is_rejected(identify(model, t), min_margin) for t in texts], pa.bool_())]

    marker = unused_name(docs, "_identified")
    return map_text(docs, text_column, f"{marker} boolean", judged).filter(F.col(marker)).drop(marker)
