"""The corpus pipeline: raw documents to packed training sequences.

Each stage works on what the one before has kept, written as Parquet and read again, so
that a lost executor costs a stage at most. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import queries
from siltworks.session import stage

STAGES = [
    ("language_id", queries.keep_identified),
    ("simhash_near_duplicates", queries.keep_first_of_near_duplicates),
    ("substring_dedup", queries.cut_repeated_passages),
    ("benchmark_decontamination", queries.drop_contaminated),
    ("best_fit_packing", queries.pack_sequences),
]

# compression, chunk hashes, random walks and token ids cannot be told in SQL; tests/llm compares
# every stage with a plain version of it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; the packed pieces of the last one.

    Rows and columns of any kind go through; an empty table gives no pieces (see each stage).
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
