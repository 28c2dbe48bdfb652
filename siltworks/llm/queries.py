"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltworks.llm import (
    balanced, decontam, langid, licenses, merkle, packing, quality, sharding, simhash, spelling, substrings, vector_codes, warc,
)
from siltworks.llm.common import table
from siltworks.session import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: 0 low quality, 1 good but toxic, 2 good
GRADES = 3


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents"), shards=sharding.SHARDS)
    return placed.withColumnRenamed("id", "doc_id").withColumn("law", F.lit("key"))


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Fitted on the folds that are not held out."""
    return langid.fit(docs.filter(langid.fold(F.col("doc_id")) != 2))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = langid.predict(docs.select("doc_id", "text"), language_model(docs))
    return judged.select("doc_id", (langid.fold(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op5_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path()))
    return packed.drop("text_hash").withColumnRenamed("id", "doc_id")


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, sf_dir, "documents"))
    return found.drop("text_hash", "again").withColumnsRenamed({"id": "doc_id", "kept_id": "kept_doc_id"})


@query
def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    model = quality.fit(hashed.join(labels, "doc_id"), GRADES, hash_column="text_hash")
    return quality.score(docs, model, selected_grade=GRADES - 1).drop("text")


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash").withColumnRenamed("id", "doc_id")


@query
def op11_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = balanced.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.withColumnRenamed("id", "doc_id")


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return coded.withColumnRenamed("id", "vec_id")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


# ---- stages of the corpus pipeline ---------------------------------------------


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressors agree on; the others go.

    Null and empty texts and those without letters go; copies have one fate; an empty table gives one.
    """
    return langid.keep_identified(docs, language_model(docs))


def keep_first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, once.

    Null texts and those without words are one group; an empty table gives one.
    """
    return simhash.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that another document, or they themselves, had before.

    Null and blank texts stay; of equal texts without an id one stays; an empty table gives one.
    """
    passages = stage(substrings.repeated_passages(docs), "passages")
    return substrings.remove_passages(docs, passages)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found.

    Null and empty texts stay, and so do all documents if there is no item.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents and their places in sequences.

    Null and empty texts are their end mark; repeated rows are documents of their own.
    """
    packed = packing.pack(packing.pieces(docs, tokenizer_path()))
    return packed.drop("text_hash").withColumnRenamed("id", "doc_id")
