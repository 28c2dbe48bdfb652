"""The pipeline's stages against plain versions of them, and tables that are empty or awkward."""

import pytest
from llm_fixtures import SF_SMALL, awkward_rows, sentence, DOCS
from pyspark.sql import functions as F
from test_near_duplicates import plain_near_duplicates, plain_passages
from test_text_models import assert_packed, plain_matches

import __spark_entry__ as driver
import corpus_pipeline
from siltworks.llm import components, langid, packing, queries
from siltworks.llm.queries import language_model
from siltworks.llm.substrings import cut_out


def plain_pipeline(docs, items, model):
    """(id, text) that is left before packing, stage by stage."""
    kept = []
    for i, text in docs:
        if not langid.is_rejected(langid.identify(model, text)):
            kept.append((i, text))
    first = {i for i, _, component in plain_near_duplicates(kept) if i == component}
    kept = [(i, t) for i, t in kept if i in first]
    spans = {}
    for i, start, end in plain_passages(kept):
        spans.setdefault(i, []).append((start, end))
    kept = [(i, cut_out(t, spans[i]) if i in spans else t) for i, t in kept]
    kept = [(i, t) for i, t in kept if t.strip() or i not in spans]
    hit = {i for i, _, _ in plain_matches(kept, items)}
    return {i: t for i, t in kept if i not in hit}


def test_pipeline_equals_the_plain_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    left = plain_pipeline([tuple(r) for r in docs.select("doc_id", "text").collect()], items, language_model(docs))
    rows = driver.queries()["pipeline"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == set(left) and 100 < len(left) < 200
    assert_packed(rows, left, packing.SEQUENCE_TOKENS)


def test_stages_and_oracle():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "simhash_near_duplicates",
        "substring_dedup",
        "benchmark_decontamination",
        "best_fit_packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in driver.oracle_sql()


@pytest.mark.parametrize("rows", [[], awkward_rows()], ids=["empty", "awkward"])
def test_every_stage_takes_awkward_tables(spark, tmp_path, rows):
    items = spark.createDataFrame([(1, sentence(2, 30))] if rows else [], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, DOCS)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes
            out.write.parquet(f"{tmp_path}/out{k}")
            docs = spark.read.parquet(f"{tmp_path}/out{k}")
    assert (out.count() > 0) == bool(rows)


def test_counts_follow_the_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cut = corpus_pipeline.STAGES[2][1](spark, docs, SF_SMALL)
    joined = cut.join(docs.select("doc_id", F.col("text").alias("old"), F.col("n_chars").alias("n")), "doc_id")
    assert joined.filter("n_chars != length(text)").isEmpty() and not joined.filter("text != old").isEmpty()
    assert joined.filter("text = old AND n_chars != n").isEmpty()


def test_tables_that_grow_in_memory_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Replicas of fingerprints and shared stretches take many times what Spark sizes them at; they are merged, and all copies go."""
    texts = [sentence(700 + k, 60) for k in range(6)]
    rows = [(k, texts[k % 6], "en", "s", 1) for k in range(12)] + [(100 + k, f"{texts[k]} {sentence(800 + k, 60)}", "en", "s", 1) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    plans, steps = {}, dict(corpus_pipeline.STAGES)

    def watched(stage):
        def written(df, name):
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return stage(df, name)

        return written

    for module in (components, queries):
        monkeypatch.setattr(module, "stage", watched(module.stage))
    kept = steps["simhash_near_duplicates"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 100, 101, 102]
    cut = {r.doc_id: r.text for r in steps["substring_dedup"](spark, kept, str(tmp_path)).collect()}
    assert all(cut[k] == texts[k] for k in range(6)) and all(len(cut[100 + k]) < len(rows[12 + k][1]) - len(texts[k]) // 2 for k in range(3))
    for name, key in (("edges", "anchor"), ("passages", "digest")):
        assert f"SortMergeJoin [{key}#" in plans[name] and f"BroadcastHashJoin [{key}#" not in plans[name]
