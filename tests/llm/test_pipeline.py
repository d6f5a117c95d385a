"""Every stage of the pipeline against a plain version of it, each on what its predecessor kept."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from brandflow.llm import language_ppm, mixing, pii

from .test_decontamination import brute as contamination_by_hand
from .test_near import brute as near_by_hand

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF).persist()
        out.append((name, docs, done))
        docs = done
    return out


def pairs(df):
    return sorted([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["language_id", "near_dedup", "decontamination", "personal_data", "mixing"]
    assert all(done.columns == docs.columns for _, docs, done in stages[:4])


def test_language(stages):
    _, docs, done = stages[0]
    model = language_ppm.fit_language_model(docs)
    judged = {r["doc_id"]: r for r in language_ppm.identify_languages(docs.select("doc_id", "text"), model).collect()}
    readable = [(i, t) for i, t in pairs(docs) if re.search(r"[^\W\d_]", t) and judged[i]["bits_per_byte"] <= 8]
    assert pairs(done) == readable and len(readable) > 190


def test_near_dedup(stages):
    _, docs, done = stages[1]
    kept = {i for i, _, component in near_by_hand(pairs(docs), 5) if i == component}
    assert pairs(done) == [(i, t) for i, t in pairs(docs) if i in kept] and len(kept) < docs.count()


def test_decontamination(spark, stages):
    _, docs, done = stages[2]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, _, hit, _ in contamination_by_hand(pairs(docs), items) if not hit}
    assert pairs(done) == [(i, t) for i, t in pairs(docs) if i in clean] and len(clean) < docs.count()


def test_personal_data(stages):
    _, docs, done = stages[3]
    model = pii.fit_span_model(docs)
    assert pairs(done) == [(i, pii.redacted_text(t, model.spans(t))) for i, t in pairs(docs)]
    assert done.where(F.length("text") != F.col("n_chars")).count() == 0
    assert not any(pii.base_spans(t) for _, t in pairs(done))
    assert pairs(done) != pairs(docs)


def test_mixing(stages):
    _, docs, done = stages[4]
    rows = mixing.balanced(docs).collect()
    copies = {r["doc_id"]: r["copies"] for r in rows}
    assert pairs(done) == [p for p in pairs(docs) for _ in range(copies[p[0]])]
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1


def test_every_operator_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
