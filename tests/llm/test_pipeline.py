"""The registered queries and the pipeline on the smallest tables."""

import re

import corpus_pipeline
from casebook.llm import decontaminate, minhash, queries

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, before, SF), name)
        assert docs.columns == columns + ["slot", "shard"] * (name == "shard")
        assert docs.select("doc_id").subtract(before.select("doc_id")).isEmpty()
        if name == "near_dedup":
            assert minhash.near_duplicates(docs).where("not kept").isEmpty()
        if name == "decontaminate":
            assert decontaminate.contamination(docs, bench).where("contaminated").isEmpty()
            assert docs.count() < before.count()
        before = docs
    assert docs.count() > 0
