from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from test_classifiers import DOCS, LABELS, corpus
from test_jaccard import brute

from snapledger.llm import jaccard, quality, toxicity


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    rows += [(3000 + i, texts[i] + " end", "en", "copy", 1) for i in range(0, 200, 4)]
    rows += [(4000, texts[9], "en", "exact", 1), (11, texts[11], "fr", "same id", 2), (None, texts[9], "en", "", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_match_plain_versions(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    schema = docs.schema
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, tables)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if name == "packing":
            break
        assert docs.schema == schema
        rows, left = before.collect(), Counter(docs.collect())
        if name == "n-gram Jaccard join":
            expected = brute([(r.doc_id, r.text) for r in rows])
            ids = Counter(r.doc_id for r in docs.collect())
            assert ids.pop(None, 0) == sum(r.doc_id is None for r in rows)
            assert ids == Counter({c for d, _, c in expected if d is not None})
            assert not left - Counter(rows)
            continue
        operator, keep = (quality.classify, 1) if k == 0 else (toxicity.classify, 0)
        verdicts = {(r.doc_id, r.score): r.predicted for r in operator(before, labels).collect()}
        by_id = {}
        for (doc_id, _), predicted in verdicts.items():
            by_id.setdefault(doc_id, set()).add(predicted)
        assert left == Counter(r for r in rows if by_id[r.doc_id] == {keep} or
                               (len(by_id[r.doc_id]) > 1 and left[r]))
    total = docs.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in total} == {r.doc_id for r in before.collect()}


def test_run_and_empty_tables(spark, tables, tmp_path):
    assert corpus_pipeline.run(spark, tables).count() > 0
    for name, schema in (("documents", DOCS), ("labels", LABELS)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_survive(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 5, 6), (2, "a b c d e f", 7, 8), (None, "a", 1, 1)],
                                 "doc_id long, text string, _id long, node long")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.filter(
        "doc_id is null or doc_id = 1").collect()))
