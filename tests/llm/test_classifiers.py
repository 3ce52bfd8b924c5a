from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from snapledger.llm import quality, toxicity

DOCS = "doc_id long, text string, lang string, score string, y int"
LABELS = "doc_id long, quality int, toxic int, text string"
WORDS = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ["n", "r", "st", "lle"]]


def corpus():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(700):
        words = [rng.choice(WORDS) for _ in range(rng.randint(20, 120))]
        toxic, bad = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zounds", "Gadzooks,"]))
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)
        rows.append((i, text, "en", "clash", 3))
        if rng.random() < 0.8:
            labels.append((i, int(not bad), int(toxic), "clash"))
    rows += [(1000, None, None, None, None), (1001, "", "en", "", 0), (None, "no id", "en", "", 0),
             (5, rows[5][1], "en", "again", 1), (1002, "word " * 60_000, "en", "", 1)]
    labels += [(None, 1, 1, ""), (2000, 0, 0, ""), (6, None, None, ""), (7, labels[0][1], None, "")]
    return rows, labels


@pytest.mark.parametrize("operator, target, cut", [
    (quality.classify, 1, quality.THRESHOLD), (toxicity.classify, 2, toxicity.THRESHOLD)])
def test_held_out_accuracy_and_odd_rows(spark, operator, target, cut):
    rows, labels = corpus()
    got = operator(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(row[0]) for row in rows)
    marks = {row[0]: row[target] for row in labels if row[0] not in (6, 7, None, 2000)}
    right = []
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
        if r.held_out and r.doc_id in marks:
            right.append(r.predicted == marks[r.doc_id])
    assert len(right) > 60 and np.mean(right) > 0.95
    assert len({r.score for r in got if r.doc_id == 5}) == 1


@pytest.mark.parametrize("operator", [quality.classify, toxicity.classify])
def test_without_labels_and_without_rows(spark, operator):
    docs = spark.createDataFrame([(1, "a b", "", "", 1), (2, None, "", "", 1)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert len({r.score for r in operator(docs, none).collect()}) == 1
    assert operator(spark.createDataFrame([], DOCS), none).count() == 0


@pytest.mark.parametrize("stage, target, wanted", [(quality.good, 1, 1), (toxicity.clean, 2, 0)])
def test_filters_keep_whole_rows(spark, stage, target, wanted):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    kept = stage(docs, spark.createDataFrame(labels, LABELS))
    assert kept.schema == docs.schema
    got = {r.doc_id for r in kept.collect()}
    marks = {row[0]: row[target] for row in labels if row[0] not in (6, 7, None, 2000)}
    assert np.mean([(i in got) == (y == wanted) for i, y in marks.items()]) > 0.95


def test_neighbours_match_a_plain_search():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Ab", "cd!", "EF%", "gh", "12"]) for _ in range(30)) for _ in range(200)]
    marks = [rng.randint(0, 1) for _ in texts]
    space = quality.fit([quality.terms(t) for t in texts[:150]], marks[:150])
    vectors = space.embed(texts[:150])
    for text in texts[150:]:
        cosines = vectors @ space.embed([text])[0]
        chosen = cosines >= sorted(cosines)[-3]
        expected = np.maximum(cosines, 0)[chosen] @ np.array(marks[:150])[chosen] / cosines[chosen].sum()
        assert abs(space.score([text])[0] - expected) < 1e-9


def test_weights_are_sparse():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(WORDS) for _ in range(60)) + (" zounds" if i % 4 == 0 else "") for i in range(300)]
    weights = toxicity.learn(texts, [int(i % 4 == 0) for i in range(300)])
    assert len(weights) < 0.2 * len(np.unique(np.concatenate([toxicity.features(t) for t in texts])))
    scores = toxicity.scorer(weights)(["zounds", "ban bar", ""])
    assert scores[0] > scores[1] and scores[2] < 0.5
