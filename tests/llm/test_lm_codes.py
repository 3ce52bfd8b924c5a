"""op1_lm: texts are cut into words twice only, by the same rules as elsewhere; softmax of far-off logits."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm import gru, lm
from snapledger.llm.common import words


def odd_texts():
    spaces = "".join(map(chr, range(9, 14))) + " "
    others = "\x00\x08\x0e\x1c\x1d\x1e\x1f\x7f\x85\xa0\u2003\u2028\ufeff\u00c0\u00c9\u0130\u212a\U0001d400"
    rng = random.Random(4)
    texts = ["", " ", spaces, " a", "a ", "\x0bA\x0c b\r\n", "\u00c9a \u00c0B", "x" * 70_000, "\x00", "\u0130\u212a \u017f"]
    return texts + ["".join(rng.choice(spaces + others + "aBcZz") for _ in range(rng.randrange(60))) for _ in range(300)]


def test_each_text_is_cut_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(text):
        seen.add(1)
        return text

    n = 400
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.udf(told, T.StringType())(
        F.concat_ws(" ", F.lit("the"), F.col("id").cast("string"), (F.col("id") % 7).cast("string"))).alias("text"))
    assert len(lm.score(docs).collect()) == n
    assert seen.value <= 2 * n  # to count and to store the ids


def test_words_are_the_shared_ones():
    texts = odd_texts()
    for column in (pa.array(texts), pa.array(["cut off", *texts, "cut off"]).slice(1, len(texts))):
        owner, found = lm._words(column)
        got = [[] for _ in texts]
        for at, word in zip(owner, found.to_pylist(), strict=True):
            got[at].append(word)
        assert got == [words(t) for t in texts]


def test_slices_keep_every_row():
    sizes = [0, 5, 30, 0, 0, 9, 10, 11, 1, 100, 0, 3]
    batch = pa.RecordBatch.from_pydict({"i": list(range(len(sizes))), "text": ["x" * k for k in sizes]})
    parts = list(lm._slices(iter([batch, batch.slice(3, 0), batch.slice(4)]), "text", 10))
    assert [i for p in parts for i in p.column("i").to_pylist()] == [*range(12), *range(4, 12)]
    assert all(sum(map(len, p.column("text").to_pylist()[1:])) < 10 for p in parts)


def test_vocabulary_and_its_tail_classes(spark, monkeypatch):
    monkeypatch.setattr(lm, "_COUNTED", 64)
    texts = odd_texts()
    frame = spark.createDataFrame([(t, False) for t in texts] + [("held", True)], "text string, held_out boolean")
    got = {bytes(r["word"]): (r["tail"], r["c"]) for r in lm.vocabulary(frame).collect()}
    want = Counter(w for t in texts for w in words(t))
    assert got == {w: (zlib.crc32(w[-3:]) % lm.TAILS, c) for w, c in want.items()}
    assert lm._tails(pa.array(list(want), pa.binary())).tolist() == [zlib.crc32(w[-3:]) % lm.TAILS for w in want]


def test_small_slices_give_the_same_counts_and_rare_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 12)
    monkeypatch.setattr(lm, "MODELLED", 5)
    frame = spark.createDataFrame([*enumerate(odd_texts()), (7, None), (7, " a")], "doc_id long, text string")
    whole = sorted(map(tuple, lm.score(frame).collect()))
    monkeypatch.setattr(lm, "_COUNTED", 50)
    monkeypatch.setattr(lm, "_CODED", 50)
    parts = sorted(map(tuple, lm.score(frame).collect()))
    assert [r[:5] for r in parts] == [r[:5] for r in whole]
    assert np.allclose([r[5] for r in parts], [r[5] for r in whole], rtol=1e-9)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in parts)


def test_a_shift_of_all_logits_changes_nothing(monkeypatch):
    monkeypatch.setattr(gru, "RATE", 0.0)
    shape = gru.Shape(np.array([5.0, 40, 30, 20, 10, 5, 2]), np.array([3.0, 1.0]))
    docs = [np.array([1, 3, 2, 8, 4, 0]), np.array([7, 5, 6, 1, 0])]
    for learn in (False, True):
        plain = gru.Gru(shape, shape.fresh()).run(docs, learn)
        params = shape.fresh()
        params["class_bias"] += 120
        params["word_bias"] += 120
        assert np.allclose(gru.Gru(shape, params).run(docs, learn), plain, atol=1e-3)
