from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from snapledger.llm import gru, lm

SCHEMA = "doc_id long, text string, score double, digest string"


def corpus():
    rng = random.Random(9)
    frequent = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(260):
        language = frequent[:20] if i % 2 else frequent[20:]
        text = " ".join(rng.choice(language) if rng.random() < 0.9 else f"Rare{rng.randrange(400)}"
                        for _ in range(rng.randint(0, 120)))
        rows.append((i, text, 1.0, "x"))
    rows += [(1000, None, 0.0, ""), (1001, "", 0.0, ""), (1002, "É\tnew é\x0bw1", 0.0, ""),
             (1003, "w1 w2 " * 4000, 0.0, ""), (5, rows[5][1], 0.0, ""), (6, "other text", 0.0, ""), (None, "w1", 0.0, "")]
    return rows


def base_scores(rows):
    tokens = [(text or "").encode().lower().split() for _, text, *_ in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, *_ in rows]
    counts = Counter()
    for words, out in zip(tokens, held, strict=True):
        if not out:
            counts.update([*words, None])
    n, v = sum(counts.values()), len(counts)
    for (i, *_), words, out in zip(rows, tokens, held, strict=True):
        own = [*words, None]
        yield (i, out, len(own), sum(counts[w] > 0 for w in own), n,
               sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))


@pytest.mark.parametrize("known, modelled", [(lm.KNOWN, lm.MODELLED), (25, 10), (0, 0)])
def test_base_scores_match_and_the_model_is_better(spark, monkeypatch, known, modelled):
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "MODELLED", modelled)
    rows = corpus()
    got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    for r, e in zip(sorted(map(tuple, got), key=key), sorted(base_scores(rows), key=key), strict=True):
        assert r[:5] == e[:5] and abs(r[5] - e[5]) < 1e-6 * max(1, abs(e[5]))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    if known:
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_no_training_text_and_empty_table(spark):
    held = [(i, "a b", 0.0, "") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    got = lm.score(spark.createDataFrame(held, SCHEMA)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)
    assert lm.score(spark.createDataFrame([], SCHEMA)).count() == 0


def small(seed=1):
    shape = gru.Shape(np.array([5.0, 40, 30, 20, 10, 5, 2]), np.array([3.0, 1.0]))
    params = shape.fresh()
    rng = np.random.default_rng(seed)
    return shape, {k: (v + rng.standard_normal(v.shape) * 0.3).astype("f4") for k, v in params.items()}


def test_next_token_probabilities_sum_to_one():
    shape, params = small()
    total = np.exp(gru.Gru(shape, params).run([np.array([i]) for i in range(9)])).sum()
    assert abs(total - 1) < 1e-5
    prefix = [3, 1, 8, 2] * 20
    first = gru.Gru(shape, params).run([np.array(prefix)])[0]
    rest = gru.Gru(shape, params).run([np.array([*prefix, i]) for i in range(9)])
    assert abs(np.exp(rest - first).sum() - 1) < 1e-3


def test_state_is_carried_and_lanes_do_not_mix():
    shape, params = small()
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(1, 9, rng.integers(0, 150)), 0) for _ in range(700)]
    together = gru.Gru(shape, params).run(docs)
    alone = [gru.Gru(shape, params).run([d])[0] for d in docs[:60]]
    assert np.allclose(together[:60], alone, atol=1e-3)


def test_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(gru, "RATE", 0.0)
    shape, params = small()
    docs = [np.array([1, 3, 2, 8, 4, 0]), np.array([7, 5, 6, 1, 0])]
    seen = {}
    model = gru.Gru(shape, {k: v.astype("f8").astype("f4") for k, v in params.items()})
    original = model._learn

    def keep(before, olds, gates, news, keep_, d_states, grads, n):
        original(before, olds, gates, news, keep_, d_states, grads, n)
        seen.update({k: g * np.sqrt(n) for k, g in grads.items()})

    model._learn = keep
    model.run(docs, learn=True)
    rng = np.random.default_rng(0)
    for name, value in params.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            change = []
            for step in (1e-2, -1e-2):
                moved = {k: v.copy() for k, v in params.items()}
                moved[name][at] += step
                change.append(-gru.Gru(shape, moved).run(docs).sum())
            assert abs((change[0] - change[1]) / 2e-2 - seen[name][at]) < 0.02, (name, at)
