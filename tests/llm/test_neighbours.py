from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np

from snapledger.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score int, rank string"


def brute(rows, every, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            found = sorted(((-float(np.einsum("d,d->", q, w)), j) for j, w in ok if j != i))
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    out = defaultdict(list)
    for r in sorted(neighbours.search(df, **sizes).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((5, 24))
    rows = [(i, (centres[i % 5] * (i % 3) + rng.standard_normal(24) * rng.uniform(0.2, 3)).tolist())
            for i in range(3000)]
    expected = brute(rows, 20, 20)
    got = run(spark, rows, entry_block=900, query_block=60)
    assert got.keys() == expected.keys()
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in found}) for q, found in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))
    every = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda r: (-r[1], r[0]))
        assert all(abs(every[q] @ every[j] - s) < 1e-9 and j != q for j, s in found)


def test_ties_copies_and_unusable_vectors(spark):
    random.seed(2)
    same = [1.0, 2.0, 0.5]
    rows = [(i, same) for i in range(100)] + [(100 + i, [float(i % 7), 1.0, -1.0]) for i in range(60)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 1.0]), (260, [float("nan"), 1.0, 1.0]),
             (280, [float("inf"), 1.0, 1.0]), (None, same), (300, [1.0]), (301, [])]
    got, expected = run(spark, rows, every=20, k=20), brute([r for r in rows if r[0] != 300], 20, 20)
    assert {q: [j for j, _ in found] for q, found in got.items()} == {
        q: [j for j, _ in found] for q, found in expected.items()}


def test_few_candidates_and_empty_table(spark):
    assert run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]) == {0: [(1, 0.5)]}
    assert run(spark, [(0, [1.0, 0.0])]) == {}
    assert run(spark, []) == {}


def test_chi_square():
    assert abs(neighbours.chi_square_quantile(0.95, 16) - 26.296) < 1e-2
    assert abs(neighbours.chi_square_cdf(np.array(15.338), 16) - 0.5) < 1e-3


def test_repeated_ids_leave_no_gap(spark):
    rng = np.random.default_rng(9)
    own = [(20, rng.standard_normal(4).tolist()) for _ in range(40)]
    others = [(21 + i, rng.standard_normal(4).tolist()) for i in range(19)] + [
        (41 + i, rng.standard_normal(4).tolist()) for i in range(19)]
    got = run(spark, own + others, entry_block=30)
    asked = [np.array(v, np.float32).astype(float) for _, v in own]
    best = sorted((-max(float(q @ np.array(v, np.float32).astype(float)) for q in asked), i) for i, v in others)
    assert list(got) == [20] and [j for j, _ in got[20]] == [i for _, i in best[:20]]
    same = [1.0, 2.0, 0.5]
    assert [j for j, _ in run(spark, [(20, same)] * 30 + [(21, same), (22, same)])[20]] == [21, 22]
    got = run(spark, [(20, same)] * 30 + [(21, same)] * 30 + [(40, same)] * 30)
    assert [j for j, _ in got[20]] == [21] * 20 and [j for j, _ in got[40]] == [20] * 20
