"""Toxicity by follow-the-regularised-leader logistic regression over hashed word n-grams.

Features are the presence of words, word pairs and pairs with one or two words between (skip-grams),
hashed; those of very few learned documents are left out. Each coordinate has its own learning rate, and the L1 term keeps a weight at zero until its
evidence outgrows it, so few weights are left to broadcast. The labelled sample is dealt to shards
that learn in parallel; their weights are averaged. Labels, language, source and id are no features.

An empty or null text has no features and scores the bias. Without labels every score is 0. Only
the id and text columns are read; repeated rows are scored alike.
"""

from __future__ import annotations

from array import array
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm import labelled
from snapledger.llm.common import word_hashes, words

BITS = 20
SAMPLE, SHARD_ROWS, EPOCHS = 40_000, 20_000, 6
ALPHA, BETA, L2 = 1.0, 1.0, 0.001
L1_BY_ROOT = 0.15  # chance evidence grows with the root of the rows, and so does the L1 term
ROWS_BY_DOC = 1_500  # a feature needs one document of this many rows, and two at least
THRESHOLD = 0.5
BIAS = -1
_EDGES = b".,;:!?\"'()[]{}<>|*#%$&-_/"
_STEPS = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def features(text: str) -> np.ndarray:
    """Hashed features of the whole text; repeated ones are left in."""
    tokens = [w for w in (w.strip(_EDGES) for w in words(text)) if w]
    h = word_hashes(tokens, len(tokens))
    parts = [h * _STEPS[0]]
    parts += [h[:-d] * _STEPS[0] + h[d:] * _STEPS[d] for d in (1, 2, 3)]
    mixed = np.concatenate(parts)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


class _Texts:
    """Texts of an Arrow column in a given order, one at a time."""

    def __init__(self, column: pa.ChunkedArray, order: np.ndarray):
        self.column, self.order = column.combine_chunks(), order.tolist()

    def __len__(self) -> int:
        return len(self.order)

    def __iter__(self) -> Iterator[str]:
        return (self.column[i].as_py() for i in self.order)


def learn(texts: Collection[str], marks: list[int], epochs: int = EPOCHS) -> dict[int, float]:
    """Weights other than zero, and the bias under ``BIAS``."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    held_by = np.zeros(size, np.int32)
    for text in texts:
        held_by[np.unique(features(text))] += 1
    # only common features are kept, so hash once more rather than hold all; in one piece of memory,
    # which goes back as a whole
    common = held_by >= max(2, len(texts) // ROWS_BY_DOC)
    flat, ends = array("i"), [0]
    for text in texts:
        found = features(text)
        flat.frombytes(np.append(np.unique(found[common[found]]), size).astype(np.int32).tobytes())
        ends.append(len(flat))
    kept = np.frombuffer(flat, np.int32)
    rows = [kept[a:b] for a, b in zip(ends, ends[1:])]
    l1 = L1_BY_ROOT * np.sqrt(len(rows))

    def weights(at: np.ndarray) -> np.ndarray:
        shrink = np.where(at == size, 0.0, l1)  # the bias is free
        w = -(z[at] - np.sign(z[at]) * shrink) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) > shrink, w, 0.0)

    for _ in range(epochs):
        for at, y in zip(rows, marks, strict=True):
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            after = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(after) - np.sqrt(n[at])) / ALPHA * w
            n[at] = after
    w = weights(np.arange(size + 1))
    found = {int(at): float(w[at]) for at in np.flatnonzero(w[:size])}
    return found | {BIAS: float(w[size])}


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", bound: int = SAMPLE,
          id_col: str = "doc_id", text_col: str = "text") -> dict[int, float]:
    """Averaged weights of the shards; at most 2**``BITS`` + 1 numbers reach the driver."""
    chosen, n = labelled.sample(docs, labels, target, bound, id_col=id_col, text_col=text_col)
    if not n:
        return {}
    shards = max(1, round(n / SHARD_ROWS))

    def fit(group: pa.Table) -> pa.Table:
        ordered = pc.sort_indices(group, [("doc_id", "ascending"), ("text", "ascending")]).to_numpy()
        order = ordered[np.random.default_rng(0).permutation(len(group))]
        found = learn(_Texts(group["text"], order), group["y"].to_numpy()[order].tolist())
        return pa.table({"at": pa.array(list(found), pa.int64()), "weight": pa.array(list(found.values()), pa.float64())})

    dealt = chosen.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    learned = dealt.groupBy("shard").applyInArrow(fit, "at long, weight double")
    # a shard's weights other than zero are summed; the others count as zero
    totals = learned.groupBy("at").agg(F.sum("weight").alias("weight")).collect()
    return {r["at"]: r["weight"] / shards for r in totals}


def scorer(weights: dict[int, float]) -> labelled.ScoreTexts:
    """Probability of label 1 for each text, from the features present in it."""
    if not weights:
        return lambda texts: [0.0] * len(texts)
    dense = np.zeros(1 << BITS)
    at = [k for k in weights if k != BIAS]
    dense[at] = [weights[k] for k in at]
    used = dense != 0
    bias = weights.get(BIAS, 0.0)

    def score(texts: list[str]) -> list[float]:
        out = []
        for text in texts:
            found = features(text)
            found = np.unique(found[used[found]])
            out.append(float(1 / (1 + np.exp(-np.clip(bias + dense[found].sum(), -500, 500)))))
        return out

    return score


def _maker(docs: DataFrame, weights: dict[int, float]):
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    return lambda: scorer(shared.value)


def classify(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    make = _maker(docs, train(docs, labels, **columns))
    return labelled.scores(docs, make, THRESHOLD)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    make = _maker(docs, train(docs, labels))
    return labelled.keep(docs, make, lambda score: score < THRESHOLD)
