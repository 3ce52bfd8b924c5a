"""Quality by votes of the nearest labelled documents in a latent space.

A document's terms are the shapes of its words (runs of capitals, small letters, digits and the
marks between) and signs of repetition (a word like the one before, a repeated line). Term rates
are weighted by rarity, and a truncated singular value decomposition of the labelled sample gives
the latent space. The sample's vectors and labels are broadcast, at most ``SAMPLE`` times
``RANK`` numbers; every document's cosines with all of them are computed exactly, block by block,
and the nearest vote with their similarity as weight. All that tie with the last of them vote too.
Labels, language, source and id are no terms.

A text without words, or like no labelled one, scores the share of label 1. Without labels every
score is 0.5. Only the id and text columns are read; null texts count as empty.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from snapledger.llm import labelled

SAMPLE, TERMS, RANK, NEIGHBOURS = 6_000, 1_024, 32, 15
ROWS_BY_NEIGHBOUR = 40
THRESHOLD = 0.3
_BLOCK = 128  # documents whose cosines are held at once
_MANY = 1_000  # term counts are taken per so many words

_CLASSES = bytearray(range(256))
for _code in range(256):
    if 0x30 <= _code <= 0x39:
        _CLASSES[_code] = ord("0")
    elif 0x41 <= _code <= 0x5A:
        _CLASSES[_code] = ord("A")
    elif 0x61 <= _code <= 0x7A or _code >= 0x80:
        _CLASSES[_code] = ord("a")
_CLASSES = bytes(_CLASSES)


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and the logarithms of their rates in the whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    kinds = np.frombuffer(raw.translate(_CLASSES), np.uint8)
    runs = kinds[np.append(True, kinds[1:] != kinds[:-1])].tobytes()
    counts = Counter(runs.split())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    counts[b" word again"] = sum(map(eq, tokens, tokens[1:]))
    counts[b" line again"] = len(lines) - len(set(lines))
    found = np.fromiter((zlib.crc32(term) % TERMS for term in counts), np.int64, len(counts))
    rates = np.fromiter(counts.values(), float, len(counts)) * (_MANY / len(tokens))
    return found, np.log1p(rates)


class Space:
    """The latent space: one row of ``project`` for each term, unit vectors and labels of the sample."""

    def __init__(self, project: np.ndarray, vectors: np.ndarray, marks: np.ndarray):
        self.project, self.vectors, self.marks = project, vectors, marks

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.project.shape[1]))
        for row, text in enumerate(texts):
            at, rates = terms(text)
            out[row] = rates @ self.project[at]
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0)

    def score(self, texts: list[str], neighbours: int = NEIGHBOURS) -> list[float]:
        out: list[float] = []
        share = float(self.marks.mean()) if len(self.marks) else 0.5
        # small samples hold few of either kind
        k = min(neighbours, max(3, len(self.marks) // ROWS_BY_NEIGHBOUR), len(self.marks))
        for start in range(0, len(texts), _BLOCK):
            part = texts[start:start + _BLOCK]
            if not k:
                out += [share] * len(part)
                continue
            cosines = self.embed(part) @ self.vectors.T
            least = np.partition(cosines, -k, axis=1)[:, -k:].min(axis=1)
            votes = np.where(cosines >= least[:, None], np.maximum(cosines, 0), 0)
            total = votes.sum(axis=1)
            mine = votes @ self.marks
            out += np.where(total > 0, mine / np.where(total > 0, total, 1), share).tolist()
        return [min(1.0, max(0.0, x)) for x in out]


def fit(found: list[tuple[np.ndarray, np.ndarray]], marks: list[int], rank: int = RANK) -> Space:
    """The space of the sample's terms."""
    counts = np.zeros((len(found), TERMS))
    for row, (at, rates) in enumerate(found):
        np.add.at(counts[row], at, rates)
    rarity = np.log((1 + len(found)) / (1 + (counts > 0).sum(axis=0))) + 1
    counts *= rarity
    values, axes = np.linalg.eigh(counts.T @ counts)
    keep = axes[:, np.argsort(values)[::-1][:rank]]
    latent = counts @ keep
    norms = np.linalg.norm(latent, axis=1, keepdims=True)
    return Space(rarity[:, None] * keep, latent / np.where(norms > 0, norms, 1), np.array(marks, float))


def _terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in frames:
        found = [terms(text) for text in df.text]
        yield pd.DataFrame({"doc_id": df.doc_id, "y": df.y, "at": [a for a, _ in found],
                            "rates": [r for _, r in found]})


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", bound: int = SAMPLE) -> Space:
    """Terms are taken in the cluster; a few hundred numbers for each sampled row reach the driver."""
    chosen, n = labelled.sample(docs, labels, target, bound)
    if not n:
        return Space(np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0))
    rows = chosen.select("doc_id", "text", "y").mapInPandas(
        _terms, "doc_id long, y int, at array<int>, rates array<double>").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, r.at, r.rates))
    return fit([(np.array(r.at, np.int64), np.array(r.rates, float)) for r in rows], [r.y for r in rows])


def _maker(docs: DataFrame, space: Space):
    shared = docs.sparkSession.sparkContext.broadcast(space)
    return lambda: shared.value.score


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return labelled.scores(docs, _maker(docs, train(docs, labels)), THRESHOLD)


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents at or above the threshold, with all their columns."""
    return labelled.keep(docs, _maker(docs, train(docs, labels)), lambda score: score >= THRESHOLD)
