"""Order-independent document fingerprints that can be updated paragraph by paragraph.

A paragraph (a line, also an empty one) hashes to a wide vector; a document's fingerprint is the
sum of its paragraphs' vectors, each lane modulo a power of two. Equal texts, and texts that only
order their lines differently, get equal fingerprints; inserting or deleting a paragraph adds or
subtracts its vector. The vector has two blocks:

* 16 lanes modulo 2**64 of a cryptographic hash of the paragraph, for equality;
* 256 lanes modulo 2**32, more than a text can hold shingles, where each of the paragraph's three-word shingles adds or subtracts one,
  so that the cosine between two sums estimates how much text two documents share.

Null texts count as empty (one empty paragraph). Rows are ordered by id, null first, then by text;
after the last comes the first. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256, shake_128

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import pick, text_of, word_hashes

WIDE, SHARED = 16, 256
_BREAK = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_LOWEST = -(2 ** 63)


class Fingerprint:
    """A sum of paragraph vectors; ``+`` and ``-`` work lane by lane."""

    def __init__(self, wide: np.ndarray, shared: np.ndarray):
        self.wide, self.shared = wide, shared

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.shared + other.shared)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.shared - other.shared)

    def hex(self) -> str:
        return self.wide.tobytes().hex() + self.shared.tobytes().hex()


def of_paragraphs(paragraphs: Iterable[bytes]) -> Fingerprint:
    paragraphs = list(paragraphs)
    raw = b"".join(shake_128(p).digest(8 * WIDE) for p in paragraphs)
    wide = np.frombuffer(raw, "<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
    words = [p.split() for p in paragraphs]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = [w for line in words for w in line]
    # a break before, between and after the paragraphs' words
    padded = np.full(len(flat) + len(words) + 1, _BREAK)
    is_word = np.ones(len(padded), bool)
    is_word[np.concatenate([[0], np.cumsum(sizes + 1)])] = False
    padded[is_word] = word_hashes(flat, len(flat))
    mixed = padded[:-2] * _MIX[0] + padded[1:-1] * _MIX[1] + padded[2:] * _MIX[2]
    mixed = mixed[is_word[1:-1]]  # shingles around a word lie in its paragraph
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[1]
    mixed ^= mixed >> np.uint64(29)
    signs = 1.0 - 2.0 * ((mixed >> np.uint64(8)) & np.uint64(1))
    lanes = np.bincount((mixed & np.uint64(SHARED - 1)).astype(np.int64), signs, SHARED)
    return Fingerprint(wide, lanes.astype(np.int64).astype("<i4"))


def of_text(text: str) -> Fingerprint:
    return of_paragraphs(text.encode("utf-8", "surrogatepass").split(b"\n"))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 for equal fingerprints, else the cosine of the shared lanes, not below 0."""
    if np.array_equal(a.wide, b.wide):
        return 1.0
    x, y = a.shared.astype(float), b.shared.astype(float)
    norm = np.sqrt((x @ x) * (y @ y))
    return float(min(1.0, max(0.0, x @ y / norm))) if norm else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_ROWS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
         "edited_fingerprint string, near_edited double, near_next double")


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket in order, each bucket closed by a guest: the next bucket's first row."""
    before = None
    for df in frames:
        rows = []
        for bucket, guest, doc_id, text in zip(df.bucket, df.guest, df.doc_id, df.text, strict=True):
            own = of_text(text)
            if before is not None and before[0] == bucket and not before[1]:
                changed = edited(before[3], text)
                changed_print = of_text(changed)
                rows.append((before[2], len(before[3]),
                             sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                             before[4].hex(), changed_print.hex(),
                             likeness(before[4], changed_print), likeness(before[4], own)))
            before = (bucket, guest, doc_id, text, own)
        out = pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                          "edited_fingerprint", "near_edited", "near_next"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def followed(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, guest, key, doc_id, text): id ranges in order, each with the next range's first rows.

    Only range bounds and each range's smallest id reach the driver.
    """
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(_LOWEST)))
    steps = [i / buckets for i in range(1, buckets)]
    found = keyed.approxQuantile("key", steps, 0.1 / buckets) if steps else []
    bounds = sorted({int(bound) for bound in found})  # any increasing bounds will do
    array = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    inside = keyed.withColumn("bucket", F.size(F.filter(array, lambda x: x <= F.col("key"))))
    firsts = {r["bucket"]: r["first"] for r in
              inside.groupBy("bucket").agg(F.min("key").alias("first")).collect()}
    filled = sorted(firsts)
    previous = dict(zip(filled, filled[-1:] + filled[:-1], strict=True))
    slots = range(len(bounds) + 1)
    first = F.array(*(F.lit(firsts.get(b)).cast("long") for b in slots))
    back = F.array(*(F.lit(previous.get(b)).cast("int") for b in slots))
    at = F.col("bucket") + 1
    own = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(F.element_at(back, at).alias("bucket"), F.lit(1).alias("guest"))
    return (
        inside.select("key", "doc_id", "text", F.explode(
            F.when(F.element_at(first, at) == F.col("key"), F.array(own, guest))
            .otherwise(F.array(own))).alias("to"))
        .select("to.bucket", "to.guest", "key", "doc_id", "text")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int | None = None) -> DataFrame:
    """Each document's fingerprint, and likeness to its edited text and to the next document.

    The texts are shuffled once, by ranges of ids.
    """
    tasks = max(32, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if buckets is None:
        buckets = 4 * tasks  # several to a task even out their sizes
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return (
        followed(texts, buckets).repartition(min(buckets, tasks), "bucket")
        .sortWithinPartitions("bucket", "guest", "key", "text")
        .select("bucket", "guest", "doc_id", "text")
        .mapInPandas(_compare, _ROWS)
    )
