"""Document log-likelihood by a recurrent language model learned from the corpus itself.

Tokens are words (A-Z lower-cased, between ASCII white spaces) and one end per text. Every training
token is counted, and all training texts are learned from, once: in rounds over growing shares,
where each task goes through its texts from the round's parameters and the results are averaged by
token. The frequent words are modelled one by one; every other word belongs to one of ``TAILS``
classes by its last bytes, where it has its smoothed share of the class, as has one unknown word.

Texts are cut into words twice, by Arrow's kernels: to count, and to store each text as the model's
ids. Learning and scoring read the ids. Only tables of fixed size are broadcast: the counts of at most
``KNOWN`` of the most frequent words and the parameters. Rarer words are stored beside the ids and meet
their counts in a join.

Null texts count as empty: the end alone. Rows with equal id and text have equal results, each is
returned. Without training text the counts are zero and the scores finite.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import fold, pick, text_of, write_once
from snapledger.llm.gru import Gru, Shape

FOLDS = 10
KNOWN, MODELLED, TAILS, LONGEST = 131_072, 1_535, 16, 64
SMOOTH = 0.1
ROUNDS = (0.1, 0.4, 1.0)  # a round ends at this share of the training texts
_PART = 4_096
_SHARES = 1_000
_COUNTED, _CODED = 32 << 20, 8 << 20  # bytes of texts, or of ids, that a task works on at once
_STEPS = 16  # to each doubling of a count


def _tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
        (fold("doc_id", FOLDS) == 0).alias("held_out"))


def _slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows some at a time: a slice holds less than ``size`` bytes of the column, its first row apart."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1), len(ends)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low < high:
                yield batch.slice(low, high - low)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of each word its text's place, and the words: A-Z lower-cased, between ASCII white spaces."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    found = lists.flatten()
    full = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty one
    if not full.all():
        owner, found = owner[full], found.filter(pa.array(full))
    return owner, found.cast(pa.binary())


def _tails(words: pa.Array) -> np.ndarray:
    ends = pc.binary_slice(words, -3).dictionary_encode()
    classes = np.array([zlib.crc32(end) % TAILS for end in ends.dictionary.to_pylist()], np.int64)
    return classes[ends.indices.to_numpy()]


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, tail, c) of the training texts, stored; the end is not among the words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "text", _COUNTED):
            found = _words(part.column("text"))[1].value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "c"])

    counted = texts.filter(~F.col("held_out")).select("text").mapInArrow(count, "word binary, c long")
    tail = (F.crc32(F.substring("word", -3, 3)) % TAILS).cast("int")
    return write_once(counted.groupBy("word").agg(F.sum("c").alias("c")).select("word", tail.alias("tail"), "c"),
                      "vocabulary")


@dataclass
class Corpus:
    """What is known of the training texts: fixed in size, whatever the corpus."""

    tokens: int
    distinct: int
    words: pa.Array  # the known ones, by falling count
    counts: np.ndarray  # of the known ones
    tail_of: np.ndarray  # of the known ones
    ends: int
    tail_masses: np.ndarray  # smoothed counts of all words but the modelled ones, and one unknown

    def __post_init__(self):
        self.modelled = min(MODELLED, len(self.counts))
        self.log_counts = np.log10(self.counts + SMOOTH)
        self.log_masses = np.log10(self.tail_masses)
        self.log_total = float(np.log10(self.tokens + SMOOTH * (self.distinct + 1)))
        self.log_end = float(np.log10(self.ends + SMOOTH))

    def shape(self) -> Shape:
        return Shape(np.concatenate([[self.ends], self.counts[:self.modelled]]).astype(float), self.tail_masses)

    def code(self, texts: pa.Array) -> dict[str, pa.Array]:
        """Of each text what a score needs: the model's ids with the end, counts, sums, and the rare words."""
        n = len(texts)
        owner, found = _words(texts)
        encoded = found.dictionary_encode()
        at, distinct = encoded.indices.to_numpy(), encoded.dictionary
        place = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy()
        tail = np.append(self.tail_of, 0)[place]
        tail[place < 0] = _tails(distinct.filter(pa.array(place < 0)))
        modelled = (place >= 0) & (place < self.modelled)
        logs = np.append(self.log_counts, 0.0)[place]  # a rare word adds its logarithm later
        inner = np.where(modelled, 0.0, logs - self.log_masses[tail])
        n_tokens = np.bincount(owner, minlength=n) + 1
        ids = np.zeros(len(at) + n, "<i2")
        ids[np.arange(len(at)) + owner] = np.where(modelled, place + 1, 1 + self.modelled + tail).astype("<i2")[at]
        spans = np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int32) * ids.itemsize
        rare = np.flatnonzero(place[at] < 0)
        pairs, times = np.unique(owner[rare] * np.int64(len(distinct)) + at[rare], return_counts=True)
        holder, word = np.divmod(pairs, max(1, len(distinct)))
        lists = np.concatenate([[0], np.cumsum(np.bincount(holder, minlength=n))]).astype(np.int32)
        known = np.bincount(owner, place[at] >= 0, n).astype(np.int64) + (self.ends > 0)
        base = np.bincount(owner, logs[at], n) + self.log_end - n_tokens * self.log_total
        return {
            "n_tokens": pa.array(n_tokens), "n_known": pa.array(known), "base": pa.array(base),
            "inner": pa.array(np.bincount(owner, inner[at], n)),
            "ids": pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(spans), pa.py_buffer(ids)]),
            "rare": pa.ListArray.from_arrays(lists, pa.StructArray.from_arrays(
                [distinct.take(pa.array(word)), pa.array(times.astype(np.int32))], ["word", "n"])),
        }


def describe(texts: DataFrame, counted: DataFrame) -> Corpus:
    ends = texts.filter(~F.col("held_out")).count()
    total = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # a sort's first rows would come from every task: find the least count by its logarithm's steps instead
    short = counted.filter(F.length("word") <= LONGEST).withColumn("step", F.floor(F.log2("c") * _STEPS))
    least, held = None, 0
    for r in sorted(short.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        held += r["count"]
        if held > KNOWN:
            break
        least = r["step"]
    top = [] if least is None else short.filter(F.col("step") >= least).select("word", "tail", "c").collect()
    top.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    sums = {r["tail"]: r["mass"] for r in counted.groupBy("tail").agg(
        (F.sum("c") + SMOOTH * F.count(F.lit(1))).alias("mass")).collect()}
    masses = np.array([sums.get(k, 0.0) + SMOOTH for k in range(TAILS)])
    for r in top[:MODELLED]:
        masses[r["tail"]] -= r["c"] + SMOOTH
    return Corpus(total["n"] + ends, total["v"] + (ends > 0),
                  pa.array([bytes(r["word"]) for r in top], pa.binary()), np.array([r["c"] for r in top], float),
                  np.array([r["tail"] for r in top], np.int64), ends, np.maximum(masses, SMOOTH))


def _flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)])


def _unflat(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype("f4")
        at += like[k].size
    return out


def store_codes(texts: DataFrame, corpus: Corpus) -> DataFrame:
    """Every row's ids and sums, stored, under a number of its own."""
    told = texts.sparkSession.sparkContext.broadcast(corpus)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "text", _CODED):
            columns = {c: part.column(c) for c in ("row", "doc_id", "held_out")}
            yield pa.RecordBatch.from_pydict(columns | told.value.code(part.column("text")))

    return write_once(texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        code, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, "
        "ids binary, rare array<struct<word: binary, n: int>>"), "codes")


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(ids.as_buffer(), "<i2") for ids in column]


def train(codes: DataFrame, corpus: Corpus) -> dict[str, np.ndarray]:
    """Parameters after all rounds; a round's averages are taken part by part in the cluster."""
    params = corpus.shape().fresh()
    if not corpus.tokens:
        return params
    spark = codes.sparkSession
    told = spark.sparkContext.broadcast(corpus)
    share = F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(_SHARES)) / _SHARES
    low = 0.0
    for high in ROUNDS:
        now = spark.sparkContext.broadcast(params)

        def learn(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            model = Gru(told.value.shape(), {k: v.copy() for k, v in now.value.items()})
            n, task = 0, 0
            for part in _slices(batches, "ids", _CODED):
                if not n:
                    task = (part.column("row")[0].as_py() >> 33) % 64  # of the task that stored it
                docs = _ids(part.column("ids"))
                model.run(docs, learn=True)
                n += sum(map(len, docs))
            if n:
                flat = _flat(model.p).astype(float) * n
                parts = [flat[at:at + _PART] for at in range(0, len(flat), _PART)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(range(len(parts)), pa.int32()), "task": pa.array([task] * len(parts), pa.int32()),
                    "n": pa.array([n] * len(parts)), "weighted": pa.array(parts, pa.list_(pa.float64()))})

        def add(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"part": group.part[:1], "task": 0, "n": [group.n.sum()],
                                 "weighted": [np.sum(np.stack(group.weighted), axis=0)]})

        rows = "part int, task int, n long, weighted array<double>"
        learned = codes.filter(~F.col("held_out") & (share >= low) & (share < high)).select("row", "ids").mapInArrow(
            learn, rows)
        some = learned.groupBy("part", "task").applyInPandas(add, rows)
        means = {r["part"]: np.array(r["weighted"]) / r["n"] for r in
                 some.groupBy("part").applyInPandas(add, rows).collect()}
        if means:
            params = _unflat(np.concatenate([means[k] for k in sorted(means)]), params)
        low = high
    return params


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    texts = _tokens(docs, id_col, text_col)
    counted = vocabulary(texts)
    corpus = describe(texts, counted)
    codes = store_codes(texts, corpus)
    params = train(codes, corpus)
    spark = docs.sparkSession
    told, learned = spark.sparkContext.broadcast(corpus), spark.sparkContext.broadcast(params)
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Gru(told.value.shape(), learned.value)
        for part in _slices(batches, "ids", _CODED):
            inner = part.column("inner").to_numpy() + model.run(_ids(part.column("ids"))) / np.log(10)
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in kept} | {"inner": pa.array(inner)})

    judged = write_once(codes.select(*kept, "inner", "ids").mapInArrow(
        judge, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double"),
        "judged")
    pairs = codes.select("row", F.inline("rare"))
    rest = pairs.join(counted.select("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + SMOOTH)).alias("logs"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"))
    return judged.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        (F.col("inner") + F.coalesce("logs", F.lit(0.0))).alias("score"))
