"""Labelled rows to learn from, and scoring or filtering of whole tables with what was learned."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from snapledger.llm.common import each_text, fold, pick, text_of

FOLDS = 5
_SCALE = 2 ** 30
ScoreTexts = Callable[[list[str]], "list[float]"]


def sample(docs: DataFrame, labels: DataFrame, target: str, bound: int, folds: int = FOLDS,
           id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(doc_id, text, y) of about ``bound`` labelled documents outside fold 0, and their label count.

    Rows without id or label are left out; of several labels of one document the greatest counts.
    The chosen ids, at most some 5 % more than ``bound``, are broadcast, so no text travels.
    """
    marked = (
        pick(labels, doc_id=id_col, y=target).dropna()
        .groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
        .filter(fold("doc_id", folds) != 0)
    )
    n = marked.count()
    if n > bound:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_SCALE)) < int(bound / n * _SCALE))
    texts = pick(docs, doc_id=id_col, text=text_col).withColumn("text", text_of())
    return texts.join(F.broadcast(marked), "doc_id"), min(n, bound)


def scores(docs: DataFrame, make: Callable[[], ScoreTexts], threshold: float, folds: int = FOLDS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            found = [x for texts in each_text(batch["text"]) for x in score(texts)]
            yield pa.record_batch([batch["doc_id"], pa.array(found, pa.float64())], names=["doc_id", "score"])

    texts = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, make: Callable[[], ScoreTexts], wanted: Callable[[float], bool],
         text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text's score is wanted. Only texts go to Python, and
    only verdicts come back."""
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = make()
        for column in columns:
            yield pa.array([bool(wanted(x)) for texts in each_text(column) for x in score(texts)], pa.bool_())

    verdict = F.arrow_udf(run, "boolean", ArrowUDFType.SCALAR_ITER)
    return docs.filter(verdict(F.col(f"`{text_col}`")))
