"""What the corpus operators share: words, folds, tables written once, ranks without a hot group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapledger.storage.workdir import new_dir, write_once

__all__ = ["each_text", "fold", "new_dir", "pick", "rank_within", "table", "text_of", "word_hashes", "words", "write_once"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names, so that others can't clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % k


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased UTF-8 words between the six ASCII white spaces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def each_text(column: pa.Array, size: int = 128) -> Iterator[list[str]]:
    """The texts of an Arrow column, some at a time, so that a batch is never held twice; null is empty."""
    for start in range(0, len(column), size):
        yield ["" if text is None else text for text in column.slice(start, size).to_pylist()]


def word_hashes(tokens: Iterable[bytes], count: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, count)


def rank_within(df: DataFrame, key: str, order: list[str], rank: str, buckets: int) -> DataFrame:
    """Rows numbered from 0 within each ``key``, gapless, without one task per key.

    Rows of a key are dealt to ``buckets`` by a hash of the ordering columns, numbered there, and
    moved on by the row counts of the key's earlier buckets. Choose ``buckets`` with the row count.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_row", F.row_number().over(inside) - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(rank, F.col("_start") + F.col("_row"))
        .drop("_bucket", "_start", "_row")
    )
