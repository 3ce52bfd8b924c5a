"""Tables stored by hash of a key, so that joins on it move neither side.

For frames that are joined on one key again and again: the as-of join of a fact with the school
versions, or the step of a history. A bucket is read by one task and adaptive execution cannot
split it, so a table with heavy keys is refused; joins of tables stored plainly shuffle, and are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.storage.workdir import new_dir

# Lets a table stored by the school code serve joins on the school code and more.
SUBSET_JOINS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


class BucketsSkewed(RuntimeError):
    """Some bucket would hold far more than its share of the rows."""


def bucket_sizes(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, n_rows) as ``store_bucketed`` would lay them out; counted before anything moves."""
    at = F.pmod(F.hash(*keys), F.lit(buckets))
    return df.groupBy(at.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


def stored_sizes(df: DataFrame) -> DataFrame:
    """(bucket, n_rows) of a stored table, from the names and footers of its files."""
    at = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\.c\d+)?\.[^_]*$", 1).cast("int")
    return df.groupBy(at.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


def store_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int,
    most_skew: float = 4.0, least_rows: int = 1_000_000,
) -> DataFrame:
    """Store ``df`` as catalog table ``table`` in ``buckets`` buckets of ``keys``, sorted within files.

    Rows are rebalanced by key first, so a bucket has few files, and a heavy key is written by several
    tasks. What was written is counted: if a bucket holds over ``most_skew`` times the mean and over
    ``least_rows`` rows, the table is dropped and ``BucketsSkewed`` raised. NULL keys share a
    bucket. An existing table of that name is an error. The files lie in the shared work folder; both
    sides of a join need the same ``keys`` and number of buckets.
    """
    spark = df.sparkSession
    if not keys or not set(keys) <= set(df.columns):
        raise ValueError(f"bucket keys {list(keys)} are not all in the frame")
    (df.hint("rebalance", *keys).write.format("parquet").option("path", new_dir(spark, table.replace(".", "-")))
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    stored = spark.table(table)
    sizes = stored_sizes(stored).agg(
        F.max("n_rows").alias("largest"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")).first()
    largest, mean = sizes["largest"] or 0, sizes["n_rows"] / buckets
    if largest > least_rows and largest > most_skew * mean:
        spark.sql(f"DROP TABLE {table}")
        raise BucketsSkewed(
            f"{table}: the largest of {buckets} buckets holds {largest} of {sizes['n_rows']} rows")
    return stored


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forget a stored table; its files go with the work folder."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
