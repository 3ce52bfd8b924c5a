"""From raw documents to packed training sequences: four stages, each stored before the next.

Low quality goes, then toxic text, then all but one document of each group of near copies; what is
left is tokenised and packed. A stage learns and compares on what its predecessor kept. A null text
counts as empty, an empty one scores as the classifiers say and links with nothing; rows that repeat
an id are one document for the join, of which one row stays; empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snapledger.llm import bpe, jaccard, pack, quality, toxicity
from snapledger.llm.common import table, write_once


# Rows of an Arrow batch. Spark's 10,000 are meant for rows of some numbers; these are whole texts, and
# an executor holds several batches at once.
BATCH_ROWS = 1_000


def bounded(spark: SparkSession) -> None:
    """Let the session send texts to Python in batches of ``BATCH_ROWS``, now and when results are read."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return quality.good(docs, table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return jaccard.one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return pack.pack(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.path(bpe.RANKS),
                     keep_ids=False)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack_sequences),
]

# The classifiers can't be put in SQL; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
