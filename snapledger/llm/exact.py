"""Exact duplicates: the frequent digests are split off, all others are shuffled.

Texts are equal when their SHA-256 digests are. Misra-Gries counters, kept per task and merged in two
steps, name the digests that may be frequent; an exact count verifies them. What is left, at most
``1 / SHARE`` digests, is broadcast with its size and its winner, so that rows of a frequent text are
settled where they are read and never meet in one task. The remaining rows are grouped by a shuffle.

Defined results: a null text counts as empty; a null id is less than any other; of rows that repeat
both the id and the text one stays, and it can't be said which. Texts of any length travel as 32
bytes. Other columns are never read, so their names can't clash. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import pick, text_of, write_once

COUNTERS = 4096  # of one summary
MERGERS = 256  # summaries before the last merge
SHARE = 1024  # frequent: at least one of so many rows


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest, row of every document; ``row`` tells rows apart once it is stored."""
    return pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"))


def candidates(rows: DataFrame, column: str = "digest") -> DataFrame:
    """(item): hashes of values that may be frequent, at most ``COUNTERS``. One summary per task."""
    summaries = (
        rows.select(F.xxhash64(column).alias("item"), F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("part"))
        .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(item, {COUNTERS})").alias("summary")))
    # grouped by a constant: an empty table has no summary to merge
    merged = summaries.groupBy((F.col("part") * 0).alias("all")).agg(
        F.expr(f"approx_top_k_combine(summary, {COUNTERS})").alias("summary"))
    top = F.explode(F.expr(f"approx_top_k_estimate(summary, {COUNTERS})")).alias("top")
    return merged.select(top).select("top.item")


def _sizes(rows: DataFrame) -> DataFrame:
    """digest, group_size, and the doc_id and row that stay."""
    winner = F.max(F.struct("doc_id", "row")).alias("winner")
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), winner)


def frequent(rows: DataFrame, share: int = SHARE) -> DataFrame:
    """The sizes of digests that hold one of ``share`` rows or more: at most ``share``, counted exactly."""
    least = max(2, -(-rows.count() // share))
    maybe = rows.withColumn("item", F.xxhash64("digest")).join(F.broadcast(candidates(rows)), "item", "left_semi")
    return _sizes(maybe).filter(F.col("group_size") >= least)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, dropped ones too.

    ``keep_id`` is the largest id of the equal texts; exactly one row of each group is ``kept``.
    """
    rows = write_once(_digests(docs, id_col, text_col), "digests")
    hot = write_once(frequent(rows, share), "frequent-digests")
    settled = rows.join(F.broadcast(hot), "digest")
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    return settled.unionByName(rest.join(_sizes(rest), "digest")).select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; documents travel once, by id and digest."""
    stays = groups(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest"))
    marked = docs.withColumns({
        "_id": F.col(f"`{id_col}`"),
        "_digest": F.unhex(F.sha2(text_of(f"`{text_col}`").cast("binary"), 256))})
    return (
        marked.dropDuplicates(["_id", "_digest"]).alias("d")
        .join(stays.alias("s"), F.expr("d._id <=> s._id AND d._digest = s._digest"), "left_semi")
        .drop("_id", "_digest"))


def oracle() -> str:
    return """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           sha256(t) AS text_sha256
    FROM d"""
