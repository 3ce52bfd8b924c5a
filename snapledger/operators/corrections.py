"""Reversible point corrections and reject quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.casts import readable
from snapledger.operators.checks import count_bad


def correction_status(
    df: DataFrame, corrections: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    """One row per correction key: counts on both sides, delta, status and reason.

    A correction is refused unless it names exactly one row, once, changes its value, and both
    the value and the result are whole numbers from zero on.
    """
    asked = corrections.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_corrections"), F.max("delta").alias("delta"))
    hits = (
        df.select(*keys, readable(df, column, "bigint").alias("_value"))
        .join(asked.select(*keys), list(keys), "left_semi")
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max("_value").alias("_value"))
    )
    joined = asked.join(hits, list(keys), "left").withColumn(
        "n_rows", F.coalesce("n_rows", F.lit(0).cast("bigint")))
    reason = F.concat_ws("; ", *[F.when(bad, text) for text, bad in {
        "no row": F.col("n_rows") == 0,
        "several rows": F.col("n_rows") > 1,
        "several corrections": F.col("n_corrections") > 1,
        "no change": F.coalesce(F.col("delta"), F.lit(0)) == 0,
        "no number to correct": (F.col("n_rows") == 1) & F.col("_value").isNull(),
        "negative result": F.col("_value") + F.col("delta") < 0,
    }.items()])
    status = F.when(reason == "", "APPLIED").otherwise("REFUSED")
    return joined.select(
        *keys, "n_corrections", "n_rows", "delta", status.alias("status"), reason.alias("reason"))


def correction_check(
    df: DataFrame, corrections: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    status = correction_status(df, corrections, keys, column)
    return count_bad(status, {"corrections:all_applied": F.col("status") == "REFUSED"})


def apply_corrections(
    df: DataFrame, corrections: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    """Add ``delta`` to one column of the rows that ``corrections`` (keys, delta) names.

    Sources stay untouched: dropping the overlay restores the original. A refused correction
    (see ``correction_status``) changes nothing, the column keeps its type, and ``corrected``
    marks the rows that changed.
    """
    usable = correction_status(df, corrections, keys, column).filter("status = 'APPLIED'").select(
        *keys, F.col("delta").alias("_delta"))
    kind = df.schema[column].dataType
    value = F.when(
        F.col("_delta").isNotNull(), (readable(df, column, "bigint") + F.col("_delta")).cast(kind)
    ).otherwise(F.col(column))
    joined = df.join(usable, list(keys), "left")
    return joined.select(
        *[value.alias(c) if c == column else F.col(c) for c in df.columns],
        F.col("_delta").isNotNull().cast("tinyint").alias("corrected"),
    )


def reject_reasons(rules: Mapping[str, Column]) -> Column:
    """Names of the broken rules, joined by '; ', empty for a good row."""
    return F.concat_ws("; ", *[F.when(bad, F.lit(name)) for name, bad in rules.items()])


def accepted_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.filter(reject_reasons(rules) == "")


def quarantine(
    df: DataFrame, rules: Mapping[str, Column], batch_id: str, entity: str, period: Column,
    record: Sequence[str] | None = None,
) -> DataFrame:
    """Rejected rows as records: reasons, the source row as JSON, and its SHA-256 as id.

    ``record`` limits the JSON to some columns.
    """
    source = F.to_json(F.struct(*(record or df.columns)), {"ignoreNullFields": "false"})
    return (
        df.select(
            period.alias("academic_year"), reject_reasons(rules).alias("reason"),
            source.alias("source_record"),
        )
        .filter("reason <> ''")
        .select(
            F.lit(batch_id).alias("batch_id"), F.lit(entity).alias("entity"),
            F.sha2("source_record", 256).alias("record_id"), "academic_year", "reason",
            "source_record",
        )
    )


def batch_counts(df: DataFrame, rules: Mapping[str, Column], period: Column) -> DataFrame:
    """Source, accepted and rejected rows per period."""
    good = reject_reasons(rules) == ""
    return df.select(period.alias("academic_year"), good.alias("_good")).groupBy("academic_year").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if("_good").alias("accepted_rows"),
        F.count_if(~F.col("_good")).alias("rejected_rows"),
    )
