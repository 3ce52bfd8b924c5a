"""Checks that compare totals with their parts, or one report with another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.checks import count_bad


def not_sum(total: str, parts: Sequence[str]) -> Column:
    """A row's total is not the sum of its parts, or one of them is NULL."""
    whole = reduce(add, [F.col(p) for p in parts])
    return ~(F.col(total).isNotNull() & F.col(total).eqNullSafe(whole))


def row_math(df: DataFrame, total: str, parts: Sequence[str], name: str) -> DataFrame:
    """Rows whose total is not the sum of its parts; a NULL among them does not pass."""
    return count_bad(df, {name: not_sum(total, parts)})


def group_vs_all(
    report: DataFrame, group_by: Sequence[str], scope: str, all_label: str, total: str
) -> DataFrame:
    """Per group: the total row's value next to the sum of the other rows."""
    is_all = F.col(scope) == all_label
    return report.groupBy(*group_by).agg(
        F.max(F.when(is_all, F.col(total))).alias("all_total"),
        F.sum(F.when(~is_all, F.col(total)).otherwise(0)).cast("bigint").alias("parts_total"),
    ).withColumn("matches", F.col("all_total").eqNullSafe(F.col("parts_total")))


def full_outer_totals(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], total: str
) -> DataFrame:
    """Both totals per key, from whichever side has it, and whether they agree."""
    joined = actual.select(*keys, F.col(total).alias("actual_total")).join(
        expected.select(*keys, F.col(total).alias("expected_total")), list(keys), "full_outer")
    return joined.withColumn(
        "matches", F.coalesce(F.col("actual_total") == F.col("expected_total"), F.lit(False)))


def fact_vs_report(
    fact_totals: DataFrame, report_totals: DataFrame, keys: Sequence[str], total: str
) -> DataFrame:
    """Every fact group with the report's figure; a missing or different one does not match."""
    joined = fact_totals.select(*keys, F.col(total).alias("fact_total")).join(
        report_totals.select(*keys, F.col(total).alias("report_total")), list(keys), "left")
    return joined.withColumn(
        "matches", F.coalesce(F.col("fact_total") == F.col("report_total"), F.lit(False)))


def mismatch_check(name: str, compared: DataFrame) -> DataFrame:
    return count_bad(compared, {name: ~F.col("matches")})


def within_tolerance(
    observed: DataFrame, expected: DataFrame, keys: Sequence[str], tolerance: Column
) -> DataFrame:
    """Compare observed with expected totals as DECIMAL(38,10).

    Both frames carry ``keys`` and ``total``; ``tolerance`` is an absolute amount. State is
    ``PASS``, ``FAIL``, ``MISSING`` (expected only) or ``UNEXPECTED`` (observed only).
    """
    def exact(c):
        return F.col(c).cast("decimal(38,10)")

    joined = observed.select(*keys, exact("total").alias("observed_total")).join(
        expected.select(*keys, exact("total").alias("expected_total")), list(keys), "full_outer")
    allowed = tolerance.cast("decimal(38,10)")
    apart = F.abs(F.col("observed_total") - F.col("expected_total"))
    state = (
        F.when(F.col("observed_total").isNull(), "MISSING")
        .when(F.col("expected_total").isNull(), "UNEXPECTED")
        .when(apart <= allowed, "PASS").otherwise("FAIL")
    )
    return joined.select(
        *keys, "expected_total", "observed_total", allowed.alias("absolute_tolerance"),
        state.alias("state"),
    )
