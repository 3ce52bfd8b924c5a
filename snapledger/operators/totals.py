"""Reports with total rows: several grouping levels in one result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums(columns: Sequence[str]) -> list[Column]:
    return [F.sum(c).cast("bigint").alias(c) for c in columns]


def multi_level_totals(
    df: DataFrame,
    levels: Sequence[Sequence[str]],
    total_labels: Mapping[str, str],
    measures: Sequence[str],
) -> DataFrame:
    """Sum ``measures`` at every level of ``levels`` (column subsets).

    A column left out of a level shows its total label, decided by ``grouping()`` so that a
    real NULL value is never mistaken for a total. The frame is reduced to the finest level
    first; only that small result is expanded into levels, never the fact itself.
    """
    dims = list(dict.fromkeys(c for level in levels for c in level))
    finest = df.groupBy(*dims).agg(*sums(measures))
    flags = [F.grouping(c).alias(f"_total_{c}") for c in total_labels]
    grouped = finest.groupingSets([list(level) for level in levels], *dims).agg(
        *sums(measures), *flags)
    shown = [
        F.when(F.col(f"_total_{c}") == 1, total_labels[c]).otherwise(F.col(c)).alias(c)
        if c in total_labels else F.col(c)
        for c in dims
    ]
    return grouped.select(*shown, *measures)


def with_total_copies(df: DataFrame, column: str, label: str) -> DataFrame:
    """Every row twice: as it is, and under the total label. For measures that do not add
    up, where a total cannot be derived from its parts."""
    return df.withColumn(column, F.explode(F.array(F.col(column), F.lit(label))))


def sum_where(value: str, cases: Mapping[str, Column]) -> list[Column]:
    """One zero-filled conditional sum per case: a pivot whose columns are known."""
    return [
        F.sum(F.when(case, F.col(value)).otherwise(0)).cast("bigint").alias(name)
        for name, case in cases.items()
    ]


def split_where(value: str, cases: Mapping[str, Column]) -> list[Column]:
    """Like ``sum_where`` before aggregation: the value in the columns whose case holds."""
    return [F.when(case, F.col(value)).otherwise(0).alias(name) for name, case in cases.items()]
