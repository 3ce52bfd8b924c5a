"""Quality checks as data: every check yields (check, n_checked, n_bad)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(RuntimeError):
    """Raised with every failed check, not only the first."""

    def __init__(self, failures: list[tuple[str, int]]):
        self.failures = failures
        super().__init__("; ".join(f"{name}: {bad} bad" for name, bad in failures))


def union_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def count_bad(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Count the rows that break each rule, all rules in one scan and one aggregate row."""
    aggregates = [F.count_if(bad).alias(f"bad_{i}") for i, bad in enumerate(rules.values())]
    totals = df.agg(F.count(F.lit(1)).alias("n_checked"), *aggregates)
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col("n_checked").alias("n_checked"),
            F.col(f"bad_{i}").alias("n_bad"),
        )
        for i, name in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*rows)))


def not_empty_check(name: str, df: DataFrame) -> DataFrame:
    """A table without rows is one bad finding."""
    return df.agg(F.count(F.lit(1)).alias("n_checked")).select(
        F.lit(name).alias("check"), "n_checked",
        F.when(F.col("n_checked") == 0, 1).otherwise(0).cast("bigint").alias("n_bad"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def duplicate_key_check(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return count_bad(per_key, {name: F.col("n_rows") > 1})


def _variants(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key: rows and distinct value combinations, NULLs counting as values.

    Combinations are counted first. Both steps hash and combine on the map side, so the
    copies of a hot key shrink before they travel; minima of text values would sort all
    rows instead, and a hash of the values could miss a conflict.
    """
    combinations = df.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("_n"))
    return combinations.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("_variants"))


def conflicting_duplicates(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys whose rows disagree on ``values``, with their row count."""
    return _variants(df, keys, values).filter("_variants > 1").drop("_variants")


def conflict_check(
    name: str, df: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    return count_bad(_variants(df, keys, values), {name: F.col("_variants") > 1})


def collapse_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. Rows of a key that differ collapse to the greatest by column order,
    so the outcome never depends on how Spark happened to order its input."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def missing_keys(
    df: DataFrame, reference: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Distinct keys of ``df`` that ``reference`` does not hold.

    Keys are made distinct before the join, so a key that holds a large share of the
    rows has already shrunk to one row per map task when it is shuffled.
    """
    return df.select(*keys).distinct().join(reference.select(*keys), list(keys), "left_anti")


def missing_key_check(
    name: str, df: DataFrame, reference: DataFrame, keys: Sequence[str]
) -> DataFrame:
    present = reference.select(*keys).distinct().withColumn("_known", F.lit(True))
    joined = df.select(*keys).distinct().join(present, list(keys), "left")
    return count_bad(joined, {name: F.col("_known").isNull()})


def codes_without_label(df: DataFrame, code: str, label: str) -> DataFrame:
    """Codes for which no row carries a non-blank label."""
    usable = F.nullif(F.trim(F.col(label)), F.lit(""))
    return (
        df.groupBy(code).agg(F.max(usable).alias("_label"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("_label").isNull()).drop("_label")
    )


def enforce(checks: DataFrame) -> None:
    """Raise if any check found bad rows. Reads one row per failed check."""
    failed = checks.filter("n_bad > 0").orderBy("check").collect()
    if failed:
        raise CheckFailed([(row["check"], row["n_bad"]) for row in failed])
