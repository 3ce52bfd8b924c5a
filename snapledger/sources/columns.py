"""Column names that drift from year to year: aliases, optional roles, schema rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.operators.checks import union_checks


class ColumnMissing(RuntimeError):
    pass


@dataclass(frozen=True)
class Alias:
    """Accepted names of one role, best first."""

    names: tuple[str, ...]
    required: bool = True


def first_present(columns: Sequence[str], alias: Alias) -> str | None:
    by_lower = {c.lower(): c for c in columns}
    return next((by_lower[n.lower()] for n in alias.names if n.lower() in by_lower), None)


def resolve_columns(df: DataFrame, roles: Mapping[str, Alias]) -> dict[str, str | None]:
    """Role -> actual column name, ignoring case; None for an absent optional role."""
    found = {role: first_present(df.columns, alias) for role, alias in roles.items()}
    missing = [r for r, name in found.items() if name is None and roles[r].required]
    if missing:
        wanted = {r: roles[r].names for r in missing}
        raise ColumnMissing(f"no column for {wanted}; available: {sorted(df.columns)}")
    return found


def schema_report(table: str, df: DataFrame, roles: Mapping[str, Alias]) -> DataFrame:
    """One row per role: the column that fills it, its status, rows and NULLs.

    Read the frame with ``mergeSchema`` so that every file counts, not only the first.
    Status is ``OK``, ``ABSENT`` (optional) or ``MISSING`` (required).
    """
    found = {role: first_present(df.columns, alias) for role, alias in roles.items()}
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{i}")
          for i, name in enumerate(found.values()) if name],
    )

    def row(i, role, name):
        status = "OK" if name else "MISSING" if roles[role].required else "ABSENT"
        return F.struct(
            F.lit(table).alias("source_table"),
            F.lit(role).alias("role"),
            F.lit(name).cast("string").alias("column_name"),
            F.lit(status).alias("status"),
            F.col("n_rows").alias("n_rows"),
            (F.col(f"null_{i}") if name else F.col("n_rows")).alias("n_null"),
        )

    rows = [row(i, role, name) for i, (role, name) in enumerate(found.items())]
    return totals.select(F.inline(F.array(*rows)))


def schema_rules(table: str, df: DataFrame, roles: Mapping[str, Alias]) -> DataFrame:
    """(source_table, role, column_name, status) from the frame's schema alone: no data is read."""
    found = {role: first_present(df.columns, alias) for role, alias in roles.items()}
    rows = [
        (table, role, name, "OK" if name else "MISSING" if roles[role].required else "ABSENT")
        for role, name in found.items()
    ]
    return df.sparkSession.createDataFrame(
        rows, "source_table string, role string, column_name string, status string")


def schema_checks(reports: Sequence[DataFrame]) -> DataFrame:
    """Schema reports as checks: one finding per required role without a column."""
    parts = [
        r.groupBy("source_table").agg(
            F.count(F.lit(1)).alias("n_checked"),
            F.count_if(F.col("status") == "MISSING").alias("n_bad"),
        ).select(F.concat("source_table", F.lit(":schema")).alias("check"), "n_checked", "n_bad")
        for r in reports
    ]
    return union_checks(*parts)
