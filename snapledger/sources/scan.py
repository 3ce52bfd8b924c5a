"""Finding, selecting and reading annual Parquet drops."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.sources.footers import column_types, file_schemas

LAYOUT = "{root}/{period}/{table}"
PRESENCE = "period string, run string, table string"


class SourceMissing(RuntimeError):
    pass


class SchemaDrift(RuntimeError):
    """Files of one drop store a column in types that cannot be read together."""


def scan_annual(
    spark: SparkSession, root: str, period: str, table: str, layout: str = LAYOUT,
    merge_schema: bool = False,
) -> DataFrame:
    """One period's drop of one table.

    ``merge_schema`` opens the footer of every file; schema rules need it, plain reads of a
    drop that passed them do not. Files whose types differ are then refused by column.
    """
    path = layout.format(root=root, period=period, table=table)
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise SourceMissing(f"{period}: no drop of {table} at {path}") from error
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        # as many rows as the table has columns and types
        several = column_types(file_schemas(spark, path)).groupBy("column").agg(
            F.sort_array(F.collect_list("type")).alias("types")).filter(F.size("types") > 1).collect()
        found = sorted((r["column"], r["types"]) for r in several)
        raise SchemaDrift(f"{period}: files of {table} differ in {found}") from error


def scan_periods(
    spark: SparkSession, root: str, table: str, period_column: str = "academic_year",
    layout: str = LAYOUT, merge_schema: bool = False,
) -> DataFrame:
    """Every period's drop in one scan, the period taken from the file path.

    For drops that share column names; drops whose names drift are read one by one and
    joined with ``union_periods``.
    """
    pattern = layout.format(root=".*", period="([^/]+)", table=re.escape(table))
    path = F.col("_metadata.file_path")
    df = spark.read.option("mergeSchema", merge_schema).parquet(
        layout.format(root=root, period="*", table=table)
    )
    return df.withColumn(period_column, F.regexp_extract(path, f"{pattern}(/|$)", 1))


def union_periods(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Stack frames by column name. Absent columns become NULL, or an error if not allowed."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def list_tables(spark: SparkSession, root: str, canonical: str, runs: str) -> DataFrame:
    """(period, run, table) for every table folder that holds Parquet files.

    ``canonical`` and ``runs`` are folders below ``root`` laid out ``<period>/<table>`` and
    ``<run>/<period>/<table>``; ``run`` is NULL for canonical drops. Only file names are
    listed, no file is opened.
    """
    def below(folder: str) -> DataFrame | None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet")
        try:
            return reader.load(f"{root}/{folder}").select("path")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    found = [df for df in (below(canonical), below(runs)) if df is not None]
    if not found:
        return spark.createDataFrame([], PRESENCE)
    files = union_periods(found)
    # the root may itself hold folders of these names: only what follows it counts
    bare = re.escape(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/"))
    inside = rf"{bare}/{re.escape(canonical)}/([^/]+)/([^/]+)/"
    in_run = rf"{bare}/{re.escape(runs)}/([^/]+)/([^/]+)/([^/]+)/"
    path = F.col("path")
    from_run = path.rlike(in_run)

    def part(run_group, canonical_group):
        return F.when(from_run, F.regexp_extract(path, in_run, run_group)).otherwise(
            F.regexp_extract(path, inside, canonical_group))

    return files.filter(from_run | path.rlike(inside)).select(
        part(2, 1).alias("period"),
        F.when(from_run, F.regexp_extract(path, in_run, 1)).alias("run"),
        part(3, 2).alias("table"),
    ).distinct()


def complete_runs(
    presence: DataFrame, required: Sequence[str], one_of: Sequence[str] = ()
) -> DataFrame:
    """Pick the run to read for each period: (period, run, one_of_table, n_complete, status).

    ``run`` NULL in ``presence`` means a canonical drop, which wins even when incomplete.
    Otherwise exactly one run must hold every required table and exactly one of ``one_of``;
    status says ``CANONICAL``, ``COMPLETE``, ``AMBIGUOUS`` or ``NONE``.
    """
    def held(name):
        return F.bool_or(F.col("table") == name)

    n_candidates = sum((held(t).cast("int") for t in one_of), F.lit(0))
    candidate = F.max(F.when(F.col("table").isin(*one_of), F.col("table"))) if one_of \
        else F.lit(None).cast("string")
    full = reduce(lambda a, b: a & b, [held(t) for t in required], F.lit(True))
    if one_of:
        full = full & (n_candidates == 1)
    per_run = presence.groupBy("period", "run").agg(
        full.alias("full"), n_candidates.alias("n_candidates"), candidate.alias("candidate"))

    canonical = F.col("run").isNull()
    usable = ~canonical & F.col("full")
    picked = per_run.groupBy("period").agg(
        F.bool_or(canonical).alias("canonical"),
        F.count_if(usable).alias("n_complete"),
        F.max(F.when(usable, F.col("run"))).alias("run"),
        F.max(F.when(usable, F.col("candidate"))).alias("run_table"),
        F.max(F.when(canonical & (F.col("n_candidates") == 1), F.col("candidate")))
        .alias("canonical_table"),
    )
    unique = ~F.col("canonical") & (F.col("n_complete") == 1)
    status = (
        F.when(F.col("canonical"), "CANONICAL").when(unique, "COMPLETE")
        .when(F.col("n_complete") > 1, "AMBIGUOUS").otherwise("NONE")
    )
    return picked.select(
        "period",
        F.when(unique, F.col("run")).alias("run"),
        F.when(F.col("canonical"), F.col("canonical_table"))
        .when(unique, F.col("run_table")).alias("one_of_table"),
        "n_complete",
        status.alias("status"),
    )


def manifest(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(academic_year, table, n_rows) from ``{table: (frame, period expression)}``."""
    counts = [
        df.select(period.alias("academic_year")).groupBy("academic_year")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select("academic_year", F.lit(name).alias("table"), "n_rows")
        for name, (df, period) in tables.items()
    ]
    return union_periods(counts, allow_missing=False)


def write_manifest(rows: DataFrame, path: str) -> None:
    """Store a manifest as JSON. One file: it holds one row per table and period."""
    rows.coalesce(1).write.mode("overwrite").json(path)
