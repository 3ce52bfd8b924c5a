"""What every single file of a drop holds, read from the Parquet footers.

A frame's schema, with or without ``mergeSchema``, cannot tell that one file of a table lacks a
column or stores it as another type. Here each file answers for itself, and no data page is read.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.sources.columns import Alias

FILE_SCHEMAS = "file string, columns array<struct<name: string, type: string>>"
_READERS = 32  # footers the driver asks for at a time, where tasks cannot open the store


def _reachable(path: str) -> bool:
    """Whether Python can open the store; Spark's readers know more of them."""
    try:
        store, inside = fs.FileSystem.from_uri(path)
        return store.get_file_info(inside).type != fs.FileType.NotFound
    except (pa.ArrowException, OSError, ValueError):
        return False


def _in_tasks():
    """A function for ``mapInArrow``: (path) -> one row of ``FILE_SCHEMAS`` per file.

    Self-contained, so that workers need pyarrow and not this package.
    """
    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_type

        kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))

        def spark_name(stored):
            try:
                return from_arrow_type(stored, prefer_timestamp_ntz=True).simpleString()
            except Exception:  # a type that Spark has no name for keeps its own
                return str(stored)

        def columns(path):
            store, inside = fs.FileSystem.from_uri(path)
            with store.open_input_file(inside) as file:
                try:
                    schema = pq.read_schema(file)
                except pa.ArrowInvalid:  # not a Parquet file, or cut short
                    return None
            return [{"name": f.name, "type": spark_name(f.type)} for f in schema]

        for batch in batches:
            paths = batch.column(0)
            found = [columns(path.as_py()) for path in paths]
            yield pa.RecordBatch.from_arrays(
                [paths.cast(pa.string()), pa.array(found, kind)], ["file", "columns"])

    return read


def _by_spark(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same through Spark's own reader: one small job per file, some at a time."""
    def columns(path):
        try:
            schema = spark.read.parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise
            return None
        except Exception as error:
            if "CANNOT_READ_FILE_FOOTER" not in str(error) and "is not a Parquet file" not in str(error):
                raise
            return None
        return [(f.name, f.dataType.simpleString()) for f in schema]

    with ThreadPoolExecutor(_READERS) as pool:
        return spark.createDataFrame(list(zip(paths, pool.map(columns, paths), strict=True)), FILE_SCHEMAS)


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(file, columns) of every Parquet file at or below ``path``, types as Spark names them.

    ``columns`` is NULL for a file without a readable footer. Tasks read the footers where pyarrow
    can open the store; other stores are asked through Spark's reader, file by file. A path
    without files gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path).select("path")
    first = files.head()
    if first is None:
        return spark.createDataFrame([], FILE_SCHEMAS)
    if _reachable(first["path"]):
        return files.mapInArrow(_in_tasks(), FILE_SCHEMAS)
    return _by_spark(spark, [row["path"] for row in files.toLocalIterator()])


def column_types(files: DataFrame) -> DataFrame:
    """(column, type, n_files) over ``file_schemas``, names compared without regard to case.

    A column with several rows is stored in several ways.
    """
    return (
        files.select(F.inline("columns")).groupBy(F.lower("name").alias("column"), "type")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def file_report(table: str, files: DataFrame, roles: Mapping[str, Alias]) -> DataFrame:
    """(source_table, file, role, column_name, column_type, status) for every file and role.

    Status is ``UNREADABLE`` (no footer), ``MISSING`` (required, no column), ``ABSENT`` (optional, no column in
    any file), ``PARTIAL`` (optional, and other files hold it), ``DRIFT`` (another column or type than
    most files have, ties to the smaller name) or ``OK``. Files are never grouped by table in one
    task: a role's usual column is a count per (role, column, type).
    """
    def filling(alias: Alias) -> Column:
        """The column of the file that fills a role: best name first, any case."""
        def named(wanted: str) -> Column:
            return F.get(F.filter("columns", lambda c: F.lower(c["name"]) == wanted.lower()), F.lit(0))

        return F.coalesce(*map(named, alias.names))

    rows = [
        F.struct(F.lit(role).alias("role"), F.lit(alias.required).alias("required"), filling(alias).alias("held"))
        for role, alias in roles.items()
    ]
    seen = files.select("file", F.col("columns").isNull().alias("broken"), F.inline(F.array(*rows)))
    name, kind = F.lower("held.name"), F.col("held.type")
    seen = seen.select("*", name.alias("_name"), kind.alias("_type"))
    counts = seen.filter("held IS NOT NULL").groupBy("role", "_name", "_type").agg(F.count(F.lit(1)).alias("n"))
    usual = counts.groupBy("role").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "_name", "_type")).alias("usual"))
    # one row per role
    joined = seen.join(F.broadcast(usual), "role", "left")
    same = (F.col("_name") == F.col("usual._name")) & (F.col("_type") == F.col("usual._type"))
    status = (
        F.when(F.col("broken"), "UNREADABLE")
        .when(F.col("held").isNull() & F.col("required"), "MISSING")
        .when(F.col("held").isNull() & F.col("usual").isNull(), "ABSENT")
        .when(F.col("held").isNull(), "PARTIAL")
        .when(~same, "DRIFT").otherwise("OK")
    )
    return joined.select(
        F.lit(table).alias("source_table"), "file", "role", F.col("held.name").alias("column_name"),
        F.col("held.type").alias("column_type"), status.alias("status"))


def file_checks(report: DataFrame) -> DataFrame:
    """A report as checks: per table the files without a footer, a required column, or the usual type."""
    def bad(check: str, status: str) -> Column:
        return F.struct(
            F.concat("source_table", F.lit(f":{check}")).alias("check"), F.col("n_checked"),
            F.col(status).alias("n_bad"))

    # a file without a footer counts once, not once per role
    found = report.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("n_checked"),
        F.count_if(F.col("status") == "MISSING").alias("missing"),
        F.count_if(F.col("status") == "DRIFT").alias("drift"),
        F.count_distinct(F.when(F.col("status") == "UNREADABLE", F.col("file"))).alias("unreadable"))
    return found.select(F.inline(F.array(
        bad("every_file_has_columns", "missing"), bad("one_type_per_column", "drift"),
        bad("readable_footers", "unreadable"))))
