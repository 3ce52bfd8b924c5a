"""Publishing tables as one unit: write, validate what was written, then commit.

Every run writes new folders; readers follow the newest commit, one small JSON record that
lists the folders of every table, with its schema and its rows. Until it is appended nothing of the
run is visible, and a run that dies leaves the previous state as it was. One pipeline publishes at a
time.

Row counts and column rules are observed by the write itself, in the tasks that store the rows. Spark
counts such a task once, however often executors are lost, so the counts are those of the files;
a recount of the files guards the commit. Histories are compared by keys and hashes, and only the
partitions in which something happened are written again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.operators import history as hist
from snapledger.operators.checkplan import CheckPlan
from snapledger.operators.checks import CheckFailed, enforce, not_empty_check, union_checks
from snapledger.storage.contracts import Contract
from snapledger.storage.workdir import new_dir

COMMIT_SCHEMA = (
    "seq bigint, run_id string, tables map<string, array<string>>, schemas map<string, string>, "
    "rows map<string, bigint>")
ROW_HASH = "_row_hash"
Checks = Callable[[Mapping[str, DataFrame]], "DataFrame | CheckPlan"]


@dataclass(frozen=True)
class Commit:
    seq: int
    run_id: str
    tables: dict[str, list[str]]
    schemas: dict[str, str]
    rows: dict[str, int] | None = None


@dataclass(frozen=True)
class Written:
    """What a write stored, counted by the tasks that stored it."""

    path: str
    rows: int
    bad: dict[str, int] = field(default_factory=dict)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All commit records; empty before the first."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).json(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def latest_commit(spark: SparkSession, root: str) -> Commit | None:
    """The newest commit record, one row."""
    row = commits(spark, root).orderBy(F.desc("seq")).limit(1).first()
    return None if row is None else Commit(**row.asDict())


def _open(spark: SparkSession, commit: Commit, table: str) -> DataFrame:
    """A table of a commit, read with the schema it was published under: left to itself,
    Spark would take a partition value such as 2009-10 for a month."""
    folders = commit.tables[table]
    schema = T.StructType.fromJson(json.loads(commit.schemas[table])) if table in commit.schemas else None
    if any("/segment=" in f for f in folders):
        return _read_segments(spark, folders, schema)
    if schema is None:
        return spark.read.parquet(*folders)
    return spark.read.schema(schema).parquet(*folders).select(*schema.names)


def _read_segments(spark: SparkSession, folders: Sequence[str], schema: T.StructType | None) -> DataFrame:
    """Folders of a history. Their files hold all columns, so no name of a folder is read as a value."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema is not None else reader).parquet(*folders)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as last published. ``<table>_history`` reads the history."""
    commit = latest_commit(spark, root)
    if commit is None or table not in commit.tables:
        raise LookupError(f"{table} is not published in {root}")
    return _open(spark, commit, table)


def read_versions(
    spark: SparkSession, root: str, table: str, wanted: Sequence[Mapping[str, object]]
) -> DataFrame:
    """All versions of a few keys. Histories are stored sorted by key, so the scan skips the row
    groups that hold none of them. For very many keys use ``history.history_lookup``."""
    if not wanted:
        raise ValueError("no key to look up")
    return read_table(spark, root, f"{table}_history").filter(hist.lookup_filter(wanted))


def ready_checks(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """Published and not empty, for each table; an unpublished table raises. The commit knows
    the rows of its tables; those of an older commit without counts are read."""
    commit = latest_commit(spark, root)
    counts = (commit.rows or {}) if commit else {}
    parts = [
        not_empty_check(f"{t}:not_empty", read_table(spark, root, t).select(F.lit(1)))
        for t in tables if commit is None or t not in counts or t not in commit.tables]
    known = [(f"{t}:not_empty", counts[t], int(counts[t] == 0)) for t in tables if t in counts]
    if known:
        parts.append(spark.createDataFrame(known, "check string, n_checked bigint, n_bad bigint"))
    return union_checks(*parts)


def recount(spark: SparkSession, root: str, tables: Sequence[str] | None = None) -> DataFrame:
    """Rows that readers find in each published table against the rows its commit recorded.
    Counts come from the footers of the files."""
    commit = latest_commit(spark, root)
    rows = (commit.rows or {}) if commit else {}
    found = []
    for table in tables or sorted(rows):
        n = _open(spark, commit, table).count()
        found.append((f"{table}:recount", n, abs(n - rows[table])))
    return spark.createDataFrame(found, "check string, n_checked bigint, n_bad bigint")


def _write(
    df: DataFrame, path: str, partition_by: Sequence[str], facts: Mapping[str, Column]
) -> dict[str, int]:
    """Write one folder; the values of ``facts`` over the rows, from the same job.

    The facts are aggregates right below the writer, behind every shuffle: each stored row is
    in them once.
    """
    seen = Observation()
    out = df.observe(seen, *[a.alias(name) for name, a in facts.items()]).write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    return dict(seen.get)


def stage(df: DataFrame, contract: Contract, path: str, row_hash: bool = False) -> Written:
    """Write one table; the rows stored and the rows that break each rule of the contract.

    A partitioned table is rebalanced by its partition columns, so that a task does not
    write a file into every partition; AQE splits a partition that holds too many rows.
    ``row_hash`` stores the hash a history compares by.
    """
    rows = contract.conform(df, mark_rejects=True)
    if row_hash:
        rows = rows.withColumn(ROW_HASH, hist.row_hash(contract.columns, contract.keys))
    if contract.partition_by:
        rows = rows.hint("rebalance", *[F.col(c) for c in contract.partition_by])
    rules = contract.rules(rows)
    facts = {"rows": F.count(F.lit(1))}
    facts |= {f"bad_{i}": F.count_if(bad) for i, bad in enumerate(rules.values())}
    seen = _write(rows, path, contract.partition_by, facts)
    return Written(path, seen.get("rows") or 0, {
        name: seen.get(f"bad_{i}") or 0 for i, name in enumerate(rules)})


def staged_table(spark: SparkSession, contract: Contract, path: str, row_hash: bool = False) -> DataFrame:
    schema = contract.staged_schema
    return spark.read.schema(schema.add(ROW_HASH, "string") if row_hash else schema).parquet(path)


@dataclass
class _Step:
    """A table's next history: its folders and rows."""

    folders: list[str]
    rows: int


def _history_schema(table: T.StructType) -> T.StructType:
    meta = [T.StructField(n, T.DataType.fromDDL(t)) for n, t in hist.META.items()]
    return T.StructType([T.StructField(f.name, f.dataType) for f in table] + meta)


def _is_current(folder: str) -> bool:
    return "/segment=current" in folder


def _split_by(contract: Contract) -> tuple[str, ...]:
    """Columns whose values have a folder each in the history: a key never moves between them."""
    return contract.partition_by if set(contract.partition_by) <= set(contract.keys) else ()


def _folder(columns: Sequence[str]) -> Column:
    """The part of a folder's path that these columns make."""
    parts = [part for c in columns for part in (F.lit(f"/at_{c}="), F.col(c).cast("string"))]
    return F.concat(*parts) if parts else F.lit("")


def _write_segment(versions: DataFrame, contract: Contract, path: str) -> dict[str, int]:
    """Write the current and the closed rows of a step, each file sorted by key: its row groups
    hold neighbouring keys, so that a lookup skips most of them."""
    segment = F.when(F.col("is_current") == 1, "current").otherwise("closed")
    split = _split_by(contract)
    placed = versions.withColumns({"segment": segment} | {f"at_{c}": F.col(c) for c in split})
    by = ["segment", *[f"at_{c}" for c in split]]
    order = [*by, *[k for k in contract.keys if k not in split], "version_no"]
    spread = placed.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*order)
    return _write(spread, path, by, {
        "rows": F.count(F.lit(1)), "current": F.count_if(F.col("is_current") == 1)})


def _stage_history(
    spark: SparkSession, contract: Contract, snapshot: DataFrame, n_rows: int, previous: Commit | None,
    root: str, run_id: str, now: datetime,
) -> _Step:
    """Write the next history segment; the history as it was if nothing happened.

    A segment holds current rows and the rows this run closed, by partition of the table. Keys and
    hashes are compared once and the changes stored; only partitions with changes are read whole and
    written again, all others stay where earlier runs put them. Closed rows are written once and
    never read again. Keys that are repeated or incomplete are findings of the comparison.
    """
    name = f"{contract.table}_history"
    known = previous.tables if previous else {}
    keys, path = list(contract.keys), f"{root}/{name}/{run_id}"
    if name in known:
        n_before = (previous.rows or {}).get(name)
        step = _Step(known[name], n_before if n_before is not None else _open(spark, previous, name).count())
        stored = [f for f in step.folders if _is_current(f)]
        schema = _read_segments(spark, stored, None).schema if name not in previous.schemas else \
            T.StructType.fromJson(json.loads(previous.schemas[name]))
    elif contract.table in known:
        before = _open(spark, previous, contract.table)
        step = _first_history(before.withColumn(
            ROW_HASH, hist.row_hash(before.columns, keys)), contract, f"{path}-baseline", now)
        schema = _history_schema(before.select(*keys, *[c for c in before.columns if c not in keys]).schema)
    else:
        return _first_history(snapshot, contract, path, now)

    stored = [f for f in step.folders if _is_current(f)]
    current = _read_segments(spark, stored, schema)
    hist.guard_schema(snapshot.drop(ROW_HASH), keys, current)
    changes_path = new_dir(spark, "changes")
    found = _store_changes(current, snapshot, keys, changes_path)
    try:
        enforce(hist.counted_checks(spark, {
            f"{contract.table}:unique_key": found.repeated_snapshot,
            "history:one_current_row": found.repeated_current, "history:keys_not_null": found.null_keys,
            "history:live_rows_equal_snapshot": found.live - n_rows}))
        if not found.any:
            return step
        changes = spark.read.parquet(changes_path)
        split = _split_by(contract)
        # as many values as partitions with a change, which the commit lists one by one
        touched = [r[0] for r in changes.select(_folder(split)).distinct().collect()]
        kept, again = _touched_folders(spark, stored, touched)
        part = _read_segments(spark, again, schema) if again else spark.createDataFrame([], schema)
        n_part = part.count()
        here = snapshot.filter(_folder(split).isin(touched)) if split else snapshot
        stamp = F.lit(hist.stamp_after(found.last_stamp, now))
        versions = hist.apply_changes(part, changes, here, keys, stamp)
        seen = _write_segment(versions, contract, path)
        facts = hist.step_facts(found, n_rows, n_part, seen) | _recounted(spark, name, path, seen["rows"])
        enforce(hist.step_checks(versions, here, keys, part, facts))
    finally:
        _discard(spark, changes_path)
    mine = [f"{path}/segment=current"]
    if seen["rows"] > seen["current"]:
        mine = [f"{path}/segment=closed", *mine]
    closed = [f for f in step.folders if not _is_current(f)]
    return _Step([*closed, *kept, *mine], step.rows + sum(found.opened.values()))


def _first_history(snapshot: DataFrame, contract: Contract, path: str, now: datetime) -> _Step:
    rows = hist.opened_rows(snapshot, contract.keys, F.lit(now))
    seen = _write_segment(rows, contract, path)
    return _Step([f"{path}/segment=current"], seen.get("rows") or 0)


def _store_changes(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], path: str) -> hist.Changed:
    """Store keys and events of what changed; the facts about all keys come from the same job."""
    events, facts = hist.change_set(current, snapshot, keys)
    seen = Observation()
    happened = events.observe(seen, *[a.alias(n) for n, a in facts.items()]).filter(
        F.col("_event").isin(*hist.KINDS))
    happened.drop("_stamp").write.parquet(path)
    return hist.changed(seen.get)


def _touched_folders(
    spark: SparkSession, folders: Sequence[str], touched: Sequence[str]
) -> tuple[list[str], list[str]]:
    """(folders that stay, folders to write again): a run's folder is listed by partition as soon
    as one of its partitions is written again. A folder without partitions is written whole."""
    context = spark.sparkContext
    ends = tuple(f"/segment=current{v}" for v in touched) + ("/segment=current",)
    stay, again = [], []
    for folder in folders:
        leaves, open_ = [], [folder]
        while open_:
            name = open_.pop()
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            inside = path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path)
            below = [s.getPath().getName() for s in inside if s.isDirectory() and "=" in s.getPath().getName()]
            open_ += [f"{name}/{b}" for b in below]
            leaves += [] if below else [name]
        # a value's special characters are escaped in the name of its folder
        hit = [f for f in leaves if unquote(f).endswith(ends)]
        again += hit
        stay += [f for f in leaves if f not in hit] if hit else [folder]
    return sorted(stay), sorted(again)


def publish(
    spark: SparkSession, root: str, run_id: str,
    outputs: Sequence[tuple[Contract, DataFrame]],
    keep_history: Sequence[str] = (),
    checks: Checks | None = None,
    expected_rows: Mapping[str, int] | None = None,
    may_be_empty: Sequence[str] = (),
    now: datetime | None = None,
) -> Commit:
    """Publish several tables and their histories with one commit.

    ``checks`` sees the staged tables by name and yields findings next to the contracts'
    own, best as a ``CheckPlan``, whose checks then share the scans of the staged tables.
    ``expected_rows`` says how many rows a table must have; in any case the files must hold as
    many as were written. A failed run raises before anything becomes visible, and what it staged
    is deleted. Repeating the run id of a committed run changes nothing.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run_id):
        raise ValueError(f"unsafe run id: {run_id!r}")
    for contract, _ in outputs:
        if contract.table in keep_history and contract.layer == "report":
            raise ValueError(f"{contract.table}: reports keep no history")
    previous = latest_commit(spark, root)
    if previous and not commits(spark, root).filter(F.col("run_id") == run_id).isEmpty():
        return previous
    now = now or datetime.now(timezone.utc)

    try:
        paths, rows = _write_checked(
            spark, root, run_id, outputs, keep_history, checks, expected_rows or {}, may_be_empty,
            previous, now)
    except Exception:
        for contract, _ in outputs:
            for folder in (contract.table, f"{contract.table}_history"):
                _discard(spark, f"{root}/{folder}/{run_id}")
                _discard(spark, f"{root}/{folder}/{run_id}-baseline")
        raise

    schemas = {contract.table: contract.schema.json() for contract, _ in outputs}
    schemas |= {
        f"{contract.table}_history": _history_schema(contract.schema).json() for contract, _ in outputs
        if f"{contract.table}_history" in paths}
    commit = Commit(
        seq=(previous.seq if previous else 0) + 1, run_id=run_id,
        tables={**(previous.tables if previous else {}), **paths},
        schemas={**(previous.schemas if previous else {}), **schemas},
        rows={**((previous.rows or {}) if previous else {}), **rows})
    record = spark.createDataFrame(
        [(commit.seq, run_id, commit.tables, commit.schemas, commit.rows)], COMMIT_SCHEMA)
    record.coalesce(1).write.mode("append").json(f"{root}/commits")
    return commit


def _discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of a run that failed; nothing refers to it."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _recounted(spark: SparkSession, table: str, folder: str, rows: int) -> dict[str, int]:
    """The files of a folder must hold the rows that were written."""
    return {f"{table}:recount": spark.read.schema("_none int").parquet(folder).count() - rows}


def _write_checked(
    spark: SparkSession, root: str, run_id: str, outputs: Sequence[tuple[Contract, DataFrame]],
    keep_history: Sequence[str], checks: Checks | None, expected_rows: Mapping[str, int],
    may_be_empty: Sequence[str], previous: Commit | None, now: datetime,
) -> tuple[dict[str, list[str]], dict[str, int]]:
    """Stage all tables, check them, step their histories; folders and rows by table."""
    paths, rows, staged, hashed, failed = {}, {}, {}, {}, []
    plan = CheckPlan()
    for contract, df in outputs:
        table, path = contract.table, f"{root}/{contract.table}/{run_id}"
        with_history = table in keep_history
        written = stage(df, contract, path, row_hash=with_history)
        paths[table], rows[table] = [path], written.rows
        found = dict(written.bad)
        if written.rows:
            found |= _recounted(spark, table, path, written.rows)
        if table not in may_be_empty:
            found[f"{table}:not_empty"] = int(written.rows == 0)
        if table in expected_rows:
            found[f"{table}:expected_rows"] = written.rows - expected_rows[table]
        failed += [(name, abs(bad)) for name, bad in found.items() if bad]
        whole = staged_table(spark, contract, path, with_history)
        staged[table] = whole.select(*contract.columns)
        hashed[table] = whole.select(*contract.columns, ROW_HASH) if with_history else None
        if not with_history or not previous or not {table, f"{table}_history"} & set(previous.tables):
            # else the comparison with the history tells repeated keys
            plan.unique(f"{table}:unique_key", staged[table], contract.keys)
    if checks is not None:
        plan.add(checks(staged))
    failed += [(name, bad) for name, (_, bad) in plan.findings().items() if bad]
    if failed:
        raise CheckFailed(sorted(failed))

    for contract, _ in outputs:
        table = contract.table
        if hashed[table] is not None:
            step = _stage_history(spark, contract, hashed[table], rows[table], previous, root, run_id, now)
            paths[f"{table}_history"], rows[f"{table}_history"] = step.folders, step.rows
    return paths, rows
