"""From annual drops to published reports.

Each build publishes layer by layer, and every layer reads what the one before published:
snapshots with their history, then dimensions and school versions, then the fact with its
history, then both reports of the family in one commit.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators.checkplan import CheckPlan
from snapledger.operators.checks import enforce, union_checks
from snapledger.operators.scd2 import scd2_invariants
from snapledger.plans import dims, facts, reports, tables
from snapledger.sources import normalize, scan
from snapledger.sources.columns import schema_checks, schema_rules
from snapledger.sources.footers import file_checks, file_report, file_schemas
from snapledger.storage.publish import Commit, latest_commit, publish, read_table, ready_checks
from snapledger.storage.workdir import write_once

# Source tables of a complete drop.
STUDENT_TABLES = ("mst_state", "mst_district", "mst_sch_category", "sch_enr_fresh")
TEACHER_TABLE = "tch_summary"
SCHOOL_MASTERS = ("school_master", "school_master_local", "sch_master", "sch_master_local")
MANIFEST = (
    "academic_year string, table string, n_rows bigint, source_db string, source_schema string, "
    "school_master_table string, path string")
SNAPSHOT_TABLES = (
    tables.STATES, tables.DISTRICTS, tables.CATEGORIES, tables.SCHOOLS, tables.ENROLLMENT)


@dataclass(frozen=True)
class Drop:
    """One period's raw tables and where they came from."""

    period: str
    source_db: str
    source_schema: str
    school_table: str
    tables: dict[str, DataFrame]
    path: str = ""

    def lineage(self, processed_at: str, table: str | None = None) -> normalize.Lineage:
        return normalize.Lineage(self.source_db, self.source_schema, processed_at, table)


def open_drops(
    spark: SparkSession, root: str, sources: Mapping[str, tuple[str, str]],
    canonical: str = "bronze", runs: str = "bronze_runs", teachers: bool = False,
) -> list[Drop]:
    """Locate and read the drop of every period in ``sources`` (period -> db, schema).

    Raises with every period that has no single complete drop. Every file's schema counts,
    so a column that only some files of a table hold is found. For a teacher build,
    ``teachers`` makes the teacher table part of a complete drop. Brings one row per period to
    the driver.
    """
    presence = scan.list_tables(spark, root, canonical, runs)
    wanted = presence.filter(F.col("period").isin(*sources))
    found = {row["period"]: row for row in scan.complete_runs(
        wanted, (*STUDENT_TABLES, *([TEACHER_TABLE] if teachers else [])), SCHOOL_MASTERS).collect()}
    problems = [
        f"{p}: {found[p]['status'] if p in found else 'NONE'}" for p in sources
        if p not in found or found[p]["one_of_table"] is None
    ]
    if problems:
        raise scan.SourceMissing(f"no single complete drop: {problems}")
    drops = []
    for period, (db, schema) in sources.items():
        run, master = found[period]["run"], found[period]["one_of_table"]
        base = f"{root}/{canonical}" if run is None else f"{root}/{runs}/{run}"
        read = {
            t: scan.scan_annual(spark, base, period, t, merge_schema=True)
            for t in (*STUDENT_TABLES, master)}
        try:
            read[TEACHER_TABLE] = scan.scan_annual(
                spark, base, period, TEACHER_TABLE, merge_schema=True)
        except scan.SourceMissing:
            pass  # only the teacher build needs it
        drops.append(Drop(period, db, schema, master, read, f"{base}/{period}"))
    return drops


def drop_checks(drop: Drop) -> DataFrame:
    """Source schema rules of one drop; where its path is known, of every single file of it.

    A file that calls or stores a column otherwise than the rest would be read as NULL.
    """
    school = {r: a for r, a in normalize.SCHOOL_ROLES.items() if a.required}
    enrollment = {**normalize.ENROLLMENT_ROLES, **normalize.REQUIRED_METRICS}
    found = [(drop.school_table, school), ("sch_enr_fresh", enrollment)]
    if TEACHER_TABLE in drop.tables:
        found.append((TEACHER_TABLE, normalize.TEACHER_ROLES))
    spark = drop.tables[drop.school_table].sparkSession
    merged = schema_checks([
        schema_rules(f"{drop.period}/{table}", drop.tables[table], roles) for table, roles in found])
    if not drop.path:
        return merged
    return union_checks(merged, *[
        file_checks(file_report(
            f"{drop.period}/{table}", file_schemas(spark, f"{drop.path}/{table}"), roles))
        for table, roles in found])


def drop_manifest(drops: list[Drop]) -> DataFrame:
    """Rows per period and source table, with the origin of the drop."""
    parts = [
        scan.manifest({t: (df, F.lit(drop.period)) for t, df in drop.tables.items()}).select(
            "*", F.lit(drop.source_db).alias("source_db"),
            F.lit(drop.source_schema).alias("source_schema"),
            F.lit(drop.school_table).alias("school_master_table"),
            F.lit(drop.path).alias("path"))
        for drop in drops
    ]
    return scan.union_periods(parts, allow_missing=False)


def source_plan(drops: list[Drop]) -> CheckPlan:
    """Everything that is asked of the raw tables, each read once: findings, rows, rows left out."""
    plan = CheckPlan()
    for d in drops:
        plan.add(normalize.snapshot_plan(d.tables[d.school_table], f"{d.period}/"))
        plan.add(normalize.metric_plan(d.tables["sch_enr_fresh"], f"{d.period}/"))
        plan.alias(f"{d.period}/school:rows", f"{d.period}/{d.school_table}:rows")
        plan.alias(f"{d.period}/enrollment:rows", f"{d.period}/sch_enr_fresh:rows")
        for t, df in d.tables.items():
            if t not in (d.school_table, "sch_enr_fresh"):
                plan.count(f"{d.period}/{t}:rows", df)
    return plan


def _per_period(drops: list[Drop], build) -> DataFrame:
    return scan.union_periods([build(drop) for drop in drops])


def publish_snapshots(
    spark: SparkSession, root: str, run_id: str, drops: list[Drop], processed_at: str,
    now: datetime | None = None,
) -> Commit:
    """Normalize all drops and publish the five snapshot tables with their histories.

    One query over all raw tables gives the findings, the row counts of the sources
    (``manifests``), the number of register rows without a school code, which no snapshot holds
    (``left_out``), and the rows that the enrollment must have. After the commit, codes and names
    that mean several things go to ``notes``.
    """
    enforce(union_checks(*[drop_checks(d) for d in drops]))
    found = source_plan(drops).enforce()

    def build(normalizer, table):
        return _per_period(drops, lambda d: normalizer(
            d.tables[table], d.period, d.lineage(processed_at)))

    enrollment = build(normalize.normalize_measures, "sch_enr_fresh")
    schools = _per_period(drops, lambda d: normalize.normalize_snapshot(
        d.tables[d.school_table], d.period, d.lineage(processed_at, d.school_table)))
    outputs = [
        (tables.STATES, build(normalize.normalize_state, "mst_state")),
        (tables.DISTRICTS, build(normalize.normalize_district, "mst_district")),
        (tables.CATEGORIES, build(normalize.normalize_category, "mst_sch_category")),
        (tables.SCHOOLS, schools),
        (tables.ENROLLMENT, enrollment),
    ]

    def cross_checks(staged):
        return (
            CheckPlan()
            .rules(staged["school_category_master"], normalize.category_rules())
            .known("enrollment:school_in_register", staged["enrollment_social_category"],
                   staged["school_master_snapshot"], normalize.SNAPSHOT_KEYS)
        )

    expected = sum(found[f"{d.period}/enrollment:wanted"][0] for d in drops)
    commit = publish(spark, root, f"{run_id}-snapshots", outputs,
                     keep_history=[c.table for c, _ in outputs], checks=cross_checks,
                     expected_rows={tables.ENROLLMENT.table: expected}, now=now)
    manifest = [
        (d.period, t, found[f"{d.period}/{t}:rows"][0], d.source_db, d.source_schema, d.school_table, d.path)
        for d in drops for t in d.tables]
    scan.write_manifest(spark.createDataFrame(manifest, MANIFEST), f"{root}/manifests/{run_id}")
    left_out = [
        (name, found[f"{d.period}/school:rows"][0], found[name][0])
        for d in drops for name in [f"{d.period}/school:blank_code_left_out"]]
    scan.write_manifest(spark.createDataFrame(
        left_out, "check string, n_checked bigint, n_bad bigint"), f"{root}/left_out/{run_id}")
    scan.write_manifest(naming_notes(spark, root), f"{root}/notes/{run_id}")
    return commit


def naming_notes(spark: SparkSession, root: str) -> DataFrame:
    """District codes that several states use, and state names that several codes bear."""
    reused = normalize.reused_district_codes(read_table(spark, root, "district_master"))
    shared = normalize.shared_state_names(read_table(spark, root, "state_master"))
    return union_checks(*[
        df.select(F.lit(kind).alias("note"), "academic_year", F.col(name).alias("value"), "first_state", "last_state")
        for kind, df, name in (("district code in several states", reused, "district_cd"),
                               ("name of several states", shared, "state_name"))])


def publish_dimensions(
    spark: SparkSession, root: str, run_id: str, management_source: DataFrame,
    refresh_management: bool = False,
) -> Commit:
    """Rebuild every dimension, the school versions and their change audit."""
    enforce(ready_checks(spark, root, [c.table for c in SNAPSHOT_TABLES]))
    snapshot = {c.table: read_table(spark, root, c.table) for c in SNAPSHOT_TABLES}
    commit = latest_commit(spark, root)
    stored = read_table(spark, root, "dim_management") \
        if "dim_management" in commit.tables else None
    register = snapshot["school_master_snapshot"]
    management = dims.seed_once(stored, management_source, refresh_management)
    enforce(dims.category_source_checks(snapshot["school_category_master"]))
    versions = facts.dim_school(register)

    def model_checks(staged):
        return union_checks(
            dims.period_checks(staged["dim_academic_year"]),
            CheckPlan().known("dim_management:ids_in_use", register,
                              staged["dim_management"], ["management_center_id"]).frame(),
            scd2_invariants(staged["dim_school_scd2"], ["udise_sch_code"], "dim_school_scd2"),
        )

    outputs = [
        (tables.DIM_PERIOD, dims.dim_period(register)),
        (tables.DIM_STATE, dims.dim_state(snapshot["state_master"])),
        (tables.DIM_DISTRICT, dims.dim_district(snapshot["district_master"])),
        (tables.DIM_CATEGORY, dims.dim_category(snapshot["school_category_master"])),
        (tables.DIM_MANAGEMENT, management.select(*tables.DIM_MANAGEMENT.columns)),
        (tables.DIM_SOCIAL, dims.dim_social_category(snapshot["enrollment_social_category"])),
        (tables.DIM_SCHOOL, versions),
    ]
    publish(spark, root, f"{run_id}-dimensions", outputs, checks=model_checks)
    audit = facts.school_change_audit(read_table(spark, root, "dim_school_scd2"))
    return publish(spark, root, f"{run_id}-audit", [(tables.SCHOOL_AUDIT, audit)],
                   may_be_empty=[tables.SCHOOL_AUDIT.table])


def _rows(spark: SparkSession, root: str, table: str) -> int:
    """Rows of a published table, as its commit recorded them."""
    recorded = (latest_commit(spark, root).rows or {}).get(table)
    return read_table(spark, root, table).count() if recorded is None else recorded


def publish_student_fact(
    spark: SparkSession, root: str, run_id: str, now: datetime | None = None
) -> Commit:
    enforce(ready_checks(spark, root, [
        "enrollment_social_category", "dim_academic_year", "dim_social_category", "dim_school_scd2"]))
    enrollment = read_table(spark, root, "enrollment_social_category")
    fact = facts.fact_student(
        enrollment, read_table(spark, root, "dim_academic_year"),
        read_table(spark, root, "dim_social_category"), read_table(spark, root, "dim_school_scd2"))
    return publish(
        spark, root, f"{run_id}-student-fact", [(tables.FACT_STUDENT, fact)],
        keep_history=[tables.FACT_STUDENT.table], now=now,
        expected_rows={tables.FACT_STUDENT.table: _rows(spark, root, "enrollment_social_category")},
        checks=lambda staged: facts.student_fact_rules(staged["fact_enrollment"]))


def publish_student_reports(spark: SparkSession, root: str, run_id: str) -> Commit:
    """Both student reports, reconciled with each other, in one commit.

    The cube is stored first, so the fact is read once for both.
    """
    enforce(ready_checks(spark, root, ["fact_enrollment", "dim_state", "dim_management", "dim_category"]))
    fact = read_table(spark, root, "fact_enrollment")
    state, management, category = (
        read_table(spark, root, t) for t in ("dim_state", "dim_management", "dim_category"))
    facts.dimension_key_plan(state, management, category).add(
        facts.mapping_plan(fact, state, management, category)).enforce()
    cube = write_once(reports.enrollment_cube(fact), "cube")
    outputs = [
        (tables.REPORT_MANAGEMENT, reports.report_management(cube, state, management)),
        (tables.REPORT_CATEGORY, reports.report_category(cube, state, management, category)),
    ]
    return publish(
        spark, root, f"{run_id}-student-reports", outputs,
        checks=lambda staged: reports.student_report_plan(
            staged["enrollment_by_management"], staged["enrollment_by_category"]))


def build_student(
    spark: SparkSession, root: str, run_id: str, drops: list[Drop],
    management_source: DataFrame, processed_at: str, refresh_management: bool = False,
    now: datetime | None = None,
) -> Commit:
    publish_snapshots(spark, root, run_id, drops, processed_at, now)
    publish_dimensions(spark, root, run_id, management_source, refresh_management)
    publish_student_fact(spark, root, run_id, now)
    return publish_student_reports(spark, root, run_id)


def build_teacher(
    spark: SparkSession, root: str, run_id: str, drops: list[Drop], now: datetime | None = None,
) -> Commit:
    """Teacher snapshot, fact and reports; uses the published student snapshots."""
    without = [d.period for d in drops if TEACHER_TABLE not in d.tables]
    if without:
        raise scan.SourceMissing(f"no {TEACHER_TABLE} in the drops of {without}")
    enforce(ready_checks(spark, root, [
        "school_master_snapshot", "state_master", "school_category_master", "dim_management"]))
    counts = scan.union_periods(
        [normalize.normalize_counts(d.tables[TEACHER_TABLE], d.period) for d in drops],
        allow_missing=False)
    sizes = CheckPlan()
    for d in drops:
        sizes.count(d.period, d.tables[TEACHER_TABLE])
    publish(spark, root, f"{run_id}-teachers", [(tables.TEACHERS, counts)],
            keep_history=[tables.TEACHERS.table], now=now,
            expected_rows={tables.TEACHERS.table: sum(n for n, _ in sizes.findings().values())},
            checks=lambda staged: normalize.counts_checks(staged["staff_snapshot"]))
    sources = [read_table(spark, root, t) for t in (
        "staff_snapshot", "school_master_snapshot", "state_master",
        "school_category_master", "dim_management")]
    enforce(facts.source_preflight(*sources))
    publish(spark, root, f"{run_id}-teacher-fact",
            [(tables.FACT_TEACHER, facts.fact_teacher(*sources))],
            keep_history=[tables.FACT_TEACHER.table], now=now,
            expected_rows={tables.FACT_TEACHER.table: _rows(spark, root, "staff_snapshot")},
            checks=lambda staged: facts.teacher_fact_rules(staged["fact_staff"]))
    fact = read_table(spark, root, "fact_staff")
    outputs = [
        (tables.TEACHER_MANAGEMENT, reports.teacher_report_management(fact)),
        (tables.TEACHER_CATEGORY, reports.teacher_report_category(fact)),
    ]
    return publish(
        spark, root, f"{run_id}-teacher-reports", outputs,
        checks=lambda staged: reports.teacher_report_plan(
            fact, staged["staff_by_management"], staged["staff_by_category"]))
