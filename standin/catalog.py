"""One registered query per operator, each over whole driver tables.

Dates, timestamps and decimals are shown as text, so that results compare equal in any
client regardless of its date range and time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions import measures as stages
from snapledger.functions.labels import ALL_GEOGRAPHIES, ALL_MANAGEMENT
from snapledger.functions.periods import period_label, period_start
from snapledger.operators import checks, corrections, history, reconcile, scd2, totals
from snapledger.plans import dims, facts, reports
from snapledger.sources import columns, footers, normalize, scan
from snapledger.sources.columns import Alias
from snapledger.storage import publish, workdir
from snapledger.storage.contracts import Contract, Field
from standin import frames as st

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

KEY = ["udise_sch_code"]
HISTORY_COLUMNS = ("academic_year", "udise_sch_code", *normalize.SCHOOL_ATTRIBUTES)
# The dimension of a source that has not labelled one segment yet.
KNOWN_SEGMENTS = {s: v for s, v in st.SEGMENTS.items() if s != "FURNITURE"}


def portable(df: DataFrame) -> DataFrame:
    as_text = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, as_text)
        else F.col(f.name) for f in df.schema])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(spark, sf_dir))
    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources -------------------------------------------------------------------------------

@query
def scan_annual(spark, sf_dir):
    """The scale folder plays the period; rows and cents per fiscal year of the drop."""
    root, _, period = sf_dir.rstrip("/").rpartition("/")
    drop = scan.scan_annual(spark, root, period, "orders.parquet")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return drop.groupBy(period_label("o_orderdate").alias("academic_year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(cents).alias("cents"))


@query
def union_years(spark, sf_dir):
    """Two drops of orders; the earlier one has no priority column yet."""
    orders = st.table(spark, sf_dir, "orders")
    cut = F.lit("1998-04-01").cast("timestamp_ntz")
    early = orders.filter(F.col("o_orderdate") < cut).drop("o_orderpriority")
    late = orders.filter(F.col("o_orderdate") >= cut)
    both = scan.union_periods([early, late])
    return both.groupBy(period_label("o_orderdate").alias("academic_year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("o_orderpriority").alias("n_priorities"))


@query
def src_complete_runs(spark, sf_dir):
    """customer = period, year = run, order status = table; the last year is canonical."""
    seen = st.period_orders(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("period"),
        F.when(st.year() != st.periods(spark, sf_dir)[-1], st.year()).alias("run"),
        F.col("o_orderstatus").alias("table"),
    )
    return scan.complete_runs(seen, required=["F"], one_of=["O", "P"])


@query
def src_manifest(spark, sf_dir):
    return scan.manifest({
        "orders": (st.table(spark, sf_dir, "orders"), period_label("o_orderdate")),
        "lineitem": (st.table(spark, sf_dir, "lineitem"), period_label("l_shipdate")),
        "events": (st.table(spark, sf_dir, "events"), period_label("ts")),
    })


SCHEMA_RULES = {
    "customer": {
        "school code": Alias(("udise_sch_code", "school_code", "C_CUSTKEY")),
        "state code": Alias(("state_cd", "c_nationkey")),
        "management": Alias(("management_center_id", "c_mktsegment")),
        "status": Alias(("school_status",), required=False),
    },
    "lineitem": {
        "school code": Alias(("udise_sch_code", "l_orderkey")),
        "item": Alias(("item_id", "l_returnflag")),
        "c1_b": Alias(("c1_b",)),
    },
}


@query
def src_schema_contract(spark, sf_dir):
    parts = [
        columns.schema_report(
            name, scan.scan_annual(*_drop(spark, sf_dir, name), merge_schema=True), rules)
        for name, rules in SCHEMA_RULES.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def src_file_schema(spark, sf_dir):
    """What each file's own footer says of the roles, files counted by what they hold."""
    parts = [
        footers.file_report(name, footers.file_schemas(spark, f"{sf_dir}/{name}.parquet"), rules)
        for name, rules in SCHEMA_RULES.items()
    ]
    return parts[0].unionByName(parts[1]).groupBy(
        "source_table", "role", "column_name", "column_type", "status").agg(
        F.count(F.lit(1)).alias("n_files"))


def _drop(spark, sf_dir, name):
    root, _, period = sf_dir.rstrip("/").rpartition("/")
    return spark, root, period, f"{name}.parquet"


LINE_CONTRACT = Contract(
    "lines",
    (
        Field("l_orderkey", "bigint", nullable=False),
        Field("l_linenumber", "int", nullable=False),
        Field("l_returnflag", "int"),
        Field("l_linestatus", "string", nullable=False, max_length=1),
        Field("l_quantity", "bigint"),
        Field("l_shipdate", "date", nullable=False),
        Field("l_partkey", "bigint", max_length=3),
    ),
    keys=("l_orderkey", "l_linenumber"),
)


@query
def contract_violations(spark, sf_dir):
    """Return flags are no numbers, some part keys are too long, line keys repeat."""
    return LINE_CONTRACT.violations(st.table(spark, sf_dir, "lineitem"))


SCHOOL_CONTRACT = Contract(
    "school_master_snapshot",
    (
        Field("academic_year", "string", nullable=False, max_length=7),
        Field("udise_sch_code", "string", nullable=False, max_length=32),
        Field("school_name", "string", max_length=255),
        Field("state_cd", "string", nullable=False, max_length=10),
        Field("district_cd", "string", nullable=False, max_length=20),
        Field("sch_category_id", "int"),
        Field("management_center_id", "int", nullable=False),
        Field("school_status", "int"),
    ),
    keys=("academic_year", "udise_sch_code"),
    partition_by=("academic_year",),
)


@query
def stage_write_readback(spark, sf_dir):
    """Write the register by year, read it back."""
    path = workdir.new_dir(spark, "stage")
    publish.stage(st.schools(spark, sf_dir), SCHOOL_CONTRACT, path)
    written = publish.staged_table(spark, SCHOOL_CONTRACT, path)
    return written.groupBy("academic_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("management_center_id").alias("sum_management"))


@query
def publish_validated(spark, sf_dir):
    """Publish a partial register, then the full one; count its published history."""
    root = workdir.new_dir(spark, "warehouse")
    for run, register in (("first", st.settled_schools), ("second", st.schools)):
        publish.publish(
            spark, root, run, [(SCHOOL_CONTRACT, register(spark, sf_dir))],
            keep_history=[SCHOOL_CONTRACT.table])
    stored = publish.read_table(spark, root, f"{SCHOOL_CONTRACT.table}_history")
    return stored.groupBy("academic_year", "change_type", "is_current").agg(
        F.count(F.lit(1)).alias("n_rows"))


# --- normalized snapshots ------------------------------------------------------------------

@query
def normalize_state(spark, sf_dir):
    return st.states(spark, sf_dir)


@query
def normalize_district(spark, sf_dir):
    return st.districts(spark, sf_dir)


@query
def normalize_category(spark, sf_dir):
    return st.categories(spark, sf_dir)


@query
def normalize_snapshot(spark, sf_dir):
    return normalize.normalize_snapshot(
        st.raw_schools(spark, sf_dir), st.year(), st.SCHOOL_LINEAGE)


@query
def normalize_measures(spark, sf_dir):
    return st.measures(spark, sf_dir)


@query
def normalize_counts(spark, sf_dir):
    return st.teachers(spark, sf_dir)


# --- dimensions ----------------------------------------------------------------------------

@query
def dim_period(spark, sf_dir):
    return st.dim_period(spark, sf_dir)


@query
def dim_state(spark, sf_dir):
    return st.dim_state(spark, sf_dir)


@query
def dim_district(spark, sf_dir):
    return dims.dim_district(st.districts(spark, sf_dir))


@query
def dim_category(spark, sf_dir):
    return st.dim_category(spark, sf_dir)


@query
def dim_management(spark, sf_dir):
    return st.dim_management(spark, sf_dir)


@query
def dim_social_category(spark, sf_dir):
    return dims.dim_social_category(st.measures(spark, sf_dir))


# --- facts and versions --------------------------------------------------------------------

@query
def stage_measures(spark, sf_dir):
    return stages.with_stage_measures(st.measures(spark, sf_dir), normalize.ENROLLMENT_KEYS)


@query
def scd2_rebuild(spark, sf_dir):
    return st.dim_school(spark, sf_dir)


@query
def scd2_change_audit(spark, sf_dir):
    return facts.school_change_audit(st.dim_school(spark, sf_dir))


@query
def scd2_invariants(spark, sf_dir):
    return scd2.scd2_invariants(st.dim_school(spark, sf_dir), KEY, "schools")


@query
def scd2_reconciliation(spark, sf_dir):
    register = st.schools(spark, sf_dir)
    return scd2.scd2_reconciliation(
        register, facts.dim_school(register), period_start("academic_year"), "school")


def _register(spark, sf_dir):
    return st.schools(spark, sf_dir).select(*HISTORY_COLUMNS)


def _chain(spark, sf_dir, runs):
    listed = _register(spark, sf_dir).filter(st.year().isin(*[p for p, _ in runs]))
    return history.history_chain(listed, KEY, "academic_year", runs)


@query
def history_chain(spark, sf_dir):
    return history.history_chain(_register(spark, sf_dir), KEY, "academic_year", st.runs(spark, sf_dir))


@query
def history_step(spark, sf_dir):
    """All years but the last as history, then one step with the last year's register."""
    *before, (last, stamp) = st.runs(spark, sf_dir)
    latest = _register(spark, sf_dir).filter(st.year() == last).drop("academic_year")
    return history.history_step(_chain(spark, sf_dir, before), latest, KEY, F.lit(stamp), checked=True)


@query
def history_baseline(spark, sf_dir):
    """No history yet: record the table as it stands, then step to a register that lacks
    schools with pending orders only."""
    keys = ["academic_year", "udise_sch_code"]
    existing = _register(spark, sf_dir)
    settled = st.settled_schools(spark, sf_dir).select(*HISTORY_COLUMNS)
    base = history.history_baseline(None, existing, keys, F.lit("2002-01-01 00:00:00"), checked=True)
    return history.history_step(base, settled, keys, F.lit("2002-02-01 00:00:00"), checked=True)


@query
def history_lookup(spark, sf_dir):
    """Every revision of the schools that were once deleted and came back."""
    stored = history.history_chain(_register(spark, sf_dir), KEY, "academic_year", st.runs(spark, sf_dir))
    returned = stored.filter(F.col("change_type") == "REACTIVATED")
    return history.history_lookup(stored, returned, KEY).select(
        "udise_sch_code", "version_no", "valid_from", "valid_to", "is_current", "is_deleted",
        "change_type", "school_status")


@query
def fact_student(spark, sf_dir):
    return st.fact_student(spark, sf_dir)


@query
def fact_teacher(spark, sf_dir):
    return st.fact_teacher(spark, sf_dir)


# --- reports -------------------------------------------------------------------------------

@query
def report_management(spark, sf_dir):
    return st.management_report(spark, sf_dir)


@query
def report_category(spark, sf_dir):
    return st.category_report(spark, sf_dir)


@query
def teacher_report_management(spark, sf_dir):
    return reports.teacher_report_management(st.fact_teacher(spark, sf_dir))


@query
def teacher_report_category(spark, sf_dir):
    return reports.teacher_report_category(st.fact_teacher(spark, sf_dir))


@query
def report_slice(spark, sf_dir):
    """One management scope, all years."""
    return reports.report_slice(
        st.management_report(spark, sf_dir), management=ALL_MANAGEMENT)


@query
def latest_period_report(spark, sf_dir):
    """The newest label is known from the periods, so only its part of the fact is computed."""
    newest = st.periods(spark, sf_dir)[-1:]
    cube = st.enrollment_cube(spark, sf_dir).filter(st.year().isin(*newest))
    return reports.report_slice(
        st.management_report(spark, sf_dir, cube), management=ALL_MANAGEMENT)


@query
def total_copies(spark, sf_dir):
    """Distinct schools per geography: not additive, so rows fan out to the total label."""
    rows = st.schools(spark, sf_dir).select(
        "academic_year", F.col("state_cd").alias("geography"), "udise_sch_code").distinct()
    return totals.with_total_copies(rows, "geography", ALL_GEOGRAPHIES).groupBy(
        "geography").agg(F.countDistinct("udise_sch_code").alias("n_schools"))


# --- checks --------------------------------------------------------------------------------

@query
def dq_orphan_keys(spark, sf_dir):
    """Enrollment of schools that the settled register does not hold."""
    return checks.missing_keys(
        st.measures(spark, sf_dir), st.settled_schools(spark, sf_dir), normalize.SNAPSHOT_KEYS)


@query
def dq_missing_dim(spark, sf_dir):
    return facts.missing_management(
        st.schools(spark, sf_dir), st.dim_management(spark, sf_dir, KNOWN_SEGMENTS))


@query
def dq_mapping_audit(spark, sf_dir):
    """The fact against a management dimension that misses one id."""
    return facts.mapping_audit(
        st.fact_student(spark, sf_dir), st.dim_state(spark, sf_dir),
        st.dim_management(spark, sf_dir, KNOWN_SEGMENTS), st.dim_category(spark, sf_dir))


@query
def dq_source_preflight(spark, sf_dir):
    """Each source is computed once: joins and key checks read it as stored."""
    sources = st.teacher_sources(spark, sf_dir, KNOWN_SEGMENTS)
    return facts.source_preflight(*[workdir.write_once(df, "source") for df in sources])


@query
def dq_missing_labels(spark, sf_dir):
    """Customers without a usable label, where only urgent orders carry one."""
    priority = F.col("o_orderpriority")
    label = F.when(priority.startswith("1"), st.priority_label(priority)).otherwise(" ")
    orders = st.table(spark, sf_dir, "orders").withColumn("label", label)
    return checks.codes_without_label(orders, "o_custkey", "label")


@query
def dq_unmapped_values(spark, sf_dir):
    return st.unmapped_checks(spark, sf_dir)


@query
def dq_duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(
        st.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_conflicting_duplicates(spark, sf_dir):
    lines = st.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return checks.conflicting_duplicates(
        lines, ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus"])


@query
def recon_full_outer(spark, sf_dir):
    """Category report against management report: every total must agree."""
    cube = workdir.write_once(st.enrollment_cube(spark, sf_dir), "cube")
    return reconcile.full_outer_totals(
        reports.category_totals(st.category_report(spark, sf_dir, cube)),
        reports.geography_totals(st.management_report(spark, sf_dir, cube)),
        ["ac_year", "india_state_ut"], "total")


@query
def recon_row_math(spark, sf_dir):
    """Two of these hold for every row, the third leaves out a stage on purpose."""
    fact = st.fact_student(spark, sf_dir)
    parts = list(stages.STAGES)
    genders = ["total_boys", "total_girls", "total_transgender"]
    return checks.count_bad(fact, {
        "stages": reconcile.not_sum("total_enrollment", parts),
        "genders": reconcile.not_sum("total_enrollment", genders),
        "without_secondary": reconcile.not_sum("total_enrollment", parts[:3]),
    })


@query
def recon_group_vs_all(spark, sf_dir):
    return reconcile.group_vs_all(
        st.management_report(spark, sf_dir), ["ac_year", "india_state_ut"], "management",
        ALL_MANAGEMENT, "total")


@query
def recon_fact_vs_report(spark, sf_dir):
    """Orders counted per year against the report built from the joined fact."""
    counted = st.period_orders(spark, sf_dir).groupBy(
        F.col("academic_year").alias("ac_year")).agg(F.count(F.lit(1)).alias("total"))
    report = reports.teacher_report_management(st.fact_teacher(spark, sf_dir))
    national = reports.geography_totals(report).filter(
        F.col("india_state_ut") == ALL_GEOGRAPHIES)
    return reconcile.fact_vs_report(counted, national, ["ac_year"], "total")


@query
def validation_summary(spark, sf_dir):
    """All checks of the student star over tables written once."""
    fact = workdir.write_once(st.fact_student(spark, sf_dir), "fact")
    state, management = st.dim_state(spark, sf_dir), st.dim_management(spark, sf_dir)
    category = st.dim_category(spark, sf_dir)
    cube = workdir.write_once(reports.enrollment_cube(fact), "cube")
    by_management = workdir.write_once(reports.report_management(cube, state, management), "report")
    by_category = workdir.write_once(reports.report_category(cube, state, management, category), "report")
    return (
        facts.student_fact_rules(fact).not_empty("fact_student:not_empty", fact)
        .add(facts.dimension_key_plan(state, management, category))
        .add(facts.mapping_plan(fact, state, management, category))
        .add(reports.student_report_plan(by_management, by_category)).frame())


# --- corrections, rejects, tolerance -------------------------------------------------------

@query
def apply_corrections(spark, sf_dir):
    """Ten more male teachers at each FURNITURE school in 1999-00, where it has a row."""
    wanted = st.table(spark, sf_dir, "customer").filter(
        F.col("c_mktsegment") == "FURNITURE").select(
        F.lit("1999-00").alias("academic_year"),
        F.col("c_custkey").cast("string").alias("udise_sch_code"),
        F.lit(10).cast("bigint").alias("delta"))
    return corrections.apply_corrections(
        st.teachers(spark, sf_dir), wanted, ["academic_year", "udise_sch_code"], "male_tch")


def line_rules():
    return {
        "discount at the limit": F.col("l_discount") >= 0.1,
        "returned while open": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
    }


@query
def quarantine_rejects(spark, sf_dir):
    lines = st.table(spark, sf_dir, "lineitem")
    return corrections.quarantine(
        lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount",
                     "l_shipdate"),
        line_rules(), "standin-batch", "lineitem", period_label("l_shipdate"),
        record=["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])


@query
def quarantine_counts(spark, sf_dir):
    return corrections.batch_counts(
        st.table(spark, sf_dir, "lineitem"), line_rules(), period_label("l_shipdate"))


@query
def recon_tolerance(spark, sf_dir):
    """Quantity by year of order against quantity by year of shipping."""
    report = st.management_report(spark, sf_dir)
    observed = reports.geography_totals(report).filter(
        F.col("india_state_ut") == ALL_GEOGRAPHIES).drop("india_state_ut")
    shipped = st.table(spark, sf_dir, "lineitem").groupBy(
        period_label("l_shipdate").alias("ac_year")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
    tolerance = F.col("expected_total") * F.lit("0.02").cast("decimal(3,2)")
    return reconcile.within_tolerance(observed, shipped, ["ac_year"], tolerance)
