"""School versions and the two fact tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.hashing import district_key, state_key, version_key
from snapledger.functions.labels import (
    MANAGEMENT_GROUPS,
    SCHOOL_CATEGORY_IDS,
    is_blank,
    teacher_category,
)
from snapledger.functions.measures import MEASURES, STAGES, with_stage_measures
from snapledger.functions.periods import period_start
from snapledger.operators.checkplan import CheckPlan
from snapledger.operators.reconcile import not_sum
from snapledger.operators.scd2 import join_valid_version, scd2_change_audit, scd2_rebuild
from snapledger.sources.normalize import (
    ENROLLMENT_KEYS,
    SCHOOL_ATTRIBUTES,
    SNAPSHOT_KEYS,
    TEACHER_COUNTS,
)

# Names of the attributes in the audit's previous_/current_ pairs and in changed_columns.
AUDIT_NAMES = {
    "school_name": ("school_name", "school_name"),
    "state_cd": ("state_cd", "state"),
    "district_cd": ("district_cd", "district"),
    "sch_category_id": ("category_id", "category"),
    "management_center_id": ("management_id", "management"),
    "school_status": ("school_status", "school_status"),
}


def dim_school(snapshots: DataFrame) -> DataFrame:
    """School versions with surrogate keys."""
    versions = scd2_rebuild(
        snapshots, ["udise_sch_code"], period_start("academic_year"), SCHOOL_ATTRIBUTES)
    return versions.select(
        "udise_sch_code", "valid_from",
        version_key(["udise_sch_code"], "valid_from").alias("school_sk"),
        "version_no", "school_name",
        state_key("state_cd").alias("state_sk"),
        district_key("state_cd", "district_cd").alias("district_sk"),
        F.col("sch_category_id").alias("category_sk"),
        F.col("management_center_id").alias("management_sk"),
        "state_cd", "district_cd", "sch_category_id", "management_center_id", "school_status",
        "valid_to", "is_current", "row_hash", "change_type",
    )


def school_change_audit(versions: DataFrame) -> DataFrame:
    return scd2_change_audit(versions, ["udise_sch_code"], AUDIT_NAMES)


def fact_student(
    measures: DataFrame, periods: DataFrame, social: DataFrame, schools: DataFrame
) -> DataFrame:
    """Enrollment by school version, period and social category.

    Metrics shrink to the stage measures before anything is joined. Periods and social
    categories come from small published tables, which Spark broadcasts by their size; the
    school join is the one that shuffles.
    """
    narrow = with_stage_measures(
        measures, [*ENROLLMENT_KEYS, "pre_primary_available", "transgender_available"])
    starred = narrow.join(
        periods.select("academic_year", "academic_year_sk"), "academic_year"
    ).join(
        social.select("item_group", "item_id", "social_category_sk"), ["item_group", "item_id"])
    versions = schools.select(
        "udise_sch_code", "valid_from", "valid_to", "school_sk", "state_sk", "district_sk",
        "category_sk", "management_sk")
    joined = join_valid_version(
        starred, versions, ["udise_sch_code"], period_start("academic_year"))
    return joined.select(
        "academic_year_sk", "school_sk", "social_category_sk", "state_sk", "district_sk",
        "category_sk", "management_sk", *ENROLLMENT_KEYS, *MEASURES,
        "pre_primary_available", "transgender_available",
    )


def student_fact_rules(fact: DataFrame) -> CheckPlan:
    return CheckPlan().rules(fact, {"fact_student:row_math": not_sum("total_enrollment", STAGES)})


def fact_student_checks(measures: DataFrame, fact: DataFrame) -> DataFrame:
    return student_fact_rules(fact).rows_equal("fact_student:rows_equal_source", fact, measures).frame()


def missing_management(snapshots: DataFrame, management: DataFrame) -> DataFrame:
    """Management ids in use that the dimension lacks."""
    used = snapshots.select("management_center_id").distinct()
    return used.join(management.select("management_center_id"), "management_center_id", "left_anti")


def mapping_plan(
    fact: DataFrame, states: DataFrame, management: DataFrame, categories: DataFrame
) -> CheckPlan:
    """Fact rows by reason they cannot be reported. A NULL category is allowed."""
    group = F.col("management_group")
    return (
        CheckPlan()
        .mapped(fact, states, "state_sk", "mapping:state_missing",
                "mapping:state_blank", is_blank(F.col("state_name")))
        .mapped(fact, management, "management_sk", "mapping:management_missing",
                "mapping:management_group", group.isNull() | ~group.isin(*MANAGEMENT_GROUPS))
        .mapped(fact, categories, "category_sk", "mapping:category_missing",
                "mapping:category_blank", is_blank(F.col("category")), F.col("category_sk").isNotNull())
    )


def mapping_audit(
    fact: DataFrame, states: DataFrame, management: DataFrame, categories: DataFrame
) -> DataFrame:
    """Findings of ``mapping_plan``: the fact is read once and shrinks to its keys first."""
    return mapping_plan(fact, states, management, categories).frame()


def dimension_key_plan(states: DataFrame, management: DataFrame, categories: DataFrame) -> CheckPlan:
    return (
        CheckPlan()
        .unique("dim_state:unique_key", states, ["state_sk"])
        .unique("dim_management:unique_key", management, ["management_sk"])
        .unique("dim_category:unique_key", categories, ["category_sk"])
    )


def dimension_key_checks(states: DataFrame, management: DataFrame, categories: DataFrame) -> DataFrame:
    return dimension_key_plan(states, management, categories).frame()


def _teacher_context(
    counts: DataFrame, snapshots: DataFrame, states: DataFrame, categories: DataFrame,
    management: DataFrame, how: str,
) -> DataFrame:
    """Each teacher row with its school, state, category and management of the same period."""
    known = categories.filter(F.col("sch_category_id").isin(*SCHOOL_CATEGORY_IDS)).select(
        "academic_year", "sch_category_id").distinct().withColumn("_cat", F.lit(1))
    schools = snapshots.select(
        *SNAPSHOT_KEYS, "state_cd", "management_center_id", "sch_category_id",
        F.lit(1).alias("_school"))
    groups = management.select(
        F.col("management_sk").alias("management_center_id"), "management_group")
    return (
        counts.join(schools, list(SNAPSHOT_KEYS), how)
        .join(states.select("academic_year", "state_cd", "state_name"),
              ["academic_year", "state_cd"], how)
        # eleven mapped ids per period: bounded by construction
        .join(F.broadcast(known), ["academic_year", "sch_category_id"], how)
        .join(groups, "management_center_id", how)
    )


def fact_teacher(
    counts: DataFrame, snapshots: DataFrame, states: DataFrame, categories: DataFrame,
    management: DataFrame,
) -> DataFrame:
    """Teachers by school with the labels valid in the same period."""
    joined = _teacher_context(counts, snapshots, states, categories, management, "inner")
    total = reduce(lambda a, b: a + b, [F.col(c) for c in TEACHER_COUNTS])
    return joined.select(
        *SNAPSHOT_KEYS, "state_cd", "state_name", "management_center_id", "management_group",
        "sch_category_id", teacher_category(F.col("sch_category_id")).alias("category"),
        *TEACHER_COUNTS, total.alias("total_teachers"),
    )


def source_preflight(
    counts: DataFrame, snapshots: DataFrame, states: DataFrame, categories: DataFrame,
    management: DataFrame,
) -> DataFrame:
    """Teacher rows by reason they cannot enter the fact, plus repeated keys of each source."""
    joined = _teacher_context(counts, snapshots, states, categories, management, "left")
    group, number = F.col("management_group"), [F.col(c) for c in TEACHER_COUNTS]
    school = F.col("_school").isNotNull()
    reasons = {
        "preflight:school_missing": ~school,
        "preflight:state_label": school & is_blank(F.col("state_name")),
        "preflight:category": school & F.col("_cat").isNull(),
        "preflight:management": school & (group.isNull() | ~group.isin(*MANAGEMENT_GROUPS)),
        "preflight:counts_null": reduce(lambda a, b: a | b, [c.isNull() for c in number]),
        "preflight:counts_negative": reduce(lambda a, b: a | b, [c < 0 for c in number]),
    }
    sources = {
        "teachers": (counts, SNAPSHOT_KEYS),
        "schools": (snapshots, SNAPSHOT_KEYS),
        "states": (states, ("academic_year", "state_cd")),
        "categories": (categories, ("academic_year", "sch_category_id")),
        "management": (management, ("management_sk",)),
    }
    plan = CheckPlan().rules(joined, reasons)
    for name, (df, keys) in sources.items():
        plan.unique(f"preflight:{name}_unique_key", df, keys)
    return plan.frame()


def teacher_fact_rules(fact: DataFrame) -> CheckPlan:
    return CheckPlan().rules(fact, {"fact_teacher:row_math": not_sum("total_teachers", TEACHER_COUNTS)})


def fact_teacher_checks(counts: DataFrame, fact: DataFrame) -> DataFrame:
    return teacher_fact_rules(fact).rows_equal("fact_teacher:rows_equal_source", fact, counts).frame()
