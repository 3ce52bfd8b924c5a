"""The four reports, their slices and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.labels import (
    ALL_GEOGRAPHIES,
    ALL_MANAGEMENT,
    GRADE_BANDS,
    MANAGEMENT_GROUPS,
    TEACHER_MIDDLE_IDS,
    TEACHER_PRIMARY_IDS,
    TEACHER_SECONDARY_IDS,
    UNKNOWN_CATEGORY,
)
from snapledger.functions.measures import STAGES
from snapledger.operators.checkplan import CheckPlan
from snapledger.operators.reconcile import not_sum
from snapledger.operators.totals import multi_level_totals, split_where, sum_where, sums

STUDENT_MEASURES = ("total", *STAGES)
TEACHER_STAGES = {
    "foundational_preparatory": TEACHER_PRIMARY_IDS,
    "middle": TEACHER_MIDDLE_IDS,
    "secondary": TEACHER_SECONDARY_IDS,
}
TEACHER_MEASURES = ("total", *TEACHER_STAGES, *GRADE_BANDS)
# Report column of each management group.
GROUP_COLUMNS = dict(zip(
    ("government", "government_aided", "private_unaided_recognized", "others"),
    MANAGEMENT_GROUPS, strict=True))
TOTAL_LABELS = {"india_state_ut": ALL_GEOGRAPHIES, "management": ALL_MANAGEMENT}
MANAGEMENT_LEVELS = (
    ("ac_year", "india_state_ut"), ("ac_year", "india_state_ut", "management"),
    ("ac_year",), ("ac_year", "management"),
)
CATEGORY_LEVELS = (("ac_year", "india_state_ut", "category"), ("ac_year", "category"))


def enrollment_cube(fact: DataFrame) -> DataFrame:
    """The fact summed to the key combinations both student reports need.

    Dimensions are joined to this small result instead of the fact. The reports prune it
    differently, so Spark would compute it for each: store it to have both read it once.
    """
    return fact.groupBy("academic_year", "state_sk", "management_sk", "category_sk").agg(
        F.sum("total_enrollment").cast("bigint").alias("total"), *sums(STAGES))


def report_management(cube: DataFrame, states: DataFrame, management: DataFrame) -> DataFrame:
    """Enrollment by state and management group with both kinds of totals.

    A level that shows a dimension leaves out rows the dimension does not know, a level
    that does not show it keeps them; ``mapping_audit`` reports such rows.
    """
    named = cube.join(
        states.select("state_sk", F.col("state_name").alias("india_state_ut"),
                      F.lit(True).alias("_state")), "state_sk", "left",
    ).join(
        management.select("management_sk", F.col("management_group").alias("management"),
                          F.lit(True).alias("_group")), "management_sk", "left",
    ).withColumnRenamed("academic_year", "ac_year")
    known = named.select(
        "ac_year", "india_state_ut", "management",
        F.coalesce("_state", F.lit(False)).alias("_state"),
        F.coalesce("_group", F.lit(False)).alias("_group"), *STUDENT_MEASURES)
    report = multi_level_totals(
        known,
        [("ac_year", "india_state_ut", "_state"),
         ("ac_year", "india_state_ut", "management", "_state", "_group"),
         ("ac_year",), ("ac_year", "management", "_group")],
        TOTAL_LABELS, STUDENT_MEASURES,
    )
    shown = F.coalesce("_state", F.lit(True)) & F.coalesce("_group", F.lit(True))
    return report.filter(shown).select(
        "ac_year", "india_state_ut", "management", *STUDENT_MEASURES)


def _by_group(df: DataFrame) -> DataFrame:
    """Split ``total`` over the four management columns."""
    cases = {name: F.col("management") == group for name, group in GROUP_COLUMNS.items()}
    return df.select("*", *split_where("total", cases))


def _category_report(df: DataFrame) -> DataFrame:
    measures = ("total", *GROUP_COLUMNS)
    report = multi_level_totals(
        _by_group(df), CATEGORY_LEVELS, {"india_state_ut": ALL_GEOGRAPHIES}, measures)
    return report.select("ac_year", "india_state_ut", "category", *measures)


def report_category(
    cube: DataFrame, states: DataFrame, management: DataFrame, categories: DataFrame
) -> DataFrame:
    """Enrollment by state and school category, one column per management group."""
    named = (
        cube.join(states.select("state_sk", F.col("state_name").alias("india_state_ut")), "state_sk")
        .join(management.select("management_sk", F.col("management_group").alias("management")),
              "management_sk")
        .join(categories.select("category_sk", "category"), "category_sk", "left")
    )
    return _category_report(named.select(
        F.col("academic_year").alias("ac_year"), "india_state_ut", "management",
        F.coalesce("category", F.lit(UNKNOWN_CATEGORY)).alias("category"), "total"))


def _one_of(ids: tuple[int, ...]) -> Column:
    return F.col("sch_category_id").isin(*ids)


def teacher_report_management(fact: DataFrame) -> DataFrame:
    """Teachers by state and management group: stages and grade bands."""
    cases = {name: _one_of(ids) for name, ids in {**TEACHER_STAGES, **GRADE_BANDS}.items()}
    finest = fact.groupBy(
        F.col("academic_year").alias("ac_year"), F.col("state_name").alias("india_state_ut"),
        F.col("management_group").alias("management"),
    ).agg(F.sum("total_teachers").cast("bigint").alias("total"),
          *sum_where("total_teachers", cases))
    report = multi_level_totals(finest, MANAGEMENT_LEVELS, TOTAL_LABELS, TEACHER_MEASURES)
    return report.select("ac_year", "india_state_ut", "management", *TEACHER_MEASURES)


def teacher_report_category(fact: DataFrame) -> DataFrame:
    """Teachers by state and school category, one column per management group."""
    return _category_report(fact.select(
        F.col("academic_year").alias("ac_year"), F.col("state_name").alias("india_state_ut"),
        F.col("management_group").alias("management"), "category",
        F.col("total_teachers").alias("total")))


def report_slice(
    report: DataFrame, period: str | None = None, management: str | None = None,
    geography: str | None = None,
) -> DataFrame:
    """One scope of a report, ordered for reading. Mixing scopes would double-count."""
    for column, value in (
        ("ac_year", period), ("management", management), ("india_state_ut", geography)
    ):
        if value is not None:
            report = report.filter(F.col(column) == value)
    return report.orderBy(*[c for c in ("ac_year", "india_state_ut", "management", "category")
                            if c in report.columns])


def latest_period(report: DataFrame) -> DataFrame:
    """Rows of the newest period in the report."""
    newest = report.agg(F.max("ac_year").alias("ac_year"))
    return report.join(F.broadcast(newest), "ac_year", "left_semi")


def geography_totals(report: DataFrame) -> DataFrame:
    """Management report's total rows per period and geography."""
    return report.filter(F.col("management") == ALL_MANAGEMENT).select(
        "ac_year", "india_state_ut", "total")


def category_totals(report: DataFrame) -> DataFrame:
    return report.groupBy("ac_year", "india_state_ut").agg(*sums(["total"]))


def student_report_plan(by_management: DataFrame, by_category: DataFrame) -> CheckPlan:
    """Both student reports by themselves and against each other; each is read once."""
    is_all, national = F.col("management") == ALL_MANAGEMENT, F.col("india_state_ut") == ALL_GEOGRAPHIES
    return (
        CheckPlan()
        .not_empty("report_management:not_empty", by_management)
        .not_empty("report_category:not_empty", by_category)
        .rules(by_management, {"report_management:row_math": not_sum("total", STAGES)})
        .whole("report_management:groups_equal_all", by_management, ["ac_year"], is_all, "total", national)
        .rules(by_category, {"report_category:row_math": not_sum("total", GROUP_COLUMNS)})
        .equal("report_category:equals_management_report", by_category, by_management,
               ["ac_year", "india_state_ut"], "total", right_where=is_all)
    )


def student_report_checks(by_management: DataFrame, by_category: DataFrame) -> DataFrame:
    return student_report_plan(by_management, by_category).frame()


def teacher_report_plan(
    fact: DataFrame, by_management: DataFrame, by_category: DataFrame
) -> CheckPlan:
    """Both teacher reports against their fact and each other; each frame is read once."""
    is_all, national = F.col("management") == ALL_MANAGEMENT, F.col("india_state_ut") == ALL_GEOGRAPHIES
    place = ["ac_year", "india_state_ut"]
    return (
        CheckPlan()
        .not_empty("teacher_management:not_empty", by_management)
        .not_empty("teacher_category:not_empty", by_category)
        .rules(by_management, {
            "teacher_management:stages": not_sum("total", TEACHER_STAGES),
            "teacher_management:grade_bands": not_sum("total", GRADE_BANDS)})
        .whole("teacher_management:groups_equal_all", by_management, place, is_all, "total")
        .equal("teacher_management:equals_fact", fact, by_management, ["academic_year"], "total",
               right_where=is_all & national, every="left", right_keys=["ac_year"],
               left_total="total_teachers")
        .rules(by_category, {"teacher_category:row_math": not_sum("total", GROUP_COLUMNS)})
        .equal("teacher_category:equals_management_report", by_category, by_management, place, "total",
               right_where=is_all, every="left")
    )


def teacher_report_checks(
    fact: DataFrame, by_management: DataFrame, by_category: DataFrame
) -> DataFrame:
    return teacher_report_plan(fact, by_management, by_category).frame()
