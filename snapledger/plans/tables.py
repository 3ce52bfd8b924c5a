"""Contracts of every stored table."""

from __future__ import annotations

from snapledger.functions.labels import GRADE_BANDS
from snapledger.functions.measures import MEASURES, METRICS, STAGES
from snapledger.storage.contracts import Contract, Field


def _text(name: str, length: int, nullable: bool = False) -> Field:
    return Field(name, "string", nullable, length)


def _number(name: str, kind: str = "int", nullable: bool = False) -> Field:
    return Field(name, kind, nullable)


YEAR = _text("academic_year", 7)
SCHOOL = _text("udise_sch_code", 32)
STATE, DISTRICT = _text("state_cd", 10), _text("district_cd", 20)
STATE_SK, DISTRICT_SK = _text("state_sk", 32), _text("district_sk", 32)
LINEAGE = (_text("source_db", 64), _text("source_schema", 96),
           Field("processed_at", "timestamp", nullable=False))
FLAGS = (_number("pre_primary_available", "tinyint"), _number("transgender_available", "tinyint"))
ATTRIBUTES = (
    _text("school_name", 255, nullable=True), STATE, DISTRICT,
    _number("sch_category_id", nullable=True), _number("management_center_id"),
    _number("school_status", nullable=True),
)

# Names, columns, types and lengths of the stored tables.
STATES = Contract(
    "state_master", (YEAR, STATE, _text("state_name", 160, nullable=True), *LINEAGE),
    keys=("academic_year", "state_cd"))
DISTRICTS = Contract(
    "district_master",
    (YEAR, STATE, DISTRICT, _text("district_name", 180, nullable=True), *LINEAGE),
    keys=("academic_year", "state_cd", "district_cd"))
CATEGORIES = Contract(
    "school_category_master",
    (YEAR, _number("sch_category_id"), _text("category_name", 255, nullable=True), *LINEAGE),
    keys=("academic_year", "sch_category_id"))
SCHOOLS = Contract(
    "school_master_snapshot",
    (YEAR, SCHOOL, *ATTRIBUTES, LINEAGE[0], LINEAGE[1], _text("source_table", 64), LINEAGE[2]),
    keys=("academic_year", "udise_sch_code"), partition_by=("academic_year",))
ENROLLMENT = Contract(
    "enrollment_social_category",
    (YEAR, SCHOOL, _number("item_group"), _number("item_id"), _text("social_category", 32),
     *[_number(m, "bigint", nullable=True) for m in METRICS], *FLAGS, *LINEAGE),
    keys=("academic_year", "udise_sch_code", "item_group", "item_id"),
    partition_by=("academic_year",))
TEACHERS = Contract(
    "staff_snapshot",
    (YEAR, SCHOOL, *[_number(n, "bigint") for n in ("male_tch", "female_tch", "transgen_tch")]),
    keys=("academic_year", "udise_sch_code"), partition_by=("academic_year",))

DIM_PERIOD = Contract(
    "dim_academic_year",
    (_number("academic_year_sk"), YEAR, _number("start_date", "date"),
     _number("end_date", "date"), _number("is_latest", "tinyint")),
    keys=("academic_year_sk",))
DIM_STATE = Contract(
    "dim_state", (STATE_SK, STATE, _text("state_name", 160, nullable=True)), keys=("state_sk",))
DIM_DISTRICT = Contract(
    "dim_district",
    (DISTRICT_SK, STATE_SK, STATE, DISTRICT, _text("district_name", 180, nullable=True)),
    keys=("district_sk",))
DIM_CATEGORY = Contract(
    "dim_category",
    (_number("category_sk"), _number("sch_category_id"), _text("category_name", 255, True),
     _text("education_detailed", 64, True), _text("category", 128, True),
     _text("category_detailed", 255, True)),
    keys=("category_sk",))
DIM_MANAGEMENT = Contract(
    "dim_management",
    (_number("management_sk"), _number("management_center_id"), _text("management", 128),
     _text("management_detailed", 255, True), _text("management_group", 64)),
    keys=("management_sk",))
DIM_SOCIAL = Contract(
    "dim_social_category",
    (_number("social_category_sk"), _number("item_group"), _number("item_id"),
     _text("social_category", 32)),
    keys=("social_category_sk",))
DIM_SCHOOL = Contract(
    "dim_school_scd2",
    (SCHOOL, _number("valid_from", "date"), _text("school_sk", 32), _number("version_no"),
     ATTRIBUTES[0], STATE_SK, DISTRICT_SK, _number("category_sk", nullable=True),
     _number("management_sk"), *ATTRIBUTES[1:], _number("valid_to", "date"),
     _number("is_current", "tinyint"), _text("row_hash", 32), _text("change_type", 32)),
    keys=("udise_sch_code", "valid_from"))
SCHOOL_AUDIT = Contract(
    "school_scd2_change_audit",
    (SCHOOL, _number("version_no"), _number("previous_valid_from", "date", True),
     _number("current_valid_from", "date"),
     _text("previous_school_name", 255, True), _text("current_school_name", 255, True),
     _text("previous_state_cd", 10, True), _text("current_state_cd", 10),
     _text("previous_district_cd", 20, True), _text("current_district_cd", 20),
     _number("previous_category_id", "int", True), _number("current_category_id", "int", True),
     _number("previous_management_id", "int", True), _number("current_management_id"),
     _number("previous_school_status", "int", True), _number("current_school_status", "int", True),
     _text("changed_columns", 500)),
    keys=("udise_sch_code", "version_no"))
FACT_STUDENT = Contract(
    "fact_enrollment",
    (_number("academic_year_sk"), _text("school_sk", 32), _number("social_category_sk"), STATE_SK,
     DISTRICT_SK, _number("category_sk", nullable=True), _number("management_sk"), YEAR, SCHOOL,
     _number("item_group"), _number("item_id"), *[_number(m, "bigint") for m in MEASURES], *FLAGS),
    keys=("academic_year", "udise_sch_code", "item_group", "item_id"),
    partition_by=("academic_year",))
FACT_TEACHER = Contract(
    "fact_staff",
    (YEAR, SCHOOL, STATE, _text("state_name", 160), _number("management_center_id"),
     _text("management_group", 64), _number("sch_category_id"), _text("category", 128),
     *[_number(n, "bigint")
       for n in ("male_tch", "female_tch", "transgen_tch", "total_teachers")]),
    keys=("academic_year", "udise_sch_code"), partition_by=("academic_year",))


def _report(table: str, scope: Field, measures: tuple[str, ...]) -> Contract:
    return Contract(
        table,
        (_text("ac_year", 7), _text("india_state_ut", 160), scope,
         *[_number(m, "bigint") for m in measures]),
        keys=("ac_year", "india_state_ut", scope.name), layer="report")


_GROUP_SPLIT = (
    "total", "government", "government_aided", "private_unaided_recognized", "others")
REPORT_MANAGEMENT = _report(
    "enrollment_by_management", _text("management", 64), ("total", *STAGES))
REPORT_CATEGORY = _report("enrollment_by_category", _text("category", 128), _GROUP_SPLIT)
TEACHER_MANAGEMENT = _report(
    "staff_by_management", _text("management", 64),
    ("total", "foundational_preparatory", "middle", "secondary", *GRADE_BANDS))
TEACHER_CATEGORY = _report("staff_by_category", _text("category", 128), _GROUP_SPLIT)
