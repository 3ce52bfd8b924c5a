import pytest
from pyspark.sql import functions as F

from snapledger.functions.measures import METRICS
from snapledger.operators.checks import CheckFailed, enforce
from snapledger.sources import normalize as n
from snapledger.sources.columns import ColumnMissing
from tests.helpers import findings, rows

LINEAGE = n.Lineage("db", "sch", "2025-01-01 00:00:00")
SCHOOL_LINEAGE = n.Lineage("db", "sch", "2025-01-01 00:00:00", "school_master")
SCHOOL = ("udise_sch_code string, school_name string, state_cd string, district_cd string, "
          "sch_category_id string, management_center_id string, school_status string")


def _schools(spark, data):
    return spark.createDataFrame(data, SCHOOL)


def test_state_keeps_greatest_name_and_lineage(spark):
    raw = spark.createDataFrame([(" 27 ", "B"), ("27", "A"), ("27", None)], "State_Cd string, STATE_NAME_ENG string")
    out = n.normalize_state(raw, "2025-26", LINEAGE)
    assert rows(out, "academic_year", "state_cd", "state_name", "source_db") == [
        ("2025-26", "27", "B", "db")]


def test_state_name_is_optional(spark):
    raw = spark.createDataFrame([(27,)], "state_code int")
    assert rows(n.normalize_state(raw, "2025-26", LINEAGE), "state_cd", "state_name") == [("27", None)]


def test_district_code_reused_by_two_states_keeps_both(spark):
    raw = spark.createDataFrame([("1", "9", "x"), ("2", "9", "y"), ("2", "8", "z")],
                                "state_cd string, district_cd string, district_name string")
    out = n.normalize_district(raw, "2025-26", LINEAGE)
    assert out.count() == 3
    assert rows(n.reused_district_codes(out)) == [("2025-26", "9", "1", "2")]


def test_category_name_is_required(spark):
    with pytest.raises(ColumnMissing):
        n.normalize_category(spark.createDataFrame([(1,)], "category_id int"), "p", LINEAGE)
    raw = spark.createDataFrame([("3", " "), ("x", "name")], "category_id string, category string")
    out = n.normalize_category(raw, "p", LINEAGE)
    assert findings(n.category_checks(out)) == {
        "category:name_required": 1, "category:id_required": 1}


def test_snapshot_drops_blank_codes_keeps_tab_codes(spark):
    raw = _schools(spark, [
        ("", "a", "1", "1", "1", "1", "1"), (None, "a", "1", "1", "1", "1", "1"),
        ("\t", "tab", "1", "1", "1", "1", "1"), (" S ", "ok", "1", "1", "1", "1", "1")])
    out = n.normalize_snapshot(raw, "p", SCHOOL_LINEAGE)
    assert rows(out, "udise_sch_code") == [("\t",), ("S",)]


def test_snapshot_duplicates_identical_collapse_conflicting_fail(spark):
    same = ("S", "a", "1", "1", "1", "1", "1")
    raw = _schools(spark, [same, same])
    assert n.normalize_snapshot(raw, "p", SCHOOL_LINEAGE).count() == 1
    enforce(n.snapshot_checks(raw, "p", SCHOOL_LINEAGE))
    clash = _schools(spark, [same, ("S", "b", "1", "1", "1", "1", "1")])
    with pytest.raises(CheckFailed, match="conflicting_duplicates"):
        enforce(n.snapshot_checks(clash, "p", SCHOOL_LINEAGE))
    assert n.normalize_snapshot(raw, "p", SCHOOL_LINEAGE, duplicates="unique").count() == 2
    with pytest.raises(ValueError):
        n.normalize_snapshot(raw, "p", SCHOOL_LINEAGE, duplicates="keep")


def test_snapshot_reports_every_required_value_and_bad_numbers(spark):
    raw = _schools(spark, [
        ("A", "a", "", "1", "1", "1", "1"), ("B", "b", "1", None, "x", "1", "1"),
        ("C", "c", "1", "1", "1", "no", "y")])
    assert findings(n.snapshot_checks(raw, "p", SCHOOL_LINEAGE)) == {
        "school:state_cd_required": 1, "school:district_cd_required": 1,
        "school:management_center_id_required": 1, "school:conflicting_duplicates": 0,
        "school:category_number": 1, "school:status_number": 1}


def test_measures_absent_null_case_and_flags(spark):
    raw = spark.createDataFrame(
        [("S", "1", "1", 5, None), ("S", "1", "4", 7, 1), ("S", "1", "5", 9, 1),
         ("S", "2", "1", 9, 1), ("S", None, "1", 9, 1)],
        "school_code string, item_group string, itemid string, C3_B int, c1_b int")
    out = n.normalize_measures(raw, "p", LINEAGE)
    assert rows(out, "item_id", "social_category", "c3_b", "c1_b", "pp3_b",
                "pre_primary_available", "transgender_available") == [
        (1, "General", 5, None, 0, 0, 0), (4, "OBC", 7, 1, 0, 0, 0)]
    assert set(METRICS) <= set(out.columns)


def test_measure_flags_and_unreadable_metrics(spark):
    raw = spark.createDataFrame([("S", 1, 1, "x", "3")],
                                "school_code string, item_group int, item_id int, pp1_g string, c9_t string")
    out = n.normalize_measures(raw, "p", LINEAGE)
    assert rows(out, "pre_primary_available", "transgender_available", "pp1_g", "c9_t") == [(1, 1, None, 3)]
    assert findings(n.metric_checks(raw)) == {
        "enrollment:pp1_g_number": 1, "enrollment:c9_t_number": 0,
        "enrollment:item_group_number": 0, "enrollment:item_id_number": 0}


def test_pre_primary_flag_ignores_transgender_columns(spark):
    raw = spark.createDataFrame([("S", 1, 1, 2)], "school_code string, item_group int, item_id int, pp1_t int")
    out = n.normalize_measures(raw, "p", LINEAGE)
    assert rows(out, "pre_primary_available", "transgender_available") == [(0, 1)]


def test_counts_reject_null_negative_blank_and_any_duplicate(spark):
    kind = "udise_sch_code string, male_tch string, female_tch int, transgen_tch int"
    good = n.normalize_counts(spark.createDataFrame([("S", "6", 4, 0)], kind), "p")
    assert rows(good) == [("p", "S", 6, 4, 0)]
    enforce(n.counts_checks(good))
    for data in ([("S", "x", 1, 1)], [("S", "1", -1, 1)], [(" ", "1", 1, 1)], [(None, "1", 1, 1)],
                 [("S", "1", 1, 1)] * 2):
        with pytest.raises(CheckFailed):
            enforce(n.counts_checks(n.normalize_counts(spark.createDataFrame(data, kind), "p")))


def test_one_frame_may_hold_several_periods(spark):
    raw = spark.createDataFrame([("p1", "1"), ("p2", "1")], "y string, state_cd string")
    out = n.normalize_state(raw, F.col("y"), LINEAGE)
    assert rows(out, "academic_year", "state_cd") == [("p1", "1"), ("p2", "1")]


def test_unreadable_items_and_fractions_are_findings(spark):
    raw = spark.createDataFrame([("S", "1", "general", 5.0), ("S", "x", "1", 1.7), ("S", "1", "1", 2.0)],
                                "school_code string, item_group string, itemid string, c3_b double")
    assert findings(n.metric_checks(raw)) == {
        "enrollment:c3_b_number": 1, "enrollment:item_group_number": 1, "enrollment:itemid_number": 1}
    kind = "udise_sch_code string, male_tch double, female_tch int, transgen_tch int"
    with pytest.raises(CheckFailed):
        enforce(n.counts_checks(n.normalize_counts(spark.createDataFrame([("S", 2.5, 1, 1)], kind), "p")))


def test_blank_codes_and_shared_names_are_counted(spark):
    raw = _schools(spark, [(" ", "n", "1", "1", "1", "1", "1"), (None, "n", "1", "1", "1", "1", "1"),
                           ("S", "n", "1", "1", "1", "1", "1")])
    assert findings(n.blank_codes(raw)) == {"school:blank_code_left_out": 2}
    states = spark.createDataFrame([("p", "1", "A"), ("p", "2", "A"), ("p", "3", "B")],
                                   "academic_year string, state_cd string, state_name string")
    assert rows(n.shared_state_names(states)) == [("p", "A", "1", "2")]
