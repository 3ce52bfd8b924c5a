from datetime import datetime

import pytest

from snapledger.operators.checks import CheckFailed
from snapledger.plans import warehouse as w
from snapledger.sources.scan import SourceMissing
from snapledger.storage.publish import latest_commit, read_table
from tests.helpers import rows

SOURCES = {"2024-25": ("db24", "sch24"), "2025-26": ("db25", "sch25")}
GRADES = [f"c{n}_{s}" for n in (1, 6, 12) for s in "bg"]


def _write(spark, path, schema, data):
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(path))


def _drop(spark, base, names, schools, enrollment, teachers):
    _write(spark, base / "mst_state", f"{names['state']} string, state_name string", [("27", "Maharashtra")])
    _write(spark, base / "mst_district", f"{names['state']} string, district_code string",
           [("27", "2701"), ("27", "2702")])
    _write(spark, base / "mst_sch_category", "category_id int, sch_category_name string",
           [(1, "Primary"), (2, "Upper primary")])
    _write(spark, base / names["master"],
           f"{names['school']} string, sch_name string, state_cd string, district_cd string, "
           "category_id int, sch_mgmt_center_id int", schools)
    _write(spark, base / "sch_enr_fresh",
           f"{names['school']} string, item_group int, item_id int, "
           + ", ".join(f"{g} int" for g in GRADES), enrollment)
    _write(spark, base / "tch_summary",
           "udise_sch_code string, male_tch int, female_tch int, transgen_tch int", teachers)


def _root(spark, tmp_path):
    old = {"state": "state_cd", "school": "school_code", "master": "sch_master"}
    new = {"state": "Udise_State_Code", "school": "UDISE_SCH_CODE", "master": "school_master"}
    _drop(spark, tmp_path / "bronze_runs" / "run1" / "2024-25", old,
          [("A", "Alpha", "27", "2701", 1, 1), ("B", "Beta", "27", "2702", 2, 2)],
          [("A", 1, 1, 1, 2, 3, 4, 5, 6), ("B", 1, 2, 10, 0, 0, 0, 0, None)],
          [("A", 1, 2, 0), ("B", 3, 0, 1)])
    _drop(spark, tmp_path / "bronze" / "2025-26", new,
          [("A", "Alpha", "27", "2701", 1, 2), ("B", "Beta", "27", "2702", 2, 2)],
          [("A", 1, 1, 2, 2, 2, 2, 2, 2), ("B", 1, 4, 1, 1, 1, 1, 1, 1), ("B", 2, 1, 9, 9, 9, 9, 9, 9)],
          [("A", 2, 2, 0), ("B", 3, 1, 1)])
    return str(tmp_path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = _root(spark, tmp_path_factory.mktemp("raw"))
    root = str(tmp_path_factory.mktemp("warehouse"))
    management = spark.createDataFrame(
        [(1, "Govt school"), (2, "Govt. aided")], "management_center_id int, management string")
    drops = w.open_drops(spark, raw, SOURCES)
    w.build_student(spark, root, "one", drops, management, "2026-01-01 00:00:00",
                    now=datetime(2026, 1, 1))
    w.publish_snapshots(spark, root, "two", drops, "2026-01-02 00:00:00", datetime(2026, 1, 2))
    w.build_teacher(spark, root, "one", drops, now=datetime(2026, 1, 3))
    return root, drops, management


def test_student_reports(spark, built):
    counts = spark.read.json(f"{built[0]}/manifests/*")
    assert {"mst_state", "sch_enr_fresh"} <= {r["table"] for r in counts.collect()}
    assert all(r["n_bad"] == 0 for r in spark.read.json(f"{built[0]}/left_out/*").collect())
    report = read_table(spark, built[0], "enrollment_by_management")
    assert rows(report.filter("india_state_ut = 'Available Source Total'"),
                "ac_year", "management", "total", "foundational", "middle", "secondary") == [
        ("2024-25", "All Management", 31, 13, 7, 11), ("2024-25", "Government", 21, 3, 7, 11),
        ("2024-25", "Government Aided", 10, 10, 0, 0), ("2025-26", "All Management", 18, 6, 6, 6),
        ("2025-26", "Government Aided", 18, 6, 6, 6)]
    by_category = read_table(spark, built[0], "enrollment_by_category")
    assert rows(by_category.filter("ac_year = '2025-26'"), "india_state_ut", "category", "total") == [
        ("Available Source Total", "Foundational + Preparatory School", 12),
        ("Available Source Total", "Middle School", 6),
        ("Maharashtra", "Foundational + Preparatory School", 12), ("Maharashtra", "Middle School", 6)]


def test_school_versions_and_audit(spark, built):
    versions = read_table(spark, built[0], "dim_school_scd2")
    assert rows(versions, "udise_sch_code", "version_no", "management_sk", "is_current") == [
        ("A", 1, 1, 0), ("A", 2, 2, 1), ("B", 1, 2, 1)]
    audit = read_table(spark, built[0], "school_scd2_change_audit")
    assert rows(audit, "udise_sch_code", "changed_columns") == [("A", "management")]


def test_second_identical_run_adds_no_history(spark, built):
    for table, n in (("school_master_snapshot", 4), ("state_master", 2)):
        history = read_table(spark, built[0], f"{table}_history")
        assert [r["change_type"] for r in history.collect()] == ["INITIAL"] * n


def test_reports_keep_no_history(spark, built):
    stored = latest_commit(spark, built[0]).tables
    assert "fact_enrollment_history" in stored
    assert "enrollment_by_management_history" not in stored
    assert "enrollment_by_category_history" not in stored


def test_teacher_reports_and_history_of_a_change(spark, built):
    root, drops, _ = built
    report = read_table(spark, root, "staff_by_management")
    assert rows(report.filter("management = 'All Management' AND india_state_ut = 'Maharashtra'"),
                "ac_year", "total", "grades_1_5", "grades_1_8") == [
        ("2024-25", 7, 3, 4), ("2025-26", 9, 4, 5)]
    changed = [w.Drop(d.period, d.source_db, d.source_schema, d.school_table, dict(d.tables)) for d in drops]
    raw = changed[1].tables["tch_summary"]
    changed[1].tables["tch_summary"] = raw.replace(3, 13, subset=["male_tch"])
    w.build_teacher(spark, root, "changed", changed, now=datetime(2026, 1, 4))
    history = read_table(spark, root, "fact_staff_history")
    assert rows(history.filter("udise_sch_code = 'B' AND academic_year = '2025-26'"),
                "version_no", "total_teachers", "change_type", "is_current") == [
        (1, 5, "INITIAL", 0), (2, 15, "CHANGE", 1)]


def test_manifest_lists_every_source_table(spark, built):
    got = rows(w.drop_manifest(built[1]), "academic_year", "table", "n_rows", "school_master_table")
    assert ("2024-25", "sch_master", 2, "sch_master") in got
    assert ("2025-26", "sch_enr_fresh", 3, "school_master") in got and len(got) == 12


def test_missing_drop_is_reported(spark, built, tmp_path):
    _drop(spark, tmp_path / "bronze" / "2025-26",
          {"state": "state_cd", "school": "school_code", "master": "sch_master"}, [("A", "a", "27", "1", 1, 1)],
          [("A", 1, 1, 1, 1, 1, 1, 1, 1)], [("A", 1, 1, 1)])
    with pytest.raises(SourceMissing, match="2024-25: NONE"):
        w.open_drops(spark, str(tmp_path), SOURCES)


def test_enrollment_of_unknown_schools_stops_the_snapshots(spark, built, tmp_path):
    drop = built[1][1]
    broken = w.Drop(drop.period, drop.source_db, drop.source_schema, drop.school_table, dict(drop.tables))
    master = broken.tables[drop.school_table]
    broken.tables[drop.school_table] = master.filter("UDISE_SCH_CODE = 'A'")
    with pytest.raises(CheckFailed, match="school_in_register"):
        w.publish_snapshots(spark, str(tmp_path), "r", [broken], "2026-01-01 00:00:00")
    assert latest_commit(spark, str(tmp_path)) is None


def test_one_file_with_another_name_of_the_code_stops_the_snapshots(spark, built, tmp_path):
    """Merged schemas have both names; rows of the second file would lose their code."""
    drop = built[1][1]
    path = tmp_path / "2025-26" / "sch_enr_fresh"
    raw = drop.tables["sch_enr_fresh"]
    code = next(c for c in raw.columns if c.lower() in ("udise_sch_code", "school_code"))
    other = "school_code" if code.lower() == "udise_sch_code" else "udise_sch_code"
    raw.coalesce(1).write.parquet(str(path))
    raw.withColumnRenamed(code, other).coalesce(1).write.mode("append").parquet(str(path))
    for table in (drop.school_table, "tch_summary"):
        drop.tables[table].write.parquet(str(tmp_path / "2025-26" / table))
    tables = drop.tables | {"sch_enr_fresh": spark.read.option("mergeSchema", True).parquet(str(path))}
    broken = w.Drop(drop.period, drop.source_db, drop.source_schema, drop.school_table, tables,
                    str(tmp_path / "2025-26"))
    with pytest.raises(CheckFailed, match="2025-26/sch_enr_fresh:one_type_per_column"):
        w.publish_snapshots(spark, str(tmp_path / "out"), "r", [broken], "2026-01-01 00:00:00")


def test_missing_required_metric_stops_before_reading(spark, built, tmp_path):
    drop = built[1][1]
    broken = w.Drop(drop.period, drop.source_db, drop.source_schema, drop.school_table, dict(drop.tables))
    broken.tables["sch_enr_fresh"] = broken.tables["sch_enr_fresh"].drop("c12_g")
    with pytest.raises(CheckFailed, match="2025-26/sch_enr_fresh:schema"):
        w.publish_snapshots(spark, str(tmp_path), "r", [broken], "2026-01-01 00:00:00")
