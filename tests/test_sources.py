import json
from pathlib import Path

import pytest

from snapledger.operators.checks import CheckFailed, enforce
from snapledger.sources import columns, scan
from snapledger.sources.columns import Alias
from tests.helpers import findings, rows


def _drop(spark, path, value=1, name="x"):
    spark.createDataFrame([(value,)], f"{name} int").write.parquet(str(path))


def test_scan_one_period_and_all_periods(spark, tmp_path):
    _drop(spark, tmp_path / "2020-21" / "t", 1)
    _drop(spark, tmp_path / "2021-22" / "t", 2)
    assert rows(scan.scan_annual(spark, str(tmp_path), "2021-22", "t")) == [(2,)]
    every = scan.scan_periods(spark, str(tmp_path), "t")
    assert rows(every, "academic_year", "x") == [("2020-21", 1), ("2021-22", 2)]


def test_scan_missing_drop_raises(spark, tmp_path):
    with pytest.raises(scan.SourceMissing, match="2020-21"):
        scan.scan_annual(spark, str(tmp_path), "2020-21", "t")


def test_union_fills_or_refuses_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "k")], "x int, y string")
    assert rows(scan.union_periods([a, b])) == [(1, None), (2, "k")]
    with pytest.raises(Exception):
        scan.union_periods([a, b], allow_missing=False).collect()
    with pytest.raises(ValueError):
        scan.union_periods([])


def test_list_tables_and_run_selection_from_folders(spark, tmp_path):
    for table in ("a", "b", "m1"):
        _drop(spark, tmp_path / "bronze_runs" / "r1" / "2020-21" / table)
    _drop(spark, tmp_path / "bronze_runs" / "r2" / "2020-21" / "a")
    _drop(spark, tmp_path / "bronze" / "2021-22" / "a")
    found = scan.list_tables(spark, str(tmp_path), "bronze", "bronze_runs")
    assert ("2020-21", "r1", "m1") in rows(found) and ("2021-22", None, "a") in rows(found)
    chosen = scan.complete_runs(found, ["a", "b"], ["m1", "m2"])
    assert rows(chosen) == [
        ("2020-21", "r1", "m1", 1, "COMPLETE"), ("2021-22", None, None, 0, "CANONICAL")]


def test_run_selection_statuses(spark):
    seen = [
        ("none", "r1", "a"), ("none", "r1", "m1"),
        ("two_masters", "r1", "a"), ("two_masters", "r1", "b"), ("two_masters", "r1", "m1"),
        ("two_masters", "r1", "m2"),
        ("ambiguous", "r1", "a"), ("ambiguous", "r1", "b"), ("ambiguous", "r1", "m1"),
        ("ambiguous", "r2", "a"), ("ambiguous", "r2", "b"), ("ambiguous", "r2", "m2"),
        ("canonical", None, "a"), ("canonical", "r1", "a"), ("canonical", "r1", "b"),
        ("canonical", "r1", "m1"), ("canonical", None, "m2"),
    ]
    df = spark.createDataFrame(seen, scan.PRESENCE)
    assert rows(scan.complete_runs(df, ["a", "b"], ["m1", "m2"])) == [
        ("ambiguous", None, None, 2, "AMBIGUOUS"),
        ("canonical", None, "m2", 1, "CANONICAL"),
        ("none", None, None, 0, "NONE"),
        ("two_masters", None, None, 0, "NONE"),
    ]


def test_manifest_counts_and_json(spark, tmp_path):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3)], "y string, x int")
    out = scan.manifest({"t": (df, F.col("y"))})
    assert rows(out) == [("p", "t", 2), ("q", "t", 1)]
    scan.write_manifest(out, str(tmp_path / "m"))
    lines = [line for f in Path(tmp_path / "m").glob("*.json") for line in f.read_text().splitlines()]
    assert {json.loads(line)["n_rows"] for line in lines} == {1, 2}


ROLES = {"code": Alias(("udise_sch_code", "school_code")), "name": Alias(("sch_name",), False)}


def test_resolve_columns_first_match_any_case(spark):
    df = spark.createDataFrame([(1, 2)], "School_Code int, UDISE_sch_code int")
    assert columns.resolve_columns(df, ROLES) == {"code": "UDISE_sch_code", "name": None}
    with pytest.raises(columns.ColumnMissing, match="school_code"):
        columns.resolve_columns(df.select(df.columns[0]).toDF("other"), ROLES)


def test_schema_report_sees_drift_in_later_files(spark, tmp_path):
    spark.createDataFrame([(1,)], "school_code int").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(2, "n")], "school_code int, sch_name string").write.mode(
        "append").parquet(str(tmp_path / "t"))
    df = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "t"))
    report = columns.schema_report("t", df, ROLES)
    assert rows(report, "role", "column_name", "status", "n_rows", "n_null") == [
        ("code", "school_code", "OK", 2, 0), ("name", "sch_name", "OK", 2, 1)]
    bad = columns.schema_report("t", df.drop("school_code"), ROLES)
    with pytest.raises(CheckFailed, match="t:schema"):
        enforce(columns.schema_checks([bad]))


def test_list_tables_counts_only_what_follows_the_root(spark, tmp_path):
    root = tmp_path / "bronze" / "prod" / "raw"
    _drop(spark, root / "bronze" / "2024-25" / "mst_state")
    for name in (str(root), f"file://{root}/"):
        assert rows(scan.list_tables(spark, name, "bronze", "bronze_runs")) == [("2024-25", None, "mst_state")]
    assert scan.list_tables(spark, str(tmp_path / "none"), "bronze", "bronze_runs").isEmpty()


def test_schema_rules_read_no_data(spark, tmp_path):
    from snapledger.sources.columns import Alias, schema_checks, schema_rules
    df = spark.createDataFrame([(1,)], "Code int")
    rules = schema_rules("t", df, {"code": Alias(("code",)), "name": Alias(("name",)), "x": Alias(("x",), required=False)})
    assert rows(rules, "role", "column_name", "status") == [
        ("code", "Code", "OK"), ("name", None, "MISSING"), ("x", None, "ABSENT")]
    assert findings(schema_checks([rules])) == {"t:schema": 1}
