"""Findings of single files of a drop."""

from pathlib import Path

import pytest

from snapledger.operators.checks import CheckFailed, enforce
from snapledger.sources import footers, scan
from snapledger.sources.columns import Alias
from tests.helpers import findings, rows

ROLES = {
    "code": Alias(("udise_sch_code", "school_code")),
    "count": Alias(("c1_b",)),
    "name": Alias(("sch_name",), required=False),
    "note": Alias(("remark",), required=False),
}


def _file(spark, path, values, schema):
    spark.createDataFrame([values], schema).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def drop(spark, tmp_path):
    """Three files alike, one without the count, one with another name and type of the code."""
    path = tmp_path / "2020-21" / "t"
    for code in (1, 2, 3):
        _file(spark, path, (code, 5, "n"), "UDISE_sch_code bigint, c1_b int, sch_name string")
    _file(spark, path, (4, "n"), "udise_sch_code bigint, sch_name string")
    _file(spark, path, ("5", 5), "school_code string, c1_b int")
    return path


def _statuses(report):
    return sorted(tuple(r) for r in report.groupBy("role", "status").count().collect())


EXPECTED = [
    ("code", "DRIFT", 1), ("code", "OK", 4), ("count", "MISSING", 1), ("count", "OK", 4),
    ("name", "OK", 4), ("name", "PARTIAL", 1), ("note", "ABSENT", 5),
]


def test_one_deviating_file_is_a_finding(spark, drop):
    report = footers.file_report("t", footers.file_schemas(spark, str(drop)), ROLES)
    assert _statuses(report) == EXPECTED
    drifted = report.filter("status = 'DRIFT'").select("column_name", "column_type")
    assert rows(drifted) == [("school_code", "string")]
    checks = footers.file_checks(report)
    assert findings(checks) == {
        "t:every_file_has_columns": 1, "t:one_type_per_column": 1, "t:readable_footers": 0}
    with pytest.raises(CheckFailed, match="every_file_has_columns"):
        enforce(checks)


def test_spark_reads_footers_of_other_stores_alike(spark, drop, monkeypatch):
    seen = sorted(map(str, footers.file_schemas(spark, str(drop)).collect()))
    monkeypatch.setattr(footers, "_reachable", lambda path: False)
    assert sorted(map(str, footers.file_schemas(spark, str(drop)).collect())) == seen


@pytest.mark.parametrize("in_tasks", [True, False])
def test_broken_and_missing_files(spark, drop, monkeypatch, in_tasks):
    if not in_tasks:
        monkeypatch.setattr(footers, "_reachable", lambda path: False)
    Path(drop, "cut.parquet").write_bytes(b"PAR1 and then nothing of use")
    report = footers.file_report("t", footers.file_schemas(spark, str(drop)), ROLES)
    assert rows(report.filter("status = 'UNREADABLE'").select("role")) == [(r,) for r in sorted(ROLES)]
    assert findings(footers.file_checks(report))["t:readable_footers"] == 1
    empty = drop.parent / "nothing"
    empty.mkdir()
    assert footers.file_schemas(spark, str(empty)).count() == 0


def test_types_per_column(spark, drop):
    found = footers.column_types(footers.file_schemas(spark, str(drop)))
    assert rows(found, "column", "type", "n_files") == [
        ("c1_b", "int", 4), ("sch_name", "string", 4), ("school_code", "string", 1),
        ("udise_sch_code", "bigint", 4)]


def test_names_of_types_are_sparks(spark, tmp_path):
    kinds = ("a tinyint, b decimal(10,2), c date, d timestamp_ntz, e array<int>, f double, g boolean")
    spark.createDataFrame([], kinds).coalesce(1).write.parquet(str(tmp_path / "t"))
    [(columns,)] = rows(footers.file_schemas(spark, str(tmp_path / "t")).select("columns"))
    assert {c["name"]: c["type"] for c in columns} == {
        f.name: f.dataType.simpleString() for f in spark.createDataFrame([], kinds).schema}


def test_types_that_cannot_be_merged_are_named(spark, tmp_path):
    path = tmp_path / "2020-21" / "t"
    _file(spark, path, (1, 1), "code int, n int")
    _file(spark, path, (1, "x"), "code int, N string")
    assert scan.scan_annual(spark, str(tmp_path), "2020-21", "t").count() == 2
    with pytest.raises(scan.SchemaDrift, match=r"2020-21: files of t differ in \[\('n', \['int', 'string'\]\)\]"):
        scan.scan_annual(spark, str(tmp_path), "2020-21", "t", merge_schema=True)
