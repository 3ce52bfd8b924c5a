from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapledger.operators.checks import CheckFailed, count_bad
from snapledger.operators.history import HistoryRefused
from snapledger.storage import publish as p
from snapledger.storage.contracts import Contract, Field
from tests.helpers import findings, rows

TABLE = Contract(
    "t",
    (Field("name", "string", nullable=False, max_length=3), Field("year", "string", nullable=False),
     Field("code", "string", nullable=False), Field("n", "bigint")),
    keys=("year", "code"), partition_by=("year",))
REPORT = Contract("r", (Field("k", "string", nullable=False), Field("total", "bigint")),
                  keys=("k",), layer="report")
SCHEMA = "year string, code string, name string, n string"
NOW = datetime(2025, 1, 1)


def _df(spark, *data):
    return spark.createDataFrame([("y", *d) for d in data], SCHEMA)


def _publish(spark, root, run, *data, **kwargs):
    return p.publish(spark, str(root), run, [(TABLE, _df(spark, *data))],
                     keep_history=["t"], now=NOW, **kwargs)


def test_contract_orders_keys_first_and_rejects_nonsense():
    assert TABLE.columns == ["year", "code", "name", "n"]
    with pytest.raises(ValueError):
        Contract("x", (Field("a"),), keys=("b",))
    with pytest.raises(ValueError):
        Contract("x", (Field("a"), Field("a")), keys=("a",))


def test_contract_violations_in_one_report(spark):
    df = _df(spark, ("1", "long", "5"), ("1", None, "x"), (None, "ok", None))
    assert findings(TABLE.violations(df)) == {
        "t.year:required": 0, "t.code:required": 1, "t.name:required": 1, "t.name:length": 1,
        "t.n:type": 1, "t:unique_key": 1}
    assert TABLE.conform(df).schema["n"].dataType.simpleString() == "bigint"


def test_publish_read_and_history(spark, tmp_path):
    _publish(spark, tmp_path, "r1", ("1", "a", "1"), ("2", "b", "2"))
    _publish(spark, tmp_path, "r2", ("1", "a", "9"), ("3", "c", "3"))
    commit = _publish(spark, tmp_path, "r3", ("1", "a", "9"), ("2", "b", "2"), ("3", "c", "3"))
    assert commit.seq == 3
    now = p.read_table(spark, str(tmp_path), "t")
    assert rows(now, "code", "n") == [("1", 9), ("2", 2), ("3", 3)]
    history = p.read_table(spark, str(tmp_path), "t_history")
    assert rows(history, "code", "version_no", "change_type", "is_current") == [
        ("1", 1, "INITIAL", 0), ("1", 2, "CHANGE", 1), ("2", 1, "INITIAL", 0),
        ("2", 2, "DELETE", 0), ("2", 3, "REACTIVATED", 1), ("3", 1, "INITIAL", 1)]
    # each run writes the rows it closed once; only the newest current segment is read
    segments = [Path(s).relative_to(tmp_path).as_posix() for s in commit.tables["t_history"]]
    assert segments == ["t_history/r2/segment=closed", "t_history/r3/segment=closed",
                        "t_history/r3/segment=current"]


def test_unchanged_data_writes_no_history(spark, tmp_path):
    first = _publish(spark, tmp_path, "r1", ("1", "a", "1"))
    second = _publish(spark, tmp_path, "r2", ("1", "a", "1"))
    assert second.tables["t_history"] == first.tables["t_history"]
    assert second.tables["t"] != first.tables["t"]


def test_history_that_starts_late_records_the_existing_table(spark, tmp_path):
    p.publish(spark, str(tmp_path), "r1", [(TABLE, _df(spark, ("1", "a", "1"), ("2", "b", "2")))])
    _publish(spark, tmp_path, "r2", ("1", "a", "2"), ("2", "b", "2"))
    history = p.read_table(spark, str(tmp_path), "t_history")
    assert rows(history, "code", "version_no", "n", "change_type") == [
        ("1", 1, 1, "INITIAL"), ("1", 2, 2, "CHANGE"), ("2", 1, 2, "INITIAL")]


@pytest.mark.parametrize("data, message", [
    ([("1", "a", "1"), ("1", "a", "1")], "t:unique_key"),
    ([(None, "a", "1")], "t.code:required"),
    ([("1", "long", "1")], "t.name:length"),
    ([("1", "a", "x")], "t:type"),
    ([], "t:not_empty"),
])
def test_bad_tables_never_become_visible(spark, tmp_path, data, message):
    _publish(spark, tmp_path, "r1", ("1", "a", "1"))
    with pytest.raises(CheckFailed, match=message):
        _publish(spark, tmp_path, "r2", *data)
    assert p.latest_commit(spark, str(tmp_path)).run_id == "r1"
    assert rows(p.read_table(spark, str(tmp_path), "t"), "code", "n") == [("1", 1)]


def test_row_count_and_own_checks_gate_the_commit(spark, tmp_path):
    with pytest.raises(CheckFailed, match="t:expected_rows"):
        _publish(spark, tmp_path, "r1", ("1", "a", "1"), expected_rows={"t": 2})
    with pytest.raises(CheckFailed, match="mine"):
        _publish(spark, tmp_path, "r1", ("1", "a", "1"),
                 checks=lambda staged: count_bad(staged["t"], {"mine": F.col("n") == 1}))
    assert p.latest_commit(spark, str(tmp_path)) is None
    # a failed run may be repeated under its own id
    assert _publish(spark, tmp_path, "r1", ("1", "a", "1")).seq == 1


def test_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    _publish(spark, tmp_path, "r1", ("1", "a", "1"))

    def crash(*_):
        raise OSError("executor and driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(p.hist, "step_checks", crash)
        with pytest.raises(OSError):
            _publish(spark, tmp_path, "r2", ("1", "a", "2"))
    assert not (tmp_path / "t" / "r2").exists() and not (tmp_path / "t_history" / "r2").exists()
    assert rows(p.read_table(spark, str(tmp_path), "t"), "n") == [(1,)]
    assert p.read_table(spark, str(tmp_path), "t_history").count() == 1
    _publish(spark, tmp_path, "r2", ("1", "a", "2"))
    assert p.read_table(spark, str(tmp_path), "t_history").count() == 2


def test_repeating_a_committed_run_is_a_no_op(spark, tmp_path):
    _publish(spark, tmp_path, "r1", ("1", "a", "1"))
    again = _publish(spark, tmp_path, "r1", ("1", "a", "5"))
    assert again.seq == 1 and rows(p.read_table(spark, str(tmp_path), "t"), "n") == [(1,)]


def test_several_tables_in_one_commit_and_reports_without_history(spark, tmp_path):
    report = spark.createDataFrame([("k", 1)], "k string, total bigint")
    outputs = [(TABLE, _df(spark, ("1", "a", "1"))), (REPORT, report)]
    with pytest.raises(ValueError, match="no history"):
        p.publish(spark, str(tmp_path), "r1", outputs, keep_history=["t", "r"])
    commit = p.publish(spark, str(tmp_path), "r1", outputs, keep_history=["t"], now=NOW)
    assert set(commit.tables) == {"t", "t_history", "r"}
    assert findings(p.ready_checks(spark, str(tmp_path), ["t", "r"])) == {
        "t:not_empty": 0, "r:not_empty": 0}
    with pytest.raises(LookupError):
        p.read_table(spark, str(tmp_path), "nope")
    with pytest.raises(ValueError, match="unsafe"):
        p.publish(spark, str(tmp_path), "../r", outputs)


def test_history_refuses_a_changed_schema(spark, tmp_path):
    _publish(spark, tmp_path, "r1", ("1", "a", "1"))
    wider = Contract("t", (*TABLE.fields, Field("extra")), keys=TABLE.keys)
    df = _df(spark, ("1", "a", "1")).withColumn("extra", F.lit("x"))
    with pytest.raises(HistoryRefused):
        p.publish(spark, str(tmp_path), "r2", [(wider, df)], keep_history=["t"], now=NOW)


def test_period_labels_that_look_like_months_stay_labels(spark, tmp_path):
    df = spark.createDataFrame([("2009-10", "1", "a", "1"), ("2010-11", "1", "a", "1")], SCHEMA)
    p.publish(spark, str(tmp_path), "r1", [(TABLE, df)])
    p.publish(spark, str(tmp_path), "r2", [(TABLE, df.replace("a", "b"))], keep_history=["t"], now=NOW)
    assert rows(p.read_table(spark, str(tmp_path), "t"), "year", "name") == [
        ("2009-10", "b"), ("2010-11", "b")]
    history = p.read_table(spark, str(tmp_path), "t_history")
    assert rows(history, "year", "version_no") == [
        ("2009-10", 1), ("2009-10", 2), ("2010-11", 1), ("2010-11", 2)]
