"""What a run writes again, what it counts, and what it leaves where it was."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapledger.operators import history as hist
from snapledger.operators.checks import CheckFailed
from snapledger.storage import publish as p
from snapledger.storage.contracts import Contract, Field
from tests.helpers import bag, findings, rows

TABLE = Contract(
    "t", (Field("year", nullable=False), Field("code", nullable=False), Field("n", "bigint"), Field("processed_at")),
    keys=("year", "code"), partition_by=("year",))
SCHEMA = "year string, code string, n bigint, processed_at string"
NOW = datetime(2025, 1, 1)


def _publish(spark, root, run, data, **kwargs):
    day = kwargs.pop("day", 0)
    return p.publish(spark, str(root), run, [(TABLE, spark.createDataFrame([(*d, run) for d in data], SCHEMA))],
                     keep_history=["t"], now=NOW + timedelta(days=day), **kwargs)


def _files(root, table="t_history"):
    return {str(f.relative_to(root)) for f in (Path(root) / table).rglob("*.parquet")}


def _relative(root, commit):
    return [Path(f).relative_to(root).as_posix() for f in commit.tables["t_history"]]


def test_a_change_in_one_year_leaves_the_others_untouched(spark, tmp_path):
    years = ["2009-10", "2010-11", "a b/ü:%"]
    data = [(y, c, 1) for y in years for c in "abc"]
    _publish(spark, tmp_path, "r1", data)
    before = _files(tmp_path)
    changed = [(y, c, 2 if (y, c) == (years[2], "b") else 1) for y, c, _ in data]
    commit = _publish(spark, tmp_path, "r2", changed, day=1)
    assert before <= _files(tmp_path), "no stored file is written again"
    new = _files(tmp_path) - before
    assert all("2009-10" not in f and "2010-11" not in f for f in new) and new
    assert _relative(tmp_path, commit) == [
        "t_history/r1/segment=current/at_year=2009-10", "t_history/r1/segment=current/at_year=2010-11",
        "t_history/r2/segment=closed", "t_history/r2/segment=current"]
    history = p.read_table(spark, str(tmp_path), "t_history")
    assert rows(history.filter("version_no = 2 OR is_current = 0"), "year", "code", "n", "change_type") == [
        (years[2], "b", 1, "INITIAL"), (years[2], "b", 2, "CHANGE")]
    assert history.count() == 10 and commit.rows == {"t": 9, "t_history": 10}
    # the year that was left alone is changed later, and the touched one stays
    third = _publish(spark, tmp_path, "r3", [r if r[:2] != ("2009-10", "a") else ("2009-10", "a", 7) for r in changed],
                     day=2)
    assert "t_history/r2/segment=current" in _relative(tmp_path, third)
    assert findings(p.recount(spark, str(tmp_path))) == {"t:recount": 0, "t_history:recount": 0}


def test_random_runs_equal_the_chain_over_all_runs(spark, tmp_path):
    rng = random.Random(8)
    runs, snapshots = [], []
    for day in range(5):
        data = [(y, f"c{c}", rng.choice([1, 2])) for y in ("y1", "y2", "y3") for c in range(12)
                if rng.random() < 0.7 and not (y == "y2" and day == 2) and not (y == "y3" and day < 2)]
        _publish(spark, tmp_path, f"r{day}", data, day=day)
        runs.append((f"r{day}", NOW + timedelta(days=day)))
        snapshots += [(*r, f"r{day}", f"r{day}") for r in data]
    every = spark.createDataFrame(snapshots, SCHEMA + ", run string")
    chain = hist.history_chain(every, ["year", "code"], "run", runs).drop("processed_at")
    stored = p.read_table(spark, str(tmp_path), "t_history")
    columns = ["year", "code", "n", "version_no", "is_current", "is_deleted", "change_type", "row_hash"]
    assert bag(stored, *columns) == bag(chain, *columns)
    assert stored.filter("is_current = 1 AND valid_to IS NOT NULL").isEmpty()


def test_counts_come_from_the_write_and_are_recorded(spark, tmp_path, monkeypatch):
    commit = _publish(spark, tmp_path, "r1", [("y", "a", 1), ("y", "b", None)], expected_rows={"t": 2})
    assert commit.rows == {"t": 2, "t_history": 2}
    monkeypatch.setattr(p, "read_table", None)  # the commit alone answers
    assert findings(p.ready_checks(spark, str(tmp_path), ["t"])) == {"t:not_empty": 0}


def test_files_that_miss_rows_are_not_published(spark, tmp_path, monkeypatch):
    whole = p._write

    def lossy(df, path, by, facts):
        seen = whole(df, path, by, facts)
        next(f for f in Path(path).rglob("*.parquet")).unlink()
        return seen

    monkeypatch.setattr(p, "_write", lossy)
    with pytest.raises(CheckFailed, match="t:recount"):
        _publish(spark, tmp_path, "r1", [(y, "a", 1) for y in ("y1", "y2")])
    assert p.latest_commit(spark, str(tmp_path)) is None


def test_rows_lost_after_the_commit_are_found(spark, tmp_path):
    _publish(spark, tmp_path, "r1", [(y, "a", 1) for y in ("y1", "y2")])
    next((tmp_path / "t" / "r1").rglob("*.parquet")).unlink()
    assert findings(p.recount(spark, str(tmp_path), ["t"])) == {"t:recount": 1}


def test_repeated_keys_are_found_by_the_comparison(spark, tmp_path):
    _publish(spark, tmp_path, "r1", [("y", "a", 1)])
    with pytest.raises(CheckFailed, match="t:unique_key: 2"):
        _publish(spark, tmp_path, "r2", [("y", "a", 1), ("y", "a", 2), ("y", "a", 3)], day=1)
    assert rows(p.read_table(spark, str(tmp_path), "t_history"), "code", "is_current") == [("a", 1)]
    assert not (tmp_path / "t_history" / "r2").exists()


def test_all_rows_observed_in_one_pass_with_their_rules(spark, tmp_path):
    df = spark.createDataFrame([("y", "a", "1", "r"), ("y", None, "x", "r"), (None, "b", "2", "r")],
                               "year string, code string, n string, processed_at string")
    written = p.stage(df, TABLE, str(tmp_path / "t"))
    assert written.rows == 3
    assert {k: v for k, v in written.bad.items() if v} == {"t.year:required": 1, "t.code:required": 1, "t:type": 1}
    empty = p.stage(df.limit(0), TABLE, str(tmp_path / "e"))
    assert empty.rows == 0 and not any(empty.bad.values())


def test_a_lookup_skips_most_row_groups(spark, tmp_path):
    spark.conf.set("parquet.block.size", "40000")
    try:
        data = spark.range(30_000).select(
            F.concat(F.lit("y"), F.col("id") % 2).alias("year"), F.format_string("%06d", "id").alias("code"),
            F.xxhash64("id").alias("n"), F.lit("r").alias("processed_at"))
        p.publish(spark, str(tmp_path), "r1", [(TABLE, data)], keep_history=["t"], now=NOW)
    finally:
        spark.conf.unset("parquet.block.size")
    wanted = [{"year": f"y{i % 2}", "code": f"{i:06d}"} for i in range(12_000, 12_010)]
    found = p.read_versions(spark, str(tmp_path), "t", wanted)
    assert found.count() == 10
    rows_read = []
    got = found.collect()
    for leaf in _leaves(found):
        rows_read.append(leaf.metrics().get("numOutputRows").get().value())
    assert sorted((r["year"], r["code"]) for r in got) == sorted((w["year"], w["code"]) for w in wanted)
    assert sum(rows_read) < 3_000, "the scan returns few of the 30,000 rows"
    with pytest.raises(ValueError):
        p.read_versions(spark, str(tmp_path), "t", [])


def _leaves(df):
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_an_unpartitioned_table_is_written_whole(spark, tmp_path):
    table = Contract("u", (Field("code", nullable=False), Field("n", "bigint")), keys=("code",))
    for day, (run, data) in enumerate((("r1", [("a", 1), ("b", 1)]), ("r2", [("a", 1)]), ("r3", [("a", 1), ("b", 5)]))):
        commit = p.publish(spark, str(tmp_path), run, [(table, spark.createDataFrame(data, "code string, n bigint"))],
                           keep_history=["u"], now=NOW + timedelta(days=day))
    assert rows(p.read_table(spark, str(tmp_path), "u_history"), "code", "version_no", "change_type", "is_current") == [
        ("a", 1, "INITIAL", 1), ("b", 1, "INITIAL", 0), ("b", 2, "DELETE", 0), ("b", 3, "REACTIVATED", 1)]
    assert commit.rows["u_history"] == 4
