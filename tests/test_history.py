import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapledger.operators import history as h
from snapledger.operators.checks import CheckFailed, enforce
from tests.helpers import bag, findings, physical_plan, rows

SCHEMA = "academic_year string, code string, total bigint, grp string, processed_at string"
KEYS = ["academic_year", "code"]
CLOCK = datetime(2025, 1, 1)


def _snap(spark, *data):
    return spark.createDataFrame(
        [("2025-26", code, total, grp, at) for code, total, grp, at in data], SCHEMA)


def test_state_machine(spark):
    """no-op, change, mapped change, restore, delete, return: versions 1 to 6."""
    steps = [
        (_snap(spark, ("1", 10, "Government", "t0")), "INITIAL"),
        (_snap(spark, ("1", 10, "Government", "t1")), None),
        (_snap(spark, ("1", 20, "Government", "t2")), "CHANGE"),
        (_snap(spark, ("1", 20, "Government Aided", "t3")), "CHANGE"),
        (_snap(spark, ("1", 10, "Government Aided", "t4")), "CHANGE"),
        (_snap(spark, ("12", 1, "Government", "t5")), "DELETE"),
        (_snap(spark, ("1", 10, "Government Aided", "t6"), ("12", 1, "Government", "t6")),
         "REACTIVATED"),
    ]
    stored, version = None, 0
    for day, (snapshot, kind) in enumerate(steps):
        stored, changed = h.run_history(stored, snapshot, KEYS, CLOCK + timedelta(days=day))
        assert changed == (kind is not None)
        version += changed
        last = stored.filter("code = '1' AND is_current = 1").first()
        assert last["version_no"] == version
        if kind:
            assert last["change_type"] == kind and last["is_deleted"] == (kind == "DELETE")
    mine = stored.filter("code = '1'").orderBy("version_no").collect()
    assert [r["total"] for r in mine] == [10, 20, 20, 10, 10, 10]
    assert [r["is_current"] for r in mine] == [0, 0, 0, 0, 0, 1]
    for before, after in zip(mine, mine[1:]):
        assert before["valid_to"] == after["valid_from"]
    assert mine[-1]["valid_to"] is None
    # the ignored column keeps the value of the version that was recorded
    assert [r["processed_at"] for r in mine] == ["t0", "t2", "t3", "t4", "t4", "t6"]


def test_tombstone_that_stays_missing_adds_nothing(spark):
    one, other = _snap(spark, ("1", 1, "g", "t")), _snap(spark, ("2", 1, "g", "t"))
    stored, _ = h.run_history(None, one, KEYS, CLOCK)
    stored, _ = h.run_history(stored, other, KEYS, CLOCK + timedelta(1))
    again, changed = h.run_history(stored, other, KEYS, CLOCK + timedelta(2))
    assert not changed and bag(again) == bag(stored)


def test_clock_never_goes_back(spark):
    stored, _ = h.run_history(None, _snap(spark, ("1", 1, "g", "t")), KEYS, CLOCK)
    stored, _ = h.run_history(
        stored, _snap(spark, ("1", 2, "g", "t")), KEYS, CLOCK - timedelta(days=9))
    assert [r["valid_from"] for r in stored.orderBy("version_no").collect()] == [
        CLOCK, CLOCK + timedelta(microseconds=1)]


def test_bad_inputs_are_refused(spark):
    good = _snap(spark, ("1", 1, "g", "t"))
    stored, _ = h.run_history(None, good, KEYS, CLOCK)
    with pytest.raises(CheckFailed, match="snapshot_unique_key"):
        h.run_history(stored, good.union(good), KEYS, CLOCK)
    with pytest.raises(CheckFailed, match="keys_not_null"):
        h.run_history(stored, _snap(spark, (None, 1, "g", "t")), KEYS, CLOCK)
    with pytest.raises(CheckFailed, match="one_current_row"):
        h.run_history(stored.union(stored), good, KEYS, CLOCK)


def test_schema_guard(spark):
    good = _snap(spark, ("1", 1, "g", "t"))
    stored, _ = h.run_history(None, good, KEYS, CLOCK)
    for frame, keys in (
        (good.withColumn("row_hash", F.lit("x")), KEYS), (good, ["nope"]), (good, []),
        (good.withColumn("extra", F.lit(1)), KEYS), (good.withColumn("total", F.lit("1")), KEYS),
    ):
        with pytest.raises(h.HistoryRefused):
            h.guard_schema(frame, keys, stored)


def test_baseline_records_the_state_before_the_first_step(spark):
    before, after = _snap(spark, ("1", 1, "g", "t")), _snap(spark, ("1", 2, "g", "t"))
    stored = h.history_baseline(None, before, KEYS, F.lit(CLOCK))
    stored = h.history_step(stored, after, KEYS, F.lit(CLOCK + timedelta(1)))
    assert rows(stored, "version_no", "total", "change_type") == [(1, 1, "INITIAL"), (2, 2, "CHANGE")]
    assert h.history_baseline(stored, after, KEYS, F.lit(CLOCK)) is stored


def test_step_checks_catch_a_short_delta(spark):
    snap = _snap(spark, ("1", 1, "g", "t"), ("2", 1, "g", "t"))
    delta = h.history_delta(h.empty_history(snap, KEYS), snap, KEYS, F.lit(CLOCK))
    enforce(h.step_checks(delta, snap, KEYS))
    assert findings(h.step_checks(delta.filter("code = '1'"), snap, KEYS))[
        "history:live_rows_equal_snapshot"] == 1
    assert findings(h.step_checks(delta.union(delta), snap, KEYS))["history:one_current_row"] == 2


def test_delta_joins_once(spark):
    snap = _snap(spark, ("1", 1, "g", "t"))
    stored, _ = h.run_history(None, snap, KEYS, CLOCK)
    stored = spark.createDataFrame(stored.collect(), stored.schema)
    delta = h.history_delta(stored, snap, KEYS, F.lit(CLOCK))
    assert physical_plan(delta).count("FullOuter") == 1


CHAIN = "run string, code string, total bigint, grp string, processed_at string"


def _random_runs(spark, seed):
    rng = random.Random(seed)
    runs = [(f"r{i}", CLOCK + timedelta(days=i)) for i in range(6)]
    data = [
        (r, f"c{c}", rng.choice([1, 2]), rng.choice(["g", None]), f"{r}")
        for r, _ in runs for c in range(25) if rng.random() < 0.6
    ]
    return runs, spark.createDataFrame(data, CHAIN)


@pytest.mark.parametrize("seed", [3, 4])
def test_chain_equals_stepping_run_by_run(spark, seed, tmp_path):
    runs, data = _random_runs(spark, seed)
    chain = h.history_chain(data, ["code"], "run", runs)
    stored = h.empty_history(data.drop("run"), ["code"])
    for i, (label, stamp) in enumerate(runs):
        snapshot = data.filter(F.col("run") == label).drop("run")
        path = str(tmp_path / str(i))
        h.history_step(stored, snapshot, ["code"], F.lit(stamp)).write.parquet(path)
        stored = spark.read.parquet(path)
    assert chain.columns == stored.columns
    assert bag(chain) == bag(stored)
    live = {r["code"] for r in stored.filter("is_current = 1 AND is_deleted = 0").collect()}
    assert live == {r["code"] for r in data.filter("run = 'r5'").collect()}


def test_chain_refuses_unlisted_periods(spark):
    runs, data = _random_runs(spark, 5)
    with pytest.raises(Exception, match="period outside the runs"):
        h.history_chain(data, ["code"], "run", runs[:-1]).collect()


def test_lookup_lists_versions_in_order(spark):
    runs, data = _random_runs(spark, 6)
    chain = h.history_chain(data, ["code"], "run", runs)
    wanted = spark.createDataFrame([("c1",), ("c1",)], "code string")
    got = [r["version_no"] for r in h.history_lookup(chain, wanted, ["code"]).collect()]
    assert got == list(range(1, len(got) + 1)) and got


def test_repeated_and_incomplete_keys_are_refused(spark):
    twice = _snap(spark, ("1", 1, "g", "t"), ("1", 2, "g", "t"))
    empty = h.empty_history(twice, KEYS)
    with pytest.raises(CheckFailed):
        h.history_step(empty, twice, KEYS, F.lit(CLOCK))
    with pytest.raises(CheckFailed):
        h.history_step(empty, _snap(spark, (None, 1, "g", "t")), KEYS, F.lit(CLOCK))
    runs = [("r1", CLOCK), ("r2", CLOCK + timedelta(1))]
    chained = twice.withColumn("run", F.lit("r1"))
    with pytest.raises(Exception, match="occurs twice"):
        h.history_chain(chained, KEYS, "run", runs).collect()


def test_rows_after_a_step_are_the_old_and_the_opened_ones(spark):
    stored, _ = h.run_history(None, _snap(spark, ("1", 1, "g", "t"), ("2", 1, "g", "t")), KEYS, CLOCK)
    snapshot = _snap(spark, ("1", 5, "g", "t"), ("3", 1, "g", "t"))
    delta = h.history_delta(stored, snapshot, KEYS, F.lit(CLOCK + timedelta(1)))
    name = "history:rows_equal_old_and_opened"
    assert findings(h.step_checks(delta, snapshot, KEYS, stored))[name] == 0
    assert findings(h.step_checks(delta.filter("is_current = 1"), snapshot, KEYS, stored))[name] == 2
