"""Guards of the history step that are part of its plan."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapledger.operators import history as h
from standin import catalog
from tests.helpers import physical_plan, rows

SCHEMA = "code string, total bigint"
CLOCK = datetime(2025, 1, 1)


def _snap(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("data, message", [
    ([("1", 1), ("1", 2)], "snapshot: a key occurs twice: 1"), ([(None, 1)], "snapshot: incomplete key")])
def test_a_bad_snapshot_fails_the_query(spark, data, message):
    good = _snap(spark, ("1", 1), ("2", 2))
    stored = h.history_step(h.empty_history(good, ["code"]), good, ["code"], F.lit(CLOCK), checked=True)
    for history in (h.empty_history(good, ["code"]), stored):
        lazy = h.history_step(history, _snap(spark, *data), ["code"], F.lit(CLOCK), checked=True)
        with pytest.raises(Exception, match=message):
            lazy.collect()


def test_repeated_stored_rows_fail_the_query(spark):
    good = _snap(spark, ("1", 1))
    once = h.history_step(h.empty_history(good, ["code"]), good, ["code"], F.lit(CLOCK), checked=True)
    with pytest.raises(Exception, match="stored history: a key occurs twice: 1"):
        h.history_step(once.union(once), good, ["code"], F.lit(CLOCK), checked=True).collect()


def test_guards_add_no_shuffle(spark, tmp_path):
    good = spark.range(1000).select(F.col("id").cast("string").alias("code"), "id").withColumnRenamed("id", "total")
    h.history_step(h.empty_history(good, ["code"]), good, ["code"], F.lit(CLOCK), checked=True).write.parquet(
        str(tmp_path / "h"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.read.parquet(str(tmp_path / "h"))
        plan = physical_plan(h.history_delta(stored.filter("is_current = 1"), good, ["code"], F.lit(CLOCK)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


@pytest.mark.parametrize("name", ["history_step", "history_baseline", "report_management", "dim_state", "dim_district"])
def test_queries_run_few_jobs_while_they_are_built(spark, name):
    context = spark.sparkContext
    context.setJobGroup(f"build {name}", name)
    try:
        catalog.queries()[name](spark, "/root/testdata/sf0.001")
        jobs = context.statusTracker().getJobIdsForGroup(f"build {name}")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # history_step lists the periods it steps through
    assert len(jobs) <= (2 if name == "history_step" else 0)


def test_events_of_all_kinds(spark):
    first = _snap(spark, ("a", 1), ("b", 1), ("c", 1), ("d", 1))
    stored = h.history_step(h.empty_history(first, ["code"]), first, ["code"], F.lit(CLOCK), checked=True)
    second = _snap(spark, ("a", 1), ("b", 2), ("e", 1), ("d", 1))
    events, facts = h.change_set(stored, second.withColumn("_row_hash", h.row_hash(second.columns, ["code"])), ["code"])
    assert rows(events, "code", "_event") == [
        ("a", "UNCHANGED"), ("b", "CHANGE"), ("c", "DELETE"), ("d", "UNCHANGED"), ("e", "INITIAL")]
    found = h.changed(events.agg(*[a.alias(n) for n, a in facts.items()]).first().asDict())
    assert found.any and found.live == 4 and found.unchanged == 2 and found.repeated_snapshot == 0
    assert found.opened == {"INITIAL": 1, "CHANGE": 1, "REACTIVATED": 0, "DELETE": 1}
