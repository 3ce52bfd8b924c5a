"""Plans and results under conditions of scale: nothing small enough to broadcast by
itself, one key holding a third of the rows."""

import random
from collections import defaultdict
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from snapledger.operators.checks import missing_keys
from snapledger.operators.corrections import apply_corrections
from snapledger.operators.scd2 import join_valid_version
from snapledger.operators.totals import multi_level_totals
from snapledger.storage.contracts import Contract, Field
from snapledger.storage.publish import stage
from standin import catalog
from tests.helpers import bag, physical_plan

DATA = Path("/root/testdata/sf0.001")
# These run jobs while they build; their parts are covered by the other names.
EAGER = {"publish_validated", "stage_write_readback"}


@pytest.fixture()
def nothing_small(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.skipif(not DATA.is_dir(), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - EAGER))
def test_plans_stay_distributed(spark, nothing_small, name):
    plan = physical_plan(entry.queries()[name](spark, str(DATA)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "ArrowEval",
                     "InPandas", "PythonUDF", "CollectLimit"):
        assert operator not in plan
    # a global window would pull everything into one task
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        # scd2_reconciliation orders its final rows, one per period
        if "Window [" in line and name != "scd2_reconciliation":
            below = "\n".join(lines[i:i + 3])
            assert "SinglePartition" not in below


@pytest.mark.skipif(not DATA.is_dir(), reason="driver tables not present")
def test_flagship_reads_only_the_columns_it_needs(spark):
    plan = physical_plan(entry.queries()["report_management"](spark, str(DATA)))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    read = " ".join(line.split("ReadSchema: ")[1] for line in scans)
    for column in ("l_shipdate", "l_discount", "l_partkey"):
        assert column not in read


def test_versions_of_a_hot_key(spark, nothing_small):
    rng = random.Random(11)
    starts = [date(2000 + y, 4, 1) for y in range(5)]
    versions = [(k, s, date(s.year + 1, 3, 31) if i < 4 else date(9999, 12, 31), f"{k}-{i}")
                for k in range(50) for i, s in enumerate(starts)]
    asked = [(0 if rng.random() < 0.34 else rng.randrange(50),
              date(rng.randrange(1999, 2007), rng.randrange(1, 13), 1), i) for i in range(3000)]
    v = spark.createDataFrame(versions, "k int, valid_from date, valid_to date, sk string")
    a = spark.createDataFrame(asked, "k int, d date, n int")
    by_key = defaultdict(list)
    for k, start, end, sk in versions:
        by_key[k].append((start, end, sk))
    expected = sorted((n, sk) for k, d, n in asked for start, end, sk in by_key[k] if start <= d <= end)
    got = sorted(tuple(r) for r in join_valid_version(a, v, ["k"], F.col("d")).select("n", "sk").collect())
    assert got == expected


def test_totals_missing_keys_and_corrections_of_a_hot_key(spark, nothing_small):
    rng = random.Random(12)
    data = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(300)}", rng.randrange(9))
            for _ in range(4000)]
    df = spark.createDataFrame(data, "k string, n bigint")
    sums = defaultdict(int)
    for k, n in data:
        sums[k] += n
        sums["ALL"] += n
    assert {r["k"]: r["n"] for r in multi_level_totals(df, [("k",), ()], {"k": "ALL"}, ["n"]).collect()} == sums
    known = spark.createDataFrame([(k,) for k in sums if k != "hot"], "k string")
    assert [tuple(r) for r in missing_keys(df, known, ["k"]).collect()] == [("hot",)]
    fix = spark.createDataFrame([("hot", 1)], "k string, delta bigint")
    out = apply_corrections(df, fix, ["k"], "n")
    assert bag(out.drop("corrected")) == bag(df), "a correction of many rows must be refused"


def test_partitioned_tables_are_rebalanced_when_staged(spark, tmp_path):
    table = Contract("t", (Field("y", nullable=False), Field("k", "bigint", nullable=False)),
                     keys=("y", "k"), partition_by=("y",))
    df = spark.range(0, 4000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("y"),
        F.col("id").alias("k"))
    stage(df, table, str(tmp_path / "t"))
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert len(files) < 16 and spark.read.parquet(str(tmp_path / "t")).count() == 4000
