import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from snapledger.operators import checks
from snapledger.operators.checkplan import CheckPlan
from tests.helpers import findings, physical_plan

SCHEMA = "k int, v bigint, w string, whole boolean"


def _frames(spark, seed=21):
    rng = random.Random(seed)

    def rows(n):
        return [(rng.choice([1, 1, 1, None, *range(2, 60)]), rng.choice([1, 2, None]),
                 rng.choice(["a", "b;1:a", None]), rng.random() < 0.2) for _ in range(n)]

    return rows(900), rows(400)


def test_every_kind_equals_its_single_check(spark):
    left, right = _frames(spark)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    plan = (
        CheckPlan().rules(a, {"null": F.col("v").isNull(), "unknown": F.col("v") > 1}).not_empty("full", a)
        .not_empty("empty", b.limit(0)).unique("unique", a, ["k"]).unique("unique_pair", a, ["k", "w"])
        .conflict("conflict", a, ["k"], ["v", "w"]).known("known", a, b, ["k"]).known("pairs", a, b, ["k", "w"])
        .rules(b, {"b_null": F.col("w").isNull()}).rows_equal("balance", a, b).count("rows", a)
        .tally(b, {"ones": F.col("v") == 1}))
    got = findings(plan.frame())
    single = checks.union_checks(
        checks.count_bad(a, {"null": F.col("v").isNull(), "unknown": F.col("v") > 1}),
        checks.count_bad(b, {"b_null": F.col("w").isNull()}),
        checks.not_empty_check("full", a), checks.not_empty_check("empty", b.limit(0)),
        checks.duplicate_key_check("unique", a, ["k"]), checks.duplicate_key_check("unique_pair", a, ["k", "w"]),
        checks.conflict_check("conflict", a, ["k"], ["v", "w"]),
        checks.missing_key_check("known", a, b, ["k"]), checks.missing_key_check("pairs", a, b, ["k", "w"]))
    expected = {(r["check"], r["n_checked"], r["n_bad"]) for r in single.collect()}
    assert expected <= {(r["check"], r["n_checked"], r["n_bad"]) for r in plan.frame().collect()}
    assert got["balance"] == 500 and plan.findings()["rows"] == (900, 0)
    assert plan.findings()["ones"] == (sum(r[1] == 1 for r in right), 0)


def _totals(rows, keep=lambda r: True):
    out = defaultdict(int)
    for k, v, _, whole in rows:
        if k is not None and keep((k, v, whole)):
            out[k] += v or 0
    return out


def test_totals_against_brute_force(spark):
    left, right = ([(k, v or 3, w, z) for k, v, w, z in rows if k is not None] for rows in _frames(spark))
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    plan = (
        CheckPlan().equal("either", a, b, ["k"], "v").equal("left", a, b, ["k"], "v", every="left")
        .equal("some", a, b, ["k"], "v", right_where=F.col("whole"))
        .whole("whole", a, ["k"], F.col("whole"), "v"))
    x, y, z = _totals(left), _totals(right), _totals(right, lambda r: r[2])
    whole, parts = _totals(left, lambda r: r[2]), _totals(left, lambda r: not r[2])
    assert findings(plan.frame()) == {
        "either": sum(x.get(k) != y.get(k) for k in x | y), "left": sum(x[k] != y.get(k) for k in x),
        "some": sum(x.get(k) != z.get(k) for k in x | z),
        "whole": sum(k not in whole or whole[k] != parts.get(k, 0) for k in whole | parts)}


def test_mapped_counts_rows(spark):
    rows = [(1, 1, "a", True)] * 5 + [(2, 1, "a", True)] * 3 + [(None, 1, "a", True)] * 2 + [(4, 1, "a", True)]
    df = spark.createDataFrame(rows, SCHEMA)
    dim = spark.createDataFrame([(1, 1, " ", True), (2, 1, "x", True), (None, 1, "x", True)], SCHEMA)
    plan = CheckPlan().mapped(df, dim, "k", "missing", "blank", F.trim("w") == "")
    assert plan.findings() == {"missing": (11, 3), "blank": (11, 5)}
    known = CheckPlan().mapped(df, dim, "k", "missing", "blank", F.trim("w") == "", F.col("k").isNotNull())
    assert known.findings()["missing"] == (11, 1)


def test_each_frame_is_scanned_once(spark, tmp_path):
    left, right = _frames(spark)
    for name, rows in (("a", left), ("b", right)):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / name))
    a, b, again = (spark.read.parquet(str(tmp_path / n)) for n in "aba")
    plan = CheckPlan().rules(a, {"null": F.col("v").isNull()}).unique("u", again, ["k"]).known("m", a, b, ["k"])
    other = CheckPlan().equal("t", b, again, ["k"], "v").conflict("c", b, ["k"], ["w"])
    text = physical_plan(plan.add(other).frame())
    assert text.count("FileScan parquet") == 2 and "Join" not in text
    apart = {**findings(CheckPlan().add(plan).frame())}
    assert set(apart) == {"null", "u", "m", "t", "c"}


def test_joined_plans_keep_their_findings(spark):
    left, right = _frames(spark)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    one = CheckPlan().rules(a, {"x": F.col("v").isNull()}).known("m", a, b, ["k"])
    two = CheckPlan().rules(b, {"y": F.col("w") == "a"}).rules(a, {"z": F.col("v") == 2}).mapped(
        a, b, "k", "missing", "flawed", F.lit(False))
    single = one.findings() | two.findings()
    extra = checks.count_bad(a, {"extra": F.col("k") == 1})
    both = one.add(two).add(extra).findings()
    assert both == single | {"extra": (900, sum(r[0] == 1 for r in left))}


def test_enforce_raises_with_all_failures_and_returns_counts(spark):
    df = spark.createDataFrame([(1, 1, "a", True), (1, None, "b", True)], SCHEMA)
    with pytest.raises(checks.CheckFailed) as error:
        CheckPlan().unique("u", df, ["k"]).rules(df, {"n": F.col("v").isNull()}).enforce()
    assert error.value.failures == [("n", 1), ("u", 1)]
    assert CheckPlan().count("rows", df).enforce() == {"rows": (2, 0)}
    assert CheckPlan().findings() == {}
    assert Counter(CheckPlan().not_empty("e", df.limit(0)).findings()) == Counter({"e": (0, 1)})
