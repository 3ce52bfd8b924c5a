import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from snapledger.operators import checks, corrections
from snapledger.storage import workdir
from tests.helpers import bag, findings, physical_plan, rows


def _skewed(spark, seed=7, n=2000):
    """A third of all rows share one key."""
    rng = random.Random(seed)
    data = [(1 if rng.random() < 0.34 else rng.randrange(2, 400), rng.choice([1, 2, None]),
             rng.choice(["a", None])) for _ in range(n)]
    return data, spark.createDataFrame(data, "k int, v int, w string")


def test_duplicates_and_conflicts_equal_brute_force(spark):
    data, df = _skewed(spark)
    by_key = defaultdict(list)
    for k, v, w in data:
        by_key[k].append((v, w))
    assert bag(checks.duplicate_keys(df, ["k"])) == Counter(
        (k, len(vs)) for k, vs in by_key.items() if len(vs) > 1)
    assert bag(checks.conflicting_duplicates(df, ["k"], ["v", "w"])) == Counter(
        (k, len(vs)) for k, vs in by_key.items() if len(set(vs)) > 1)
    conflicts = sum(len(set(vs)) > 1 for vs in by_key.values())
    assert findings(checks.conflict_check("c", df, ["k"], ["v", "w"])) == {"c": conflicts}
    assert checks.collapse_duplicates(df, ["k"]).count() == len(by_key)


def test_aggregates_combine_before_the_shuffle(spark):
    _, df = _skewed(spark)
    for frame in (checks.duplicate_keys(df, ["k"]), checks.conflicting_duplicates(df, ["k"], ["v"]),
                  checks.collapse_duplicates(df, ["k"])):
        plan = physical_plan(frame)
        assert plan.index("Exchange") < plan.index("partial_")


def test_fused_rules_and_null_conditions(spark):
    _, df = _skewed(spark)
    got = findings(checks.count_bad(df, {"null": F.col("v").isNull(), "two": F.col("v") == 2}))
    assert got["null"] + got["two"] + df.filter("v = 1").count() == 2000


def test_enforce_lists_every_failure(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 0), ("c", 1, 1)], "check string, n_checked int, n_bad int")
    with pytest.raises(checks.CheckFailed) as error:
        checks.enforce(df)
    assert error.value.failures == [("a", 2), ("c", 1)]
    checks.enforce(df.filter("n_bad = 0"))


def test_missing_keys_and_labels(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(checks.missing_keys(a, b, ["k"])) == [(1,)]
    assert findings(checks.missing_key_check("m", a, b, ["k"])) == {"m": 1}
    named = spark.createDataFrame([(1, " "), (1, None), (2, "x"), (2, "")], "c int, l string")
    assert rows(checks.codes_without_label(named, "c", "l")) == [(1, 2)]
    assert findings(checks.not_empty_check("e", a.limit(0))) == {"e": 1}


COUNTS = "udise_sch_code string, male_tch string, female_tch int"


def test_correction_keeps_the_type_and_is_reversible(spark):
    df = spark.createDataFrame([("02010100501", "6", 4), ("02010100502", "7", 5)], COUNTS)
    fix = spark.createDataFrame([("02010100501", 10)], "udise_sch_code string, delta bigint")
    out = corrections.apply_corrections(df, fix, ["udise_sch_code"], "male_tch")
    assert rows(out) == [("02010100501", "16", 4, 1), ("02010100502", "7", 5, 0)]
    assert bag(corrections.apply_corrections(df, fix.limit(0), ["udise_sch_code"], "male_tch")
               .drop("corrected")) == bag(df)


def test_corrections_that_do_not_hit_one_row_are_refused(spark):
    df = spark.createDataFrame([("A", "1", 1), ("A", "2", 1), ("B", "3", 1), ("C", "4", 1)], COUNTS)
    fix = spark.createDataFrame([("A", 1), ("B", 1), ("B", 2), ("C", 5), ("X", 1)],
                                "udise_sch_code string, delta bigint")
    status = corrections.correction_status(df, fix, ["udise_sch_code"], "male_tch")
    assert rows(status, "udise_sch_code", "n_corrections", "n_rows", "status", "reason") == [
        ("A", 1, 2, "REFUSED", "several rows"), ("B", 2, 1, "REFUSED", "several corrections"),
        ("C", 1, 1, "APPLIED", ""), ("X", 1, 0, "REFUSED", "no row")]
    with pytest.raises(checks.CheckFailed):
        checks.enforce(corrections.correction_check(df, fix, ["udise_sch_code"], "male_tch"))
    out = corrections.apply_corrections(df, fix, ["udise_sch_code"], "male_tch")
    assert rows(out, "udise_sch_code", "male_tch") == [("A", "1"), ("A", "2"), ("B", "3"), ("C", "9")]


def test_corrections_need_a_number_a_change_and_no_negative_result(spark):
    df = spark.createDataFrame([("A", None, 1), ("B", "3", 1), ("C", "4", 1), ("D", "x", 1), ("E", "2", 1)], COUNTS)
    fix = spark.createDataFrame([("A", 1), ("B", -9), ("C", 0), ("D", 1), ("E", None)],
                                "udise_sch_code string, delta bigint")
    status = corrections.correction_status(df, fix, ["udise_sch_code"], "male_tch")
    assert rows(status, "udise_sch_code", "reason") == [
        ("A", "no number to correct"), ("B", "negative result"), ("C", "no change"),
        ("D", "no number to correct"), ("E", "no change")]
    out = corrections.apply_corrections(df, fix, ["udise_sch_code"], "male_tch")
    assert bag(out.drop("corrected")) == bag(df) and out.filter("corrected = 1").isEmpty()


def test_quarantine_splits_without_losing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, ""), (3, None), (4, "b")], "n int, t string")
    rules = {"no n": F.col("n").isNull(), "no t": F.coalesce(F.col("t"), F.lit("")) == ""}
    rejects = corrections.quarantine(df, rules, "b1", "e", F.lit("2020-21"))
    assert rows(rejects, "reason", "source_record") == [
        ("no n; no t", '{"n":null,"t":""}'), ("no t", '{"n":3,"t":null}')]
    assert rows(corrections.accepted_rows(df, rules)) == [(1, "a"), (4, "b")]
    assert rows(corrections.batch_counts(df, rules, F.lit("2020-21"))) == [("2020-21", 4, 2, 2)]


class _Session:
    """Just the settings the work folder looks at."""

    def __init__(self, master, setting=None, current=None):
        self.conf = {"spark.checkpoint.dir": setting}
        self.master, self.current = master, current
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_work_folder_follows_the_session():
    assert workdir.shared_dir(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert workdir.shared_dir(_Session("yarn", None, "hdfs:///c/1")) == "hdfs:///c/1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workdir.shared_dir(_Session("yarn"))
    local = _Session("local[2]")
    assert workdir.shared_dir(local) == local.current


def test_write_once_continues_from_the_written_table(spark):
    df = workdir.write_once(spark.range(3).toDF("x"), "numbers")
    assert rows(df) == [(0,), (1,), (2,)] and workdir.shared_dir(spark) in df.inputFiles()[0]
