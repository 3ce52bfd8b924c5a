import random
from datetime import date

from pyspark.sql import functions as F

from snapledger.functions.periods import period_start
from snapledger.operators import scd2
from snapledger.plans import facts
from tests.helpers import bag, findings, physical_plan, rows

SNAPSHOT = ("academic_year string, udise_sch_code string, school_name string, state_cd string, "
            "district_cd string, sch_category_id int, management_center_id int, school_status int")
OPEN = date(9999, 12, 31)


def _snap(spark, data):
    return spark.createDataFrame(data, SNAPSHOT)


def _row(year, code="S", name="n", state="1", district="1", category=1, management=1, status=1):
    return (year, code, name, state, district, category, management, status)


def _rebuild(df, **kwargs):
    return scd2.scd2_rebuild(
        df, ["udise_sch_code"], period_start("academic_year"), facts.SCHOOL_ATTRIBUTES, **kwargs)


def test_equal_snapshots_collapse_even_over_a_gap(spark):
    out = _rebuild(_snap(spark, [_row("2020-21"), _row("2022-23")]))
    assert rows(out, "valid_from", "valid_to", "version_no", "is_current", "change_type") == [
        (date(2020, 4, 1), OPEN, 1, 1, "INITIAL")]


def test_back_and_forth_makes_three_versions(spark):
    data = [_row("2020-21", name="A"), _row("2021-22", name="B"), _row("2022-23", name="A")]
    versions = facts.dim_school(_snap(spark, data))
    assert rows(versions, "version_no", "valid_from", "valid_to", "is_current", "change_type") == [
        (1, date(2020, 4, 1), date(2021, 3, 31), 0, "INITIAL"),
        (2, date(2021, 4, 1), date(2022, 3, 31), 0, "ATTRIBUTE_CHANGE"),
        (3, date(2022, 4, 1), OPEN, 1, "ATTRIBUTE_CHANGE")]
    audit = facts.school_change_audit(versions)
    assert rows(audit, "version_no", "previous_school_name", "current_school_name",
                "changed_columns") == [(2, "A", "B", "school_name"), (3, "B", "A", "school_name")]


def test_null_to_value_is_a_change_and_names_are_listed_in_order(spark):
    data = [_row("2020-21", category=None), _row("2021-22", category=3),
            _row("2022-23", category=3, state="2", district="9", management=2, status=None, name="x")]
    audit = facts.school_change_audit(facts.dim_school(_snap(spark, data)))
    assert rows(audit, "version_no", "changed_columns") == [
        (2, "category"), (3, "school_name, state, district, management, school_status")]


def test_ambiguous_hash_merges_by_default_and_not_with_a_better_hash(spark):
    from snapledger.functions.hashing import length_prefixed_md5
    data = [_row("2020-21", name="a|b", state="c"), _row("2021-22", name="a", state="b|c")]
    assert _rebuild(_snap(spark, data)).count() == 1
    exact = _rebuild(_snap(spark, data), row_hash=length_prefixed_md5(facts.SCHOOL_ATTRIBUTES))
    assert exact.count() == 2


def test_rebuild_shuffles_once(spark):
    df = _snap(spark, [_row("2020-21")])
    assert physical_plan(_rebuild(df)).count("Exchange hashpartitioning") == 1
    audit = facts.school_change_audit(facts.dim_school(df))
    assert physical_plan(audit).count("Exchange hashpartitioning") == 1


def _expected(data):
    """Versions by plain Python: (code, from, to, version, name, status)."""
    out, by_code = [], {}
    for row in sorted(data):
        by_code.setdefault(row[1], []).append(row)
    for code, seen in by_code.items():
        versions = []
        for row in seen:
            start = date(int(row[0][:4]), 4, 1)
            if not versions or versions[-1][1] != row[2:]:
                versions.append((start, row[2:]))
        for i, (start, attrs) in enumerate(versions):
            end = OPEN if i + 1 == len(versions) else date(versions[i + 1][0].year, 3, 31)
            out.append((code, start, end, i + 1, attrs[0], attrs[5]))
    return out


def _random_data(seed):
    rng = random.Random(seed)
    years = [f"{y}-{(y + 1) % 100:02d}" for y in range(1996, 2004)]
    return [
        _row(y, code=f"S{c}", name=rng.choice(["a", "b", None]), status=rng.choice([1, 2, None]))
        for c in range(60) for y in years if rng.random() < 0.7
    ]


def test_rebuild_equals_brute_force(spark):
    from collections import Counter
    for seed in (1, 2):
        data = _random_data(seed)
        out = _rebuild(_snap(spark, data))
        assert bag(out, "udise_sch_code", "valid_from", "valid_to", "version_no", "school_name",
                   "school_status") == Counter(_expected(data))
        assert set(findings(scd2.scd2_invariants(out, ["udise_sch_code"])).values()) == {0}


def test_invariants_find_broken_versions(spark):
    broken = spark.createDataFrame([
        ("A", date(2020, 4, 1), date(2021, 3, 31), 1), ("A", date(2022, 4, 1), OPEN, 1),
        ("B", date(2020, 4, 1), date(2019, 1, 1), 1)],
        "k string, valid_from date, valid_to date, is_current int")
    assert findings(scd2.scd2_invariants(broken, ["k"], "v")) == {
        "v:one_current": 1, "v:contiguous": 1, "v:ordered_dates": 1}


def test_as_of_join_includes_both_ends_and_keeps_row_count(spark):
    versions = spark.createDataFrame([
        ("A", date(2020, 4, 1), date(2021, 3, 31), "v1"), ("A", date(2021, 4, 1), OPEN, "v2")],
        "k string, valid_from date, valid_to date, sk string")
    asked = spark.createDataFrame([
        ("A", date(2020, 4, 1)), ("A", date(2021, 3, 31)), ("A", date(2021, 4, 1)),
        ("A", date(2020, 3, 31)), ("B", date(2021, 4, 1))], "k string, d date")
    inner = scd2.join_valid_version(asked, versions, ["k"], F.col("d"))
    assert rows(inner, "d", "sk") == [
        (date(2020, 4, 1), "v1"), (date(2021, 3, 31), "v1"), (date(2021, 4, 1), "v2")]
    assert scd2.join_valid_version(asked, versions, ["k"], F.col("d"), how="left").count() == 5


def test_reconciliation_counts(spark):
    data = [_row("2020-21", "A"), _row("2021-22", "A", name="x"), _row("2021-22", "B")]
    snaps = _snap(spark, data)
    out = scd2.scd2_reconciliation(snaps, _rebuild(snaps), period_start("academic_year"), "school")
    assert rows(out) == [
        ("school", date(2020, 4, 1), 1, 1, 0, 0, 1, 1),
        ("school", date(2021, 4, 1), 2, 1, 1, 1, 3, 2)]
