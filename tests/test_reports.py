from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapledger.functions.labels import GRADE_BANDS, MANAGEMENT_GROUPS
from snapledger.operators import reconcile, totals
from snapledger.operators.checks import CheckFailed, enforce
from snapledger.plans import dims, facts, reports
from tests.helpers import bag, findings, physical_plan, rows

# Golden values: teachers per school category of one state and year.
TEACHERS = {1: 136154, 2: 193891, 4: 272, 6: 154013, 7: 29421, 8: 4060, 3: 188668, 5: 14851,
            10: 1651, 11: 27255, 12: 36}


def _teacher_sources(spark, teachers, schools, groups=MANAGEMENT_GROUPS):
    return (
        spark.createDataFrame(
            teachers, "academic_year string, udise_sch_code string, male_tch bigint, "
                      "female_tch bigint, transgen_tch bigint"),
        spark.createDataFrame(
            schools, "academic_year string, udise_sch_code string, state_cd string, "
                     "management_center_id int, sch_category_id int"),
        spark.createDataFrame(
            [("2025-26", "27", "Maharashtra"), ("2024-25", "27", "Maharashtra")],
            "academic_year string, state_cd string, state_name string"),
        spark.createDataFrame([("2025-26", c) for c in TEACHERS],
                              "academic_year string, sch_category_id int"),
        spark.createDataFrame(
            [(i, g) for i, g in enumerate(MANAGEMENT_GROUPS, 1) if g in groups],
            "management_sk int, management_group string"),
    )


def _golden(spark):
    ids = list(TEACHERS)
    teachers = [("2025-26", str(c), n - 1, 0, 1) for c, n in TEACHERS.items()]
    schools = [("2025-26", str(c), "27", 1 if c == 12 else i % 4 + 1, c) for i, c in enumerate(ids)]
    return _teacher_sources(spark, teachers, schools)


def test_teacher_golden(spark):
    sources = _golden(spark)
    enforce(facts.source_preflight(*sources))
    fact = facts.fact_teacher(*sources)
    enforce(facts.fact_teacher_checks(sources[0], fact))
    by_management = reports.teacher_report_management(fact)
    row = by_management.filter(
        "india_state_ut = 'Maharashtra' AND management = 'All Management'").first().asDict()
    assert row["total"] == 750272
    assert [row[b] for b in GRADE_BANDS] == [136190] + [
        TEACHERS[c] for c in (2, 4, 6, 7, 8, 3, 5, 10, 11)]
    assert (row["foundational_preparatory"], row["middle"], row["secondary"]) == (
        136190, 194163, 419919)
    by_category = reports.teacher_report_category(fact)
    own = by_category.filter("india_state_ut = 'Maharashtra'").collect()
    assert len(own) == 3 and sum(r["total"] for r in own) == 750272
    assert all(r["total"] == sum(r[c] for c in reports.GROUP_COLUMNS) for r in own)
    enforce(reports.teacher_report_checks(fact, by_management, by_category))


def test_teacher_joins_its_own_period_only(spark):
    sources = _teacher_sources(
        spark, [("2025-26", "1", 9, 0, 1)],
        [("2025-26", "1", "27", 1, 1), ("2024-25", "1", "27", 2, 4)])
    assert rows(facts.fact_teacher(*sources), "management_group", "sch_category_id") == [
        ("Government", 1)]


def test_preflight_names_every_gap(spark):
    teachers = [("2025-26", "1", 1, 0, 0), ("2025-26", "2", None, -1, 0), ("2025-26", "9", 1, 1, 1),
                ("2025-26", "3", 1, 1, 1), ("2025-26", "3", 1, 1, 1)]
    schools = [("2025-26", "1", "27", 1, 1), ("2025-26", "2", "99", 2, 9),
               ("2025-26", "3", "27", 2, None)]
    sources = _teacher_sources(spark, teachers, schools, groups=MANAGEMENT_GROUPS[1:])
    got = findings(facts.source_preflight(*sources))
    assert {k: v for k, v in got.items() if v} == {
        "preflight:school_missing": 1, "preflight:state_label": 1, "preflight:category": 3,
        "preflight:management": 1, "preflight:counts_null": 1, "preflight:counts_negative": 1,
        "preflight:teachers_unique_key": 1}


FACT = ("academic_year string, state_sk string, management_sk int, category_sk int, "
        "total_enrollment bigint, foundational bigint, preparatory bigint, middle bigint, "
        "secondary bigint")


def _star(spark):
    data = [
        ("y1", "s1", 1, 1, 10, 4, 3, 2, 1), ("y1", "s1", 2, None, 5, 5, 0, 0, 0),
        ("y1", "s2", 1, 12, 7, 0, 0, 7, 0), ("y2", "s1", 4, 3, 1, 0, 0, 0, 1),
    ] * 3
    fact = spark.createDataFrame(data, FACT)
    states = spark.createDataFrame([("s1", "One"), ("s2", "Two")], "state_sk string, state_name string")
    management = spark.createDataFrame(
        [(1, "Government"), (2, "Government Aided"), (4, "Others")],
        "management_sk int, management_group string")
    categories = spark.createDataFrame(
        [(1, "Foundational + Preparatory School"), (3, "Secondary School"), (12, "Pre-Primary School")],
        "category_sk int, category string")
    return fact, states, management, categories


def _management_by_branches(fact, states, management):
    """The same report as four separate aggregations."""
    out = Counter()
    names = {r[0]: r[1] for r in states.collect()}
    groups = {r[0]: r[1] for r in management.collect()}
    sums = {}
    for r in fact.collect():
        for geo in ([names[r.state_sk]] if r.state_sk in names else []) + ["Available Source Total"]:
            for m in ([groups[r.management_sk]] if r.management_sk in groups else []) + ["All Management"]:
                key = (r.academic_year, geo, m)
                sums[key] = [a + b for a, b in zip(
                    sums.get(key, [0] * 5),
                    [r.total_enrollment, r.foundational, r.preparatory, r.middle, r.secondary])]
    out.update((*k, *v) for k, v in sums.items())
    return out


def test_management_report_equals_separate_branches(spark):
    fact, states, management, _ = _star(spark)
    extra = spark.createDataFrame(
        [("y1", "unknown", 1, 1, 2, 2, 0, 0, 0), ("y1", "s1", 99, 1, 3, 3, 0, 0, 0)], FACT)
    for frame in (fact, fact.union(extra)):
        report = reports.report_management(reports.enrollment_cube(frame), states, management)
        assert bag(report) == _management_by_branches(frame, states, management)


def test_category_report_shows_unknown_and_reconciles(spark):
    fact, states, management, categories = _star(spark)
    cube = reports.enrollment_cube(fact)
    by_management = reports.report_management(cube, states, management)
    by_category = reports.report_category(cube, states, management, categories)
    assert rows(by_category.filter("ac_year = 'y1' AND india_state_ut = 'Available Source Total'"),
                "category", "total", "government", "government_aided", "others") == [
        ("Foundational + Preparatory School", 30, 30, 0, 0), ("Pre-Primary School", 21, 21, 0, 0),
        ("Unknown", 15, 0, 15, 0)]
    enforce(reports.student_report_checks(by_management, by_category))
    with pytest.raises(CheckFailed, match="equals_management_report"):
        enforce(reports.student_report_checks(
            by_management, by_category.filter("category <> 'Unknown'")))


def test_mapping_audit_counts_rows_by_reason(spark):
    fact, states, management, categories = _star(spark)
    got = findings(facts.mapping_audit(
        fact, states.filter("state_sk = 's1'"), management.filter("management_sk <> 4"),
        categories.withColumn("category", F.when(F.col("category_sk") != 12, F.col("category")))))
    assert {k: v for k, v in got.items() if v} == {
        "mapping:state_missing": 3, "mapping:management_missing": 3, "mapping:category_blank": 3}
    assert set(findings(facts.mapping_audit(*_star(spark))).values()) == {0}


def test_repeated_dimension_keys_are_found(spark):
    _, states, management, categories = _star(spark)
    got = findings(facts.dimension_key_checks(states.union(states), management, categories))
    assert got == {"dim_state:unique_key": 2, "dim_management:unique_key": 0, "dim_category:unique_key": 0}


def test_totals_keep_real_nulls_apart_from_total_rows(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, None, 4)], "g string, c string, n bigint")
    out = totals.multi_level_totals(df, [("g", "c"), ("g",), ()], {"g": "ALL", "c": "any"}, ["n"])
    assert bag(out) == Counter([
        ("a", None, 1), ("a", "x", 2), (None, None, 4), ("a", "any", 3), (None, "any", 4),
        ("ALL", "any", 7)])


def test_totals_expand_only_the_aggregated_rows(spark):
    df = spark.range(10).selectExpr("string(id % 2) g", "id n")
    plan = physical_plan(totals.multi_level_totals(df, [("g",), ()], {"g": "ALL"}, ["n"]))
    below = plan[plan.index("Expand"):]
    assert "HashAggregate" in below and "partial_sum" in below


def test_total_copies_suit_distinct_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "g string, k int")
    out = totals.with_total_copies(df, "g", "ALL").groupBy("g").agg(F.countDistinct("k"))
    assert rows(out) == [("ALL", 2), ("a", 1), ("b", 2)]


def test_slices_and_latest_period(spark):
    fact, states, management, _ = _star(spark)
    report = reports.report_management(reports.enrollment_cube(fact), states, management)
    national = reports.report_slice(
        report, management="All Management", geography="Available Source Total")
    assert [tuple(r)[:4] for r in national.collect()] == [
        ("y1", "Available Source Total", "All Management", 66),
        ("y2", "Available Source Total", "All Management", 3)]
    assert {r["ac_year"] for r in reports.latest_period(report).collect()} == {"y2"}
    assert reports.report_slice(report, period="y2").count() == 4


def test_reconciliations_find_missing_and_different(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, total bigint")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, total bigint")
    assert rows(reconcile.full_outer_totals(a, b, ["k"], "total")) == [
        ("x", 1, None, False), ("y", 2, 3, False), ("z", None, 4, False)]
    assert rows(reconcile.fact_vs_report(a, a.filter("k = 'x'"), ["k"], "total")) == [
        ("x", 1, 1, True), ("y", 2, None, False)]
    assert findings(reconcile.row_math(a, "total", ["total"], "m")) == {"m": 0}


def test_group_vs_all_needs_the_total_row(spark):
    df = spark.createDataFrame(
        [("g", "All", 3), ("g", "a", 1), ("g", "b", 2), ("h", "a", 1)], "k string, m string, total bigint")
    out = reconcile.group_vs_all(df, ["k"], "m", "All", "total")
    assert rows(out) == [("g", 3, 3, True), ("h", None, 1, False)]


def test_tolerance_states(spark):
    observed = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1)], "k string, total bigint")
    expected = spark.createDataFrame([("a", 11), ("b", 12), ("d", 1)], "k string, total bigint")
    out = reconcile.within_tolerance(observed, expected, ["k"], F.lit(1))
    assert rows(out, "k", "state") == [("a", "PASS"), ("b", "FAIL"), ("c", "UNEXPECTED"), ("d", "MISSING")]


def test_dimensions(spark):
    states = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", None)], "state_cd string, state_name string")
    assert rows(dims.dim_state(states), "state_cd", "state_name") == [("1", "B"), ("2", None)]
    cats = spark.createDataFrame([(1, " "), (1, "x"), (12, None), (9, "y")],
                                 "sch_category_id int, category_name string")
    assert rows(dims.dim_category(cats), "category_sk", "category_name", "category") == [
        (1, "x", "Foundational + Preparatory School"), (9, "y", None), (12, None, "Pre-Primary School")]
    assert findings(dims.category_source_checks(cats)) == {
        "dim_category:mapped_ids": 1, "dim_category:named_ids": 1}
    periods = dims.dim_period(spark.createDataFrame([("2020-21",), ("2021-22",), ("2021-22",)],
                                                    "academic_year string"))
    assert rows(periods, "academic_year_sk", "is_latest") == [(202021, 0), (202122, 1)]
    assert findings(dims.period_checks(periods)) == {"dim_academic_year:label": 0}


def test_management_is_seeded_once(spark):
    source = spark.createDataFrame([("5", " Govt. school ")], "sch_mgmt_center_id string, management_name string")
    seeded = dims.seed_once(None, source)
    assert rows(seeded) == [(5, 5, "Govt. school", None, "Government")]
    other = spark.createDataFrame([("6", "Trust")], source.schema)
    assert dims.seed_once(seeded, other) is seeded
    assert rows(dims.seed_once(seeded, other, force=True), "management_sk") == [(6,)]
    assert rows(dims.seed_once(seeded.limit(0), other), "management_sk") == [(6,)]


def test_null_parts_do_not_pass_row_math(spark):
    df = spark.createDataFrame([(3, 1, 2), (3, None, 2), (None, None, None)], "total int, a int, b int")
    assert findings(reconcile.row_math(df, "total", ["a", "b"], "m")) == {"m": 2}
