from datetime import date
from hashlib import md5

from pyspark.sql import functions as F

from snapledger.functions import hashing, labels, measures, periods
from tests.helpers import rows


def test_period_keys_and_dates(spark):
    df = spark.createDataFrame([("2020-21",), ("1999-00",), ("bad",)], "p string")
    got = {r[0]: tuple(r[1:]) for r in df.select(
        "p", periods.period_sk("p"), periods.period_start("p"), periods.period_end("p"),
        periods.is_period("p")).collect()}
    assert got["2020-21"] == (202021, date(2020, 4, 1), date(2021, 3, 31), True)
    assert got["1999-00"] == (199900, date(1999, 4, 1), date(2000, 3, 31), True)
    assert got["bad"][1:] == (None, None, False)


def test_period_label_turns_on_first_april(spark):
    df = spark.sql("select explode(array(date'2000-03-31', date'2000-04-01')) d")
    assert rows(df.select(periods.period_label("d"))) == [("1999-00",), ("2000-01",)]


def test_suffix_must_follow_the_year(spark):
    df = spark.createDataFrame([("2020-22",), (None,)], "p string")
    assert rows(df.select(periods.is_period("p"))) == [(False,), (False,)]


def test_management_rules_in_order(spark):
    texts = ["Unaided Trust", "Govt. Aided", "Private Unaided (Recognized)", "GOVERNMENT",
             "private unaided unrecognized", "Madrasa", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", labels.management_group(F.col("t"))).collect()}
    assert got == {
        "Unaided Trust": "Government Aided", "Govt. Aided": "Government Aided",
        "Private Unaided (Recognized)": "Private Unaided Recognized", "GOVERNMENT": "Government",
        "private unaided unrecognized": "Private Unaided Recognized", "Madrasa": "Others",
        None: "Others"}


def test_category_twelve_differs_between_families(spark):
    by_id = {r[0]: r[2] for r in labels.SCHOOL_CATEGORIES}
    assert by_id[12] == "Pre-Primary School" and 9 not in by_id
    df = spark.createDataFrame([(12,), (4,), (11,)], "c int")
    got = [r[0] for r in df.select(labels.teacher_category(F.col("c"))).collect()]
    assert got == ["Foundational + Preparatory School", "Middle School", "Secondary School"]


def test_safe_string_trims_spaces_only(spark):
    df = spark.createDataFrame([("  a ",), ("\t",), ("",)], "t string")
    assert rows(df.select(labels.safe_string(F.col("t")))) == [("",), ("\t",), ("a",)]


def test_hashes_follow_their_formulas(spark):
    df = spark.createDataFrame([("a|b", "c", None), ("a", "b|c", None)], "x string, y string, z int")
    delimited = [r[0] for r in df.select(hashing.delimited_md5(["x", "y", "z"])).collect()]
    assert delimited == [md5(b"a|b|c|<NULL>").hexdigest()] * 2
    prefixed = [r[0] for r in df.select(hashing.length_prefixed_md5(["x", "y", "z"])).collect()]
    assert prefixed[0] == md5(b"V3:a|b;V1:c;N;").hexdigest() and prefixed[0] != prefixed[1]


def test_length_prefix_counts_bytes_and_tells_null_from_text(spark):
    df = spark.createDataFrame([("é",), (None,), ("",), ("N;",)], "x string")
    got = [r[0] for r in df.select(hashing.length_prefixed_md5(["x"])).collect()]
    assert got[0] == md5("V2:é;".encode()).hexdigest()
    assert got[1] == md5(b"N;").hexdigest()
    assert len(set(got)) == 4


def test_surrogate_keys(spark):
    df = spark.sql("select '27' s, '2701' d, 'S1' k, date'2020-04-01' f")
    got = df.select(hashing.state_key("s"), hashing.district_key("s", "d"),
                    hashing.version_key(["k"], "f")).first()
    assert tuple(got) == tuple(
        md5(t).hexdigest() for t in (b"27", b"27|2701", b"S1|2020-04-01"))


def test_stage_measures_add_up_and_treat_null_as_zero(spark):
    assert len(measures.METRICS) == 45 and len(measures.MEASURES) == 20
    values = {m: (i + 1) for i, m in enumerate(measures.METRICS)}
    values["c1_b"] = None
    df = spark.createDataFrame([tuple(values[m] for m in measures.METRICS)],
                               ", ".join(f"{m} bigint" for m in measures.METRICS))
    out = measures.with_stage_measures(df, [])
    assert out.columns == list(measures.MEASURES)
    got = out.first().asDict()

    def total(levels, suffixes):
        return sum(values[f"{level}_{s}"] or 0 for level in levels for s in suffixes)

    for stage, levels in measures.STAGES.items():
        assert got[stage] == total(levels, "bgt")
        assert got[f"{stage}_girls"] == total(levels, "g")
    assert got["total_boys"] == total(measures.LEVELS, "b")
    assert got["total_enrollment"] == total(measures.LEVELS, "bgt")


def test_readable_numbers(spark):
    from snapledger.functions.casts import readable
    texts = ["7", " -8 ", "+9", "1.5", "x", "", None, "99999999999"]
    df = spark.createDataFrame([(t, 3) for t in texts], "t string, n int")
    assert [r[0] for r in df.select(readable(df, "t", "int")).collect()] == [
        7, -8, 9, None, None, None, None, None]
    assert df.select(readable(df, "t", "bigint")).collect()[-1][0] == 99999999999
    assert df.select(readable(df, "n", "string")).first()[0] == "3"
