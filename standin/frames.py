"""The driver's order tables dressed up as school census drops.

customer -> school, nation -> state, fiscal year of the order -> academic year. Only names
and codes are mapped here; all computing is done by ``snapledger``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions.labels import SOCIAL_CATEGORIES, choose
from snapledger.functions.measures import SUFFIXES
from snapledger.functions.periods import period_label
from snapledger.operators.checks import count_bad, union_checks
from snapledger.plans import dims, facts, reports
from snapledger.sources.normalize import (
    Lineage,
    normalize_category,
    normalize_counts,
    normalize_district,
    normalize_measures,
    normalize_snapshot,
    normalize_state,
)

LINEAGE = Lineage("standin", "standin", "2002-01-01 00:00:00")
SCHOOL_LINEAGE = Lineage("standin", "standin", "2002-01-01 00:00:00", "orders")

SEGMENTS = {
    "BUILDING": (1, "Government School"),
    "AUTOMOBILE": (2, "Govt. Aided"),
    "HOUSEHOLD": (3, "Private Unaided (Recognized)"),
    "MACHINERY": (4, "Unaided Trust"),
    "FURNITURE": (5, "Madrasa"),
}
STATUS = {"F": 1, "O": 2, "P": 3}
ITEMS = {"A": 1, "N": 2, "R": 3}
# Line number -> grade level, spread over all stages and the required c1 and c12.
LINE_LEVELS = {1: "c1", 2: "c3", 3: "c5", 4: "c6", 5: "c8", 6: "c9", 7: "c12"}
LINE_SUFFIX = {"b": "F", "g": "O"}


def year() -> Column:
    return F.col("academic_year")


# Columns the stand-ins use, so that no job has to open files to infer them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                "l_discount double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "ts timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def period_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("academic_year", period_label("o_orderdate"))


def state_code(key: str) -> Column:
    return F.col(key).cast("string")


def district_code() -> Column:
    third = (F.col("c_custkey") % 3).cast("string")
    return F.concat(state_code("c_nationkey"), F.lit("-"), third)


def periods(spark: SparkSession, sf_dir: str) -> list[str]:
    """Labels that occur among the orders, oldest first: one row per calendar year is brought here."""
    labels = period_orders(spark, sf_dir).select("academic_year").distinct().dropna().collect()
    return sorted((row["academic_year"] for row in labels))


def runs(spark: SparkSession, sf_dir: str) -> list[tuple[str, str]]:
    """One observation per period, in the year after it began."""
    return [(p, f"{int(p[:4]) + 1}-04-01 00:00:00") for p in periods(spark, sf_dir)]


def _each_period(df: DataFrame, sf_dir: str) -> DataFrame:
    """Every row once for each period of the orders, which a subquery of the same query collects:
    one label per calendar year."""
    seen = period_orders(df.sparkSession, sf_dir).agg(F.collect_set("academic_year").alias("labels"))
    return df.withColumn("academic_year", F.explode(seen.scalar()))


def raw_states(spark, sf_dir):
    return _each_period(table(spark, sf_dir, "nation"), sf_dir).select(
        "academic_year", state_code("n_nationkey").alias("State_Cd"),
        F.col("n_name").alias("state_name_english"))


def raw_districts(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    found = customers.select(
        state_code("c_nationkey").alias("udise_state_code"),
        district_code().alias("district_code")).distinct()
    return _each_period(found, sf_dir).withColumn(
        "district_name", F.concat(F.lit("District "), "district_code"))


def raw_categories(spark, sf_dir):
    """One row per order: the many copies of a category collapse in the normalizer."""
    priority = F.col("o_orderpriority")
    return period_orders(spark, sf_dir).select(
        "academic_year", priority_number(priority).alias("school_category_id"),
        priority_label(priority).alias("category_name"))


def priority_number(text: Column) -> Column:
    """The number before the dash; NULL where there is none."""
    return F.nullif(F.regexp_extract(text, r"^(\d{1,9})-", 1), F.lit("")).cast("int")


def priority_label(text: Column) -> Column:
    return F.regexp_replace(text, r"^\d{1,9}-", "")


def raw_schools(spark, sf_dir, orders: DataFrame | None = None):
    """A customer's last order of the year says how the school looked in that year."""
    orders = period_orders(spark, sf_dir) if orders is None else orders
    last = orders.groupBy("o_custkey", "academic_year").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority"))
        .alias("last"))
    customers = table(spark, sf_dir, "customer")
    return last.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "academic_year",
        F.col("c_custkey").cast("string").alias("school_code"),
        F.col("c_name").alias("sch_name"),
        state_code("c_nationkey").alias("udise_state_code"),
        district_code().alias("udise_dist_code"),
        priority_number(F.col("last.o_orderpriority")).alias("category_id"),
        choose(F.col("c_mktsegment"), {s: v[0] for s, v in SEGMENTS.items()})
        .alias("sch_mgmt_center_id"),
        choose(F.col("last.o_orderstatus"), STATUS).alias("sch_status"),
    )


def raw_enrollment(spark, sf_dir):
    """Quantities by school, year and return flag, spread over grade and gender columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity")
    orders = period_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "academic_year")
    quantity = F.col("l_quantity").cast("bigint")
    cells = [
        F.sum(F.when(
            (F.col("l_linenumber") == line) & (F.col("l_linestatus") == LINE_SUFFIX[s]), quantity
        )).alias(f"{level}_{s}")
        for line, level in LINE_LEVELS.items() for s in SUFFIXES if s in LINE_SUFFIX
    ]
    names = [f"{level}_{s}" for level in LINE_LEVELS.values() for s in LINE_SUFFIX]
    # summed per order before the join, so a hot order arrives as one row per flag and task
    per_order = lines.groupBy("l_orderkey", "l_returnflag").agg(*cells)
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    summed = joined.groupBy("o_custkey", "academic_year", "l_returnflag").agg(
        *[F.sum(name).alias(name) for name in names])
    return summed.select(
        "academic_year", F.col("o_custkey").cast("string").alias("school_code"),
        F.lit(1).alias("item_group_id"), choose(F.col("l_returnflag"), ITEMS).alias("itemid"),
        *names)


def raw_teachers(spark, sf_dir):
    status = F.col("o_orderstatus")
    return period_orders(spark, sf_dir).groupBy("o_custkey", "academic_year").agg(
        F.count_if(status == "F").alias("male_tch"),
        F.count_if(status == "O").alias("female_tch"),
        F.count_if(status == "P").alias("transgen_tch"),
    ).withColumn("udise_sch_code", F.col("o_custkey").cast("string"))


def raw_management(spark, sf_dir, segments: dict = SEGMENTS):
    found = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return found.filter(F.col("c_mktsegment").isin(*segments)).select(
        choose(F.col("c_mktsegment"), {s: v[0] for s, v in segments.items()})
        .alias("sch_mgmt_center_id"),
        choose(F.col("c_mktsegment"), {s: v[1] for s, v in segments.items()})
        .alias("management_name"),
        F.col("c_mktsegment").alias("management_description"))


def unmapped_checks(spark, sf_dir):
    """Values of the order tables that no mapping here knows: they would be in no report."""
    lines = table(spark, sf_dir, "lineitem")
    return union_checks(
        count_bad(table(spark, sf_dir, "customer"), {
            "customer:segment": ~F.coalesce(F.col("c_mktsegment").isin(*SEGMENTS), F.lit(False))}),
        count_bad(table(spark, sf_dir, "orders"), {
            "orders:status": ~F.coalesce(F.col("o_orderstatus").isin(*STATUS), F.lit(False)),
            "orders:priority": priority_number(F.col("o_orderpriority")).isNull()}),
        count_bad(lines, {
            "lineitem:flag": ~F.coalesce(F.col("l_returnflag").isin(*ITEMS), F.lit(False)),
            "lineitem:number": ~F.coalesce(F.col("l_linenumber").isin(*LINE_LEVELS), F.lit(False)),
            "lineitem:status": ~F.coalesce(F.col("l_linestatus").isin(*LINE_SUFFIX.values()), F.lit(False)),
            "lineitem:quantity": F.col("l_quantity") != F.floor("l_quantity")}),
    )


def states(spark, sf_dir):
    return normalize_state(raw_states(spark, sf_dir), year(), LINEAGE)


def districts(spark, sf_dir):
    return normalize_district(raw_districts(spark, sf_dir), year(), LINEAGE)


def categories(spark, sf_dir):
    return normalize_category(raw_categories(spark, sf_dir), year(), LINEAGE)


def schools(spark, sf_dir):
    """The register. Its drop holds one row per school and year, as it is an aggregate."""
    return normalize_snapshot(
        raw_schools(spark, sf_dir), year(), SCHOOL_LINEAGE, duplicates="unique")


def settled_schools(spark, sf_dir):
    """A register that misses schools: orders still pending are left out."""
    settled = period_orders(spark, sf_dir).filter(F.col("o_orderstatus") != "P")
    return normalize_snapshot(
        raw_schools(spark, sf_dir, settled), year(), SCHOOL_LINEAGE, duplicates="unique")


def measures(spark, sf_dir):
    return normalize_measures(raw_enrollment(spark, sf_dir), year(), LINEAGE)


def teachers(spark, sf_dir):
    return normalize_counts(raw_teachers(spark, sf_dir), year())


def dim_state(spark, sf_dir):
    return dims.dim_state(states(spark, sf_dir))


def dim_category(spark, sf_dir):
    return dims.dim_category(categories(spark, sf_dir))


def dim_management(spark, sf_dir, segments: dict = SEGMENTS):
    """One row per mapped segment, so at most five: safe to broadcast."""
    return F.broadcast(dims.dim_management(raw_management(spark, sf_dir, segments)))


def dim_school(spark, sf_dir):
    return facts.dim_school(schools(spark, sf_dir))


def dim_period(spark, sf_dir):
    """Labels are made from dates, one per calendar year: bounded, so safe to broadcast."""
    return F.broadcast(dims.dim_period(period_orders(spark, sf_dir)))


def dim_social(spark, sf_dir):
    """From the return flags alone, so that the fact need not build its measures twice.
    At most one row per mapped item: safe to broadcast."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    item = choose(F.col("l_returnflag"), ITEMS)
    return F.broadcast(dims.dim_social_category(flags.select(
        F.lit(1).alias("item_group"), item.alias("item_id"),
        choose(item, SOCIAL_CATEGORIES).alias("social_category"))))


def fact_student(spark, sf_dir):
    return facts.fact_student(
        measures(spark, sf_dir), dim_period(spark, sf_dir), dim_social(spark, sf_dir),
        dim_school(spark, sf_dir))


def fact_teacher(spark, sf_dir):
    return facts.fact_teacher(*teacher_sources(spark, sf_dir))


def teacher_sources(spark, sf_dir, segments: dict = SEGMENTS):
    return (
        teachers(spark, sf_dir), schools(spark, sf_dir), states(spark, sf_dir),
        categories(spark, sf_dir), dim_management(spark, sf_dir, segments),
    )


def enrollment_cube(spark, sf_dir):
    return reports.enrollment_cube(fact_student(spark, sf_dir))


def management_report(spark, sf_dir, cube: DataFrame | None = None):
    cube = enrollment_cube(spark, sf_dir) if cube is None else cube
    return reports.report_management(cube, dim_state(spark, sf_dir), dim_management(spark, sf_dir))


def category_report(spark, sf_dir, cube: DataFrame | None = None):
    cube = enrollment_cube(spark, sf_dir) if cube is None else cube
    return reports.report_category(
        cube, dim_state(spark, sf_dir), dim_management(spark, sf_dir), dim_category(spark, sf_dir))
