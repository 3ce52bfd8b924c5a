"""Conformed dimensions, rebuilt in full from the snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.casts import readable
from snapledger.functions.hashing import district_key, state_key
from snapledger.functions.labels import (
    SCHOOL_CATEGORIES,
    SCHOOL_CATEGORY_IDS,
    choose,
    management_group,
    safe_string,
)
from snapledger.functions.periods import is_period, period_end, period_sk, period_start
from snapledger.operators.checks import codes_without_label, count_bad, union_checks
from snapledger.sources.columns import Alias, resolve_columns

# Accepted column names of a management source.
MANAGEMENT_ROLES = {
    "id": Alias(("management_center_id", "sch_mgmt_center_id")),
    "name": Alias(("management", "management_name", "management_group")),
    "detail": Alias(
        ("management_detailed", "management_detail", "management_description"), required=False),
}


def dim_period(snapshots: DataFrame) -> DataFrame:
    """One row per academic year; the newest is found among the labels, not the snapshots."""
    periods = snapshots.select("academic_year").distinct()
    newest = periods.agg(F.max("academic_year").alias("academic_year")).withColumn(
        "_newest", F.lit(1))
    return periods.join(F.broadcast(newest), "academic_year", "left").select(
        period_sk("academic_year").alias("academic_year_sk"),
        "academic_year",
        period_start("academic_year").alias("start_date"),
        period_end("academic_year").alias("end_date"),
        F.coalesce("_newest", F.lit(0)).cast("tinyint").alias("is_latest"),
    )


def period_checks(periods: DataFrame) -> DataFrame:
    return count_bad(periods, {"dim_academic_year:label": ~is_period("academic_year")})


def dim_state(states: DataFrame) -> DataFrame:
    return states.groupBy("state_cd").agg(F.max("state_name").alias("state_name")).select(
        state_key("state_cd").alias("state_sk"), "state_cd", "state_name")


def dim_district(districts: DataFrame) -> DataFrame:
    named = districts.groupBy("state_cd", "district_cd").agg(
        F.max("district_name").alias("district_name"))
    return named.select(
        district_key("state_cd", "district_cd").alias("district_sk"),
        state_key("state_cd").alias("state_sk"), "state_cd", "district_cd", "district_name",
    )


def dim_category(categories: DataFrame) -> DataFrame:
    """Report labels by source category id. The key is the id itself."""
    named = categories.groupBy("sch_category_id").agg(
        F.max(F.nullif(F.trim("category_name"), F.lit(""))).alias("category_name"))
    key = F.col("sch_category_id")
    labels = {
        name: choose(key, {row[0]: row[i] for row in SCHOOL_CATEGORIES})
        for i, name in ((1, "education_detailed"), (2, "category"), (3, "category_detailed"))
    }
    return named.select(
        key.alias("category_sk"), key, "category_name",
        *[label.alias(name) for name, label in labels.items()],
    )


def category_source_checks(categories: DataFrame) -> DataFrame:
    """No unmapped id, no id without a usable name."""
    ids = categories.select("sch_category_id").distinct()
    key = F.col("sch_category_id")
    unmapped = count_bad(ids, {
        "dim_category:mapped_ids": key.isNull() | ~key.isin(*SCHOOL_CATEGORY_IDS)})
    nameless = codes_without_label(categories, "sch_category_id", "category_name")
    return union_checks(unmapped, count_bad(nameless, {"dim_category:named_ids": F.lit(True)}))


def dim_management(source: DataFrame) -> DataFrame:
    """Management codes with their report group."""
    c = resolve_columns(source, MANAGEMENT_ROLES)
    key = readable(source, c["id"], "int")
    name = safe_string(F.col(c["name"]))
    detail = F.col(c["detail"]).cast("string") if c["detail"] else F.lit(None).cast("string")
    return source.select(
        key.alias("management_sk"), key.alias("management_center_id"),
        name.alias("management"), detail.alias("management_detailed"),
        management_group(name).alias("management_group"),
    )


def seed_once(existing: DataFrame | None, source: DataFrame, force: bool = False) -> DataFrame:
    """Keep a populated management dimension unless a refresh is forced."""
    if existing is not None and not force and not existing.isEmpty():
        return existing
    return dim_management(source)


def dim_social_category(measures: DataFrame) -> DataFrame:
    """At most one row per mapped social category: the normalizer admits only those ids."""
    return measures.groupBy("item_group", "item_id").agg(
        F.max("social_category").alias("social_category")
    ).select(F.col("item_id").alias("social_category_sk"), "item_group", "item_id", "social_category")
