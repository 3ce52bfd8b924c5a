"""Normalizers: one raw annual drop in, one typed snapshot out.

Each takes the raw frame, the period (a label, or a column when one frame holds several
periods) and the lineage of the drop. They are lazy; the matching ``*_checks`` function
yields the findings that ``enforce`` turns into an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.casts import readable
from snapledger.functions.labels import SOCIAL_CATEGORIES, choose, is_blank, safe_string
from snapledger.functions.measures import METRICS
from snapledger.operators.checkplan import CheckPlan
from snapledger.operators.checks import (
    collapse_duplicates,
    conflict_check,
    count_bad,
    duplicate_key_check,
    union_checks,
)
from snapledger.sources.columns import Alias, first_present, resolve_columns

# Accepted source column names, best first.
_STATE = ("udise_state_code", "state_cd", "state_code")
_DISTRICT = ("udise_district_code", "district_cd", "district_code", "udise_dist_code")
_SCHOOL = ("udise_sch_code", "school_code")
_CATEGORY = ("sch_category_id", "school_category_id", "category_id")
_MANAGEMENT = (
    "management_center_id", "sch_mgmt_center_id", "management_centre_id", "sch_mgmt_centre_id",
)

STATE_ROLES = {
    "code": Alias(_STATE),
    "name": Alias(("state_name", "state_name_english", "state_name_eng"), required=False),
}
DISTRICT_ROLES = {
    "state": Alias(_STATE),
    "code": Alias(_DISTRICT),
    "name": Alias(("district_name", "district_name_english", "district_name_eng"), required=False),
}
CATEGORY_ROLES = {
    "id": Alias(_CATEGORY),
    "name": Alias((
        "sch_category_type", "sch_category_name", "school_category_name", "category_name",
        "sch_category", "school_category", "category",
    )),
}
SCHOOL_ROLES = {
    "code": Alias(_SCHOOL),
    "name": Alias(("school_name", "sch_name"), required=False),
    "state": Alias(("state_cd", "udise_state_code", "state_code")),
    "district": Alias(("district_cd", "udise_district_code", "district_code", "udise_dist_code")),
    "category": Alias(_CATEGORY, required=False),
    "management": Alias(_MANAGEMENT),
    "status": Alias(("school_status", "sch_status"), required=False),
}
ENROLLMENT_ROLES = {
    "code": Alias(_SCHOOL),
    "group": Alias(("item_group", "item_group_id")),
    "item": Alias(("item_id", "itemid")),
}
# Metrics every enrollment drop must hold.
REQUIRED_METRICS = {m: Alias((m,)) for m in ("c1_b", "c1_g", "c12_b", "c12_g")}
TEACHER_COUNTS = ("male_tch", "female_tch", "transgen_tch")
TEACHER_ROLES = {n: Alias((n,)) for n in ("udise_sch_code", *TEACHER_COUNTS)}

SNAPSHOT_KEYS = ("academic_year", "udise_sch_code")
SCHOOL_ATTRIBUTES = (
    "school_name", "state_cd", "district_cd", "sch_category_id", "management_center_id",
    "school_status",
)
ENROLLMENT_KEYS = ("academic_year", "udise_sch_code", "item_group", "item_id")


@dataclass(frozen=True)
class Lineage:
    """Where a drop came from. ``processed_at`` is an argument so that reruns agree."""

    source_db: str
    source_schema: str
    processed_at: str
    source_table: str | None = None

    def columns(self) -> list[Column]:
        out = [F.lit(self.source_db).alias("source_db"),
               F.lit(self.source_schema).alias("source_schema")]
        if self.source_table is not None:
            out.append(F.lit(self.source_table).alias("source_table"))
        return [*out, F.lit(self.processed_at).cast("timestamp").alias("processed_at")]


def _period(period: str | Column) -> Column:
    return (F.lit(period) if isinstance(period, str) else period).alias("academic_year")


def _text(name: str | None) -> Column:
    return safe_string(F.col(name)) if name else F.lit(None).cast("string")


def _number(raw: DataFrame, name: str | None, kind: str = "int") -> Column:
    return readable(raw, name, kind) if name else F.lit(None).cast(kind)


def _one_each(rows: DataFrame, *keys: str) -> DataFrame:
    """Collapse a master table. Its codes are few, so equal rows go first: that hashes, where
    picking the greatest row has to sort, and copies of one code never travel."""
    return collapse_duplicates(rows.distinct(), list(keys))


def normalize_state(raw: DataFrame, period: str | Column, lineage: Lineage) -> DataFrame:
    """One row per (period, state); of several names the greatest is kept."""
    c = resolve_columns(raw, STATE_ROLES)
    rows = raw.select(
        _period(period), _text(c["code"]).alias("state_cd"),
        _text(c["name"]).alias("state_name"), *lineage.columns(),
    )
    return _one_each(rows, "academic_year", "state_cd")


def normalize_district(raw: DataFrame, period: str | Column, lineage: Lineage) -> DataFrame:
    """One row per (period, state, district): a code reused in two states keeps both."""
    c = resolve_columns(raw, DISTRICT_ROLES)
    rows = raw.select(
        _period(period), _text(c["code"]).alias("district_cd"),
        _text(c["state"]).alias("state_cd"), _text(c["name"]).alias("district_name"),
        *lineage.columns(),
    )
    return _one_each(rows, "academic_year", "state_cd", "district_cd")


def reused_district_codes(districts: DataFrame) -> DataFrame:
    """District codes that more than one state uses within a period."""
    return (
        districts.groupBy("academic_year", "district_cd")
        .agg(F.min("state_cd").alias("first_state"), F.max("state_cd").alias("last_state"))
        .filter("first_state <> last_state")
    )


def normalize_category(raw: DataFrame, period: str | Column, lineage: Lineage) -> DataFrame:
    c = resolve_columns(raw, CATEGORY_ROLES)
    rows = raw.select(
        _period(period), _number(raw, c["id"]).alias("sch_category_id"),
        _text(c["name"]).alias("category_name"), *lineage.columns(),
    )
    return _one_each(rows, "academic_year", "sch_category_id")


def category_rules() -> dict[str, Column]:
    return {
        "category:name_required": is_blank(F.col("category_name")),
        "category:id_required": F.col("sch_category_id").isNull(),
    }


def category_checks(categories: DataFrame) -> DataFrame:
    return count_bad(categories, category_rules())


def school_rows(raw: DataFrame, period: str | Column, lineage: Lineage) -> DataFrame:
    """Typed school rows before checks and collapse; rows without a code are dropped."""
    c = resolve_columns(raw, SCHOOL_ROLES)
    return raw.select(
        _period(period), _text(c["code"]).alias("udise_sch_code"),
        _text(c["name"]).alias("school_name"), _text(c["state"]).alias("state_cd"),
        _text(c["district"]).alias("district_cd"),
        _number(raw, c["category"]).alias("sch_category_id"),
        _number(raw, c["management"]).alias("management_center_id"),
        _number(raw, c["status"]).alias("school_status"), *lineage.columns(),
    ).filter(F.length("udise_sch_code") > 0)


def normalize_snapshot(
    raw: DataFrame, period: str | Column, lineage: Lineage, duplicates: str = "collapse"
) -> DataFrame:
    """School register of one period; identical duplicates collapse.

    Rows of one school that differ are kept, and fail ``snapshot_checks`` and the contract.
    ``duplicates="unique"`` is for a drop known to hold one row per school: it saves the
    collapse and its shuffle.
    """
    if duplicates not in ("collapse", "unique"):
        raise ValueError(f"unknown duplicates policy: {duplicates}")
    rows = school_rows(raw, period, lineage)
    return rows if duplicates == "unique" else rows.distinct()


def snapshot_checks(raw: DataFrame, period: str | Column, lineage: Lineage) -> DataFrame:
    """Required values, unreadable numbers, and rows of one school that disagree."""
    c = resolve_columns(raw, SCHOOL_ROLES)
    rows = school_rows(raw, period, lineage)
    empty = {n: F.col(n).isNull() | (F.length(n) == 0) for n in ("state_cd", "district_cd")}
    rules = {f"school:{n}_required": bad for n, bad in empty.items()}
    rules["school:management_center_id_required"] = F.col("management_center_id").isNull()
    numbers = {
        f"school:{role}_number": F.col(c[role]).isNotNull() & _number(raw, c[role]).isNull()
        for role in ("category", "status") if c[role]
    }
    parts = [
        count_bad(rows, rules),
        conflict_check("school:conflicting_duplicates", rows, SNAPSHOT_KEYS, SCHOOL_ATTRIBUTES),
    ]
    if numbers:
        parts.append(count_bad(raw, numbers))
    return union_checks(*parts)


def snapshot_plan(raw: DataFrame, prefix: str) -> CheckPlan:
    """The findings of ``snapshot_checks`` and ``blank_codes`` from one scan of a raw register."""
    c = resolve_columns(raw, SCHOOL_ROLES)
    numbers = {role: c[role] for role in ("category", "status") if c[role]}
    typed = raw.select(
        _text(c["code"]).alias("udise_sch_code"), _text(c["name"]).alias("school_name"),
        _text(c["state"]).alias("state_cd"), _text(c["district"]).alias("district_cd"),
        _number(raw, c["category"]).alias("sch_category_id"),
        _number(raw, c["management"]).alias("management_center_id"),
        _number(raw, c["status"]).alias("school_status"),
        *[(F.col(name).isNotNull() & _number(raw, name).isNull()).alias(f"_bad_{role}")
          for role, name in numbers.items()])
    coded = F.coalesce(F.length("udise_sch_code") > 0, F.lit(False))
    rules = {f"school:{n}_required": F.col(n).isNull() | (F.length(n) == 0) for n in ("state_cd", "district_cd")}
    rules["school:management_center_id_required"] = F.col("management_center_id").isNull()
    return (
        CheckPlan()
        .rules(typed, {f"{prefix}{name}": coded & bad for name, bad in rules.items()})
        .rules(typed, {f"{prefix}school:{role}_number": F.col(f"_bad_{role}") for role in numbers})
        .conflict(f"{prefix}school:conflicting_duplicates", typed, ["udise_sch_code"], SCHOOL_ATTRIBUTES, coded)
        .count(f"{prefix}school:rows", typed)
        .tally(typed, {f"{prefix}school:blank_code_left_out": ~coded})
    )


def metric_plan(raw: DataFrame, prefix: str) -> CheckPlan:
    """The findings of ``metric_checks`` and the number of rows that the snapshot will hold."""
    c = resolve_columns(raw, ENROLLMENT_ROLES)
    return (
        CheckPlan().rules(raw, {f"{prefix}{name}": bad for name, bad in _metric_rules(raw).items()})
        .count(f"{prefix}enrollment:rows", raw)
        .tally(raw, {f"{prefix}enrollment:wanted": _wanted(raw, c)})
    )


def _wanted(raw: DataFrame, c: dict[str, str | None]) -> Column:
    """Rows of the social categories."""
    return (_number(raw, c["group"]) == 1) & _number(raw, c["item"]).isin(*SOCIAL_CATEGORIES)


def normalize_measures(raw: DataFrame, period: str | Column, lineage: Lineage) -> DataFrame:
    """Enrollment by school and social category.

    An absent metric column becomes 0, a present NULL stays NULL; the two flags say which
    families the drop holds. Names are matched without regard to case.
    """
    c = resolve_columns(raw, ENROLLMENT_ROLES)
    metric = {m: first_present(raw.columns, Alias((m,))) for m in METRICS}
    pre_primary = any(metric[f"pp{n}_{s}"] for n in (1, 2, 3) for s in ("b", "g"))
    transgender = any(metric[m] for m in METRICS if m.endswith("_t"))
    item = _number(raw, c["item"])
    return raw.filter(_wanted(raw, c)).select(
        _period(period), _text(c["code"]).alias("udise_sch_code"),
        _number(raw, c["group"]).alias("item_group"), item.alias("item_id"),
        choose(item, SOCIAL_CATEGORIES).alias("social_category"),
        *[(readable(raw, name, "bigint") if name else F.expr("bigint(0)")).alias(m)
          for m, name in metric.items()],
        F.lit(int(pre_primary)).cast("tinyint").alias("pre_primary_available"),
        F.lit(int(transgender)).cast("tinyint").alias("transgender_available"),
        *lineage.columns(),
    )


def metric_checks(raw: DataFrame) -> DataFrame:
    """Metrics, groups and items that are not whole numbers: a row with such a group or item
    would be left out as of another kind. Repeated keys, even identical ones, break the
    contract of the stored table."""
    return count_bad(raw, _metric_rules(raw))


def _metric_rules(raw: DataFrame) -> dict[str, Column]:
    c = resolve_columns(raw, ENROLLMENT_ROLES)
    names = [n for m in METRICS if (n := first_present(raw.columns, Alias((m,))))]
    kinds = {**{n: "bigint" for n in names}, c["group"]: "int", c["item"]: "int"}
    return {
        f"enrollment:{n}_number": F.col(n).isNotNull() & _number(raw, n, kind).isNull()
        for n, kind in kinds.items()
    }


def blank_codes(raw: DataFrame) -> DataFrame:
    """Rows of the register without a school code, which the snapshot leaves out, as a count."""
    code = _text(resolve_columns(raw, SCHOOL_ROLES)["code"])
    return count_bad(raw, {"school:blank_code_left_out": F.coalesce(F.length(code), F.lit(0)) == 0})


def shared_state_names(states: DataFrame) -> DataFrame:
    """State names that more than one code bears within a period; such states meet in a report."""
    return (
        states.groupBy("academic_year", "state_name")
        .agg(F.min("state_cd").alias("first_state"), F.max("state_cd").alias("last_state"))
        .filter("first_state <> last_state")
    )


def normalize_counts(raw: DataFrame, period: str | Column) -> DataFrame:
    """Teacher counts by school. Duplicates are never summed; see ``counts_checks``."""
    c = resolve_columns(raw, TEACHER_ROLES)
    return raw.select(
        _period(period), _text(c["udise_sch_code"]).alias("udise_sch_code"),
        *[_number(raw, c[n], "bigint").alias(n) for n in TEACHER_COUNTS],
    )


def counts_checks(counts: DataFrame) -> DataFrame:
    bad = reduce(
        lambda a, b: a | b,
        [F.col(n).isNull() | (F.col(n) < 0) for n in TEACHER_COUNTS],
        F.coalesce(F.length("udise_sch_code"), F.lit(0)) == 0,
    )
    return union_checks(
        count_bad(counts, {"teachers:counts_and_code": bad}),
        duplicate_key_check("teachers:unique_key", counts, SNAPSHOT_KEYS),
    )
