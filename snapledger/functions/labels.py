"""Code-to-label rules of the census domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Management groups, in report order.
GOVERNMENT = "Government"
AIDED = "Government Aided"
PRIVATE = "Private Unaided Recognized"
OTHERS = "Others"
MANAGEMENT_GROUPS = (GOVERNMENT, AIDED, PRIVATE, OTHERS)

# Labels of total and default rows.
ALL_MANAGEMENT = "All Management"
ALL_GEOGRAPHIES = "Available Source Total"
UNKNOWN_CATEGORY = "Unknown"

# Social categories by item id (item group 1).
SOCIAL_CATEGORIES = {1: "General", 2: "SC", 3: "ST", 4: "OBC"}

# School categories (id, stage, report category, grades). There is no id 9.
SCHOOL_CATEGORIES = (
    (1, "Preparatory", "Foundational + Preparatory School", "Grades 1 to 5"),
    (2, "Middle", "Middle School", "Grades 1 to 8"),
    (3, "Secondary", "Secondary School", "Grades 1 to 12"),
    (4, "Middle", "Middle School", "Grades 6 to 8"),
    (5, "Secondary", "Secondary School", "Grades 6 to 12"),
    (6, "Secondary", "Secondary School", "Grades 1 to 10"),
    (7, "Secondary", "Secondary School", "Grades 6 to 10"),
    (8, "Secondary", "Secondary School", "Grades 9 & 10"),
    (10, "Secondary", "Secondary School", "Grades 9 to 12"),
    (11, "Secondary", "Secondary School", "Grades 11 & 12"),
    (12, "Foundational", "Pre-Primary School", "Pre-Primary Only"),
)
SCHOOL_CATEGORY_IDS = tuple(row[0] for row in SCHOOL_CATEGORIES)

# Teacher report stages. Category 12 counts as primary here, unlike above.
TEACHER_PRIMARY_IDS = (1, 12)
TEACHER_MIDDLE_IDS = (2, 4)
TEACHER_SECONDARY_IDS = (3, 5, 6, 7, 8, 10, 11)

# Teacher grade bands and the category ids that fall into each.
GRADE_BANDS = {
    "grades_1_5": TEACHER_PRIMARY_IDS,
    "grades_1_8": (2,),
    "grades_6_8": (4,),
    "grades_1_10": (6,),
    "grades_6_10": (7,),
    "grades_9_10": (8,),
    "grades_1_12": (3,),
    "grades_6_12": (5,),
    "grades_9_12": (10,),
    "grades_11_12": (11,),
}


def choose(key: Column, mapping: dict) -> Column:
    """Label for each key of a small fixed mapping, NULL for any other key."""
    (first, label), *rest = mapping.items()
    picked = F.when(key == first, F.lit(label))
    for value, label in rest:
        picked = picked.when(key == value, F.lit(label))
    return picked


def safe_string(column: Column) -> Column:
    """Text without surrounding spaces; tabs stay and an empty string stays empty."""
    return F.trim(column.cast("string"))


def is_blank(column: Column) -> Column:
    return column.isNull() | (F.length(F.trim(column)) == 0)


def management_group(text: Column) -> Column:
    """Classify free text. Order matters: any 'aided' that is not private is Government Aided."""
    low = F.lower(text)
    return (
        F.when(low.contains("private") & low.contains("unaided"), PRIVATE)
        .when(low.contains("aided"), AIDED)
        .when(low.contains("government") | low.contains("govt"), GOVERNMENT)
        .otherwise(OTHERS)
    )


def teacher_category(category_id: Column) -> Column:
    by_id = {row[0]: row[2] for row in SCHOOL_CATEGORIES}
    return (
        F.when(category_id.isin(*TEACHER_PRIMARY_IDS), by_id[1])
        .when(category_id.isin(*TEACHER_MIDDLE_IDS), by_id[2])
        .otherwise(by_id[3])
    )
