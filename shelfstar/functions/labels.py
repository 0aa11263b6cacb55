"""Codes and labels derived from values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and thresholds the results must carry.
AGE_RANGES = (
    ("BELOW 18", None, 17),
    ("18 TO 25", 18, 25),
    ("26 TO 40", 26, 40),
    ("41 TO 55", 41, 55),
    ("56 TO 70", 56, 70),
    ("71+", 71, None),
)
AGE_NOT_GIVEN = 100
GENDER_CODES = {"female": "F", "male": "M"}
GENDER_UNKNOWN = "U"
RETURN_SCORES = {"RETURNED": 100, "LOST": 0}
RETURN_SCORE_OTHER = 50
BORROWING_HIGHER, SALES_HIGHER, BALANCED = "Borrowing Higher", "Sales Higher", "Balanced"
PRIORITY_LEVELS = (("HIGH", 30), ("MED", 15))
PRIORITY_REST = "LOW"


def age_range(age: Column) -> Column:
    label = F.when(age.isNull() | (age == AGE_NOT_GIVEN), "UNKNOWN")
    for name, _, last in AGE_RANGES:
        label = label.otherwise(F.lit(name)) if last is None else label.when(age <= last, name)
    return label


def gender_code(gender: Column) -> Column:
    text = F.lower(F.trim(gender))
    code = None
    for word, letter in GENDER_CODES.items():
        code = F.when(text == word, letter) if code is None else code.when(text == word, letter)
    return code.otherwise(GENDER_UNKNOWN)


def return_score(status: Column) -> Column:
    text = F.upper(F.coalesce(status, F.lit("ON LOAN")))
    score = None
    for word, points in RETURN_SCORES.items():
        score = F.when(text == word, points) if score is None else score.when(text == word, points)
    return score.otherwise(RETURN_SCORE_OTHER)


def received_flag(status: Column) -> Column:
    return F.when(status == "Received", "Y").otherwise("N")


def preference_flag(borrows: Column, sales: Column) -> Column:
    """More than 10 percent ahead of the other activity, on whole counts."""
    return (
        F.when(borrows * 10 > sales * 11, BORROWING_HIGHER)
        .when(sales * 10 > borrows * 11, SALES_HIGHER)
        .otherwise(BALANCED)
    )


def priority_flag(value: Column, total: Column) -> Column:
    """Delivery priority from the unrounded share of the period total."""
    known = total != 0
    flag = None
    for name, least in PRIORITY_LEVELS:
        hit = known & (value * 100 >= total * least)
        flag = F.when(hit, name) if flag is None else flag.when(hit, name)
    return flag.otherwise(PRIORITY_REST)
