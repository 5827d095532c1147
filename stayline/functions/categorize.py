"""Value → category rules (F21-F25), all native CASE chains.

Order matters: the first matching substring wins, as in the source rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ethnicity buckets in match order; the ventilation notebook puts
# AMERICAN INDIAN in front.
ETHNICITY_ORDER = ("ASIAN", "WHITE", "HISPANIC", "BLACK")
ETHNICITY_ORDER_WITH_NATIVE = ("AMERICAN INDIAN", "ASIAN", "WHITE", "HISPANIC", "BLACK")
ETHNICITY_LABELS = {"HISPANIC": "HISPANIC/LATINO"}
# Age buckets (lower, upper] with their labels and the strict bands (lower, upper).
AGE_BUCKETS = ((10, 30, "<31"), (30, 50, "31-50"), (50, 70, "51-70"))
AGE_BANDS_STRICT = ((0, 45), (45, 65), (65, 90), (90, 500))
# What a text contains and its group, in match order; anything else, NULL too, is OTHER.
ALONE = "SINGLE/SEPARATED/DIVORCED/WIDOW"
MARITAL_RULES = (("DIVORCED", ALONE), ("SEPARATED", ALONE), ("SINGLE", ALONE), ("WIDOWED", ALONE),
                 ("LIFE PARTNER", "MARRIED"), ("MARRIED", "MARRIED"))
INSURANCE_RULES = (("Government", "GOVERNMENT"), ("Private", "PRIVATE"), ("Self Pay", "SELF PAY"),
                   ("Medicare", "MEDICARE/MEDICAID"), ("Medicaid", "MEDICARE/MEDICAID"))
ADMISSION_LOCATION_RULES = (("REFERRAL", "REFERRAL"), ("EMERGENCY", "EMERGENCY"), ("TRANSFER", "TRANSFER"), ("TRSF", "TRANSFER"))
DIAGNOSIS_RULES = (("SEPSIS", "SEPSIS"),)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_match(col, needles, other: str = "OTHER", labels=None) -> Column:
    """Label of the first needle contained in ``col``; NULL → ``other``."""
    c = _c(col)
    labels = labels or needles
    out = None
    for n, lab in zip(needles, labels):
        cond = F.coalesce(c.contains(n), F.lit(False))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(other))


def categorize_ethnicity(col, with_native: bool = False) -> Column:
    order = ETHNICITY_ORDER_WITH_NATIVE if with_native else ETHNICITY_ORDER
    return first_match(col, order, labels=[ETHNICITY_LABELS.get(n, n) for n in order])


def by_rules(col, rules, other: str = "OTHER") -> Column:
    """group of the first rule (needle, group) that fits."""
    return first_match(col, [n for n, _ in rules], other, [g for _, g in rules])


def categorize_age(col) -> Column:
    """(10,30] is <31, (30,50] 31-50, (50,70] 51-70, else >70 — ages ≤ 10 fall in the last bucket."""
    c = _c(col)
    out = None
    for lo, hi, name in AGE_BUCKETS:
        cond, lab = (c > lo) & (c <= hi), F.lit(name)
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out.otherwise(F.lit(">70"))


def age_band_strict(col) -> Column:
    """Strict bands (0,45),(45,65),(65,90),(90,500); boundary ages match none."""
    c = _c(col)
    out = None
    for lo, hi in AGE_BANDS_STRICT:
        cond = (c > lo) & (c < hi)
        lab = F.lit(f"{lo}-{hi}")
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


def flag(cond: Column) -> Column:
    """Boolean condition as a 0/1 int flag; NULL → 0."""
    return F.when(cond, 1).otherwise(0).cast("int")
