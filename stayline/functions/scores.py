"""Clinical score expressions (F12, F15, F16, F17) as plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Specimen-type logistic model — intercept, then per input
# (name, coefficient, mean used when the input is missing, offset).
SPECIMEN_INTERCEPT = -0.02544
SPECIMEN_PO2_COEF = 0.04598
SPECIMEN_TERMS = (
    ("spo2", -0.15356, 97.49420, 0.13429),
    ("fio2_chartevents", 0.00621, 51.49550, -0.24958),
    ("hemoglobin", 0.10559, 10.32307, 0.05954),
    ("so2", 0.13251, 93.66539, -0.23172),
    ("pco2", -0.01511, 42.08866, -0.01630),
    ("fio2", 0.01480, 63.97836, -0.31142),
    ("aado2", -0.00200, 442.21186, -0.01328),
    ("bicarbonate", -0.03220, 22.96894, -0.06535),
    ("totalco2", 0.05384, 24.72632, -0.01405),
    ("lactate", 0.08202, 3.06436, 0.06038),
    ("ph", 0.10956, 7.36233, -0.00617),
    ("o2flow", 0.00848, 7.59362, -0.35803),
)
SPECIMEN_THRESHOLD = 0.75
ATMOSPHERIC_MINUS_WATER = 760 - 47


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def logistic_score(intercept: float, linear: list[tuple[float, Column]],
                   defaulted: list[tuple[float, Column | None, float, float]]) -> Column:
    """1 / (1 + exp(-(b0 + Σ b·x + Σ coalesce(b·x, b·mean + offset))))."""
    z = F.lit(intercept)
    for b, x in linear:
        z = z + F.lit(b) * x
    for b, x, mean, off in defaulted:
        fallback = F.lit(b * mean + off)
        z = z + (fallback if x is None else F.coalesce(F.lit(b) * x, fallback))
    return 1 / (1 + F.exp(-z))


def specimen_probability(cols: dict[str, Column]) -> Column:
    """Probability that a blood gas is arterial; inputs missing from ``cols``
    count as NULL."""
    return logistic_score(SPECIMEN_INTERCEPT, [(SPECIMEN_PO2_COEF, cols["po2"])],
                          [(b, cols.get(n), m, o) for n, b, m, o in SPECIMEN_TERMS])


def aado2(po2: Column, pco2: Column, fio2: Column, fio2_chart: Column) -> Column:
    """A–a gradient, lab FiO2 preferred over charted (F16)."""
    f = lambda x: (x / 100) * ATMOSPHERIC_MINUS_WATER - (pco2 / 0.8) - po2
    return (F.when(po2.isNull() | pco2.isNull(), F.lit(None))
            .when(fio2.isNotNull(), f(fio2)).when(fio2_chart.isNotNull(), f(fio2_chart)))


def pf_ratio(po2: Column, fio2: Column, fio2_chart: Column) -> Column:
    """P/F ratio 100·PO2/FiO2 (F16)."""
    return (F.when(po2.isNull(), F.lit(None)).when(fio2.isNotNull(), 100 * po2 / fio2)
            .when(fio2_chart.isNotNull(), 100 * po2 / fio2_chart))


def bmi(weight: Column, height_cm: Column) -> Column:
    """weight / (height/100)^2 when both known."""
    return F.when(weight.isNotNull() & height_cm.isNotNull(), weight / ((height_cm / 100) * (height_cm / 100)))


def impute_from_percent(absolute: Column, percent: Column, total: Column, available: Column, digits: int = 4) -> Column:
    """Differential count: % · total when the absolute value is missing and
    the availability flag is set (F17)."""
    from stayline.functions.numbers import round_numeric
    return F.when(absolute.isNull() & (available == 1), round_numeric(percent * total / 100, digits)).otherwise(absolute)
