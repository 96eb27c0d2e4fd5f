"""Derived columns: bands, a ratio, a scaled product and a score that counts raised readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import band, points, ratio, scaled_product


@dataclass(frozen=True)
class Derivations:
    """What to derive; an entry whose source column is absent is left out of the result."""

    bands: Mapping[str, tuple[str, Sequence[float], Sequence[str]]] = field(default_factory=dict)
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    products: Mapping[str, tuple[str, str, float]] = field(default_factory=dict)
    score: str | None = None
    score_tests: Mapping[str, float] = field(default_factory=dict)


# Clinical band edges and labels, the divisor of the insulin-resistance proxy and the
# four thresholds of the risk score.
CLINICAL_DERIVATIONS = Derivations(
    bands={
        "BMI_Category": ("BMI", (18.5, 24.9, 29.9), ("Underweight", "Normal", "Overweight", "Obese")),
        "Glucose_Risk": ("Glucose", (139.9, 199.9), ("Normal", "Prediabetes", "Diabetes_Range")),
        "Age_Group": ("Age", (29.9, 49.9), ("Young", "Middle", "Senior")),
    },
    ratios={"Pregnancy_Rate": ("Pregnancies", "Age")},
    products={"HOMA_IR_Proxy": ("Glucose", "Insulin", 405.0)},
    score="Metabolic_Risk_Score",
    score_tests={"Glucose": 140, "BloodPressure": 85, "BMI": 30.0, "Age": 45},
)


def derive(df: DataFrame, plan: Derivations = CLINICAL_DERIVATIONS) -> DataFrame:
    """All derived columns in one projection."""
    have = set(df.columns)
    out = {}
    for name, (source, edges, labels) in plan.bands.items():
        if source in have:
            out[name] = band(F.col(source), edges, labels)
    for name, (top, bottom) in plan.ratios.items():
        if {top, bottom} <= have:
            out[name] = ratio(F.col(top), F.col(bottom))
    for name, (left, right, divisor) in plan.products.items():
        if {left, right} <= have:
            out[name] = scaled_product(F.col(left), F.col(right), divisor)
    if plan.score:
        out[plan.score] = points({c: t for c, t in plan.score_tests.items() if c in have})
    return df.withColumns(out)
