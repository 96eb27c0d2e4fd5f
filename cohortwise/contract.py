"""Field contracts: what a table must contain, in which range, and where a zero hides a missing reading.

A contract travels as a ``StructType`` whose field metadata carries the ranges, so it can be stored
with a table or passed to ``spark.read.schema``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

_SPARK_TYPES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "categorical": T.StringType(),
    "binary": T.IntegerType(),
}


@dataclass(frozen=True)
class Field:
    """One column of a contract. ``kind`` is int, float, categorical or binary."""

    name: str
    kind: str
    low: float | None = None
    high: float | None = None
    decimals: int = 2
    unit: str = ""
    definition: str = ""
    zero_valid: bool = True
    values: tuple[str, ...] = ()
    positive_rate: float | None = None

    @property
    def numeric(self) -> bool:
        return self.kind in ("int", "float")

    def struct_field(self) -> T.StructField:
        meta: dict[str, Any] = {
            "kind": self.kind,
            "decimals": self.decimals,
            "unit": self.unit,
            "definition": self.definition,
            "zero_valid": self.zero_valid,
        }
        if self.low is not None:
            meta["min"] = float(self.low)
        if self.high is not None:
            meta["max"] = float(self.high)
        if self.values:
            meta["values"] = list(self.values)
        if self.positive_rate is not None:
            meta["positive_rate"] = self.positive_rate
        return T.StructField(self.name, _SPARK_TYPES[self.kind], True, meta)

    @staticmethod
    def from_struct_field(sf: T.StructField) -> "Field":
        meta = sf.metadata
        return Field(
            name=sf.name,
            kind=meta["kind"],
            low=meta.get("min"),
            high=meta.get("max"),
            decimals=meta.get("decimals", 2),
            unit=meta.get("unit", ""),
            definition=meta.get("definition", ""),
            zero_valid=meta.get("zero_valid", True),
            values=tuple(meta.get("values", ())),
            positive_rate=meta.get("positive_rate"),
        )


@dataclass(frozen=True)
class Contract:
    """Ordered features plus the binary target they explain."""

    features: tuple[Field, ...]
    target: Field
    key: str | None = None
    rows_expected: int | None = None
    sha256: str | None = field(default=None, compare=False)

    def __getitem__(self, name: str) -> Field:
        for item in (*self.features, self.target):
            if item.name == name:
                return item
        raise KeyError(name)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    @property
    def required(self) -> list[str]:
        return [*self.names, self.target.name]

    @property
    def numeric(self) -> list[str]:
        return [f.name for f in self.features if f.numeric]

    @property
    def disguised(self) -> list[str]:
        """Fields in which a zero stands for a missing reading."""
        return [f.name for f in self.features if f.numeric and not f.zero_valid]

    @property
    def positive_minimum(self) -> list[str]:
        """Fields whose declared minimum rules a zero out."""
        return [f.name for f in self.features if f.numeric and f.low is not None and f.low > 0]

    def struct(self, key_type: T.DataType | None = None) -> T.StructType:
        head = [T.StructField(self.key, key_type or T.LongType(), False)] if self.key else []
        return T.StructType(head + [f.struct_field() for f in (*self.features, self.target)])

    @staticmethod
    def from_struct(schema: T.StructType, target: str, key: str | None = None) -> "Contract":
        fields = {f.name: Field.from_struct_field(f) for f in schema.fields if f.metadata.get("kind")}
        return Contract(
            features=tuple(f for name, f in fields.items() if name != target),
            target=fields[target],
            key=key,
        )


# The clinical table's columns, order, declared ranges, decimals, units and the
# columns in which a zero is a missing reading.
CLINICAL = Contract(
    features=(
        Field("Pregnancies", "int", 0, 17, unit="count", definition="Number of times pregnant"),
        Field("Glucose", "float", 44.0, 200.0, 1, "mg/dL", "2-hour plasma glucose concentration", False),
        Field("BloodPressure", "float", 24.0, 122.0, 1, "mm Hg", "Diastolic blood pressure", False),
        Field("SkinThickness", "float", 7.0, 99.0, 1, "mm", "Triceps skin fold thickness", False),
        Field("Insulin", "float", 14.0, 846.0, 1, "mu U/ml", "2-hour serum insulin", False),
        Field("BMI", "float", 18.0, 67.1, 1, "kg/m2", "Body mass index", False),
        Field("DiabetesPedigreeFunction", "float", 0.07, 2.42, 3, "score", "Genetic risk score"),
        Field("Age", "int", 21, 81, unit="years", definition="Age in years"),
    ),
    target=Field("Outcome", "binary", positive_rate=0.349, definition="1 when diagnosed, 0 otherwise"),
    rows_expected=768,
    sha256="b78029447fae2743b3218bb2b76ef0d04afe8d7e55ce2faf4d1ec82d8f8ae8ac",
)
