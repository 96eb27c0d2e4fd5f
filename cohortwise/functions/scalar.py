"""Row-level column expressions. All are built-in Spark expressions and stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(column: Column) -> Column:
    """A double with NaN replaced by NULL, since Spark orders NaN above every number."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def is_missing(df: DataFrame, name: str) -> Column:
    """Whether a cell has no reading: NULL, or NaN in a floating-point column."""
    floating = df.schema[name].dataType.typeName() in ("float", "double")
    return (F.col(name).isNull() | F.isnan(F.col(name))) if floating else F.col(name).isNull()


def reading(column: Column) -> Column:
    """A numeric column of any type with NaN replaced by NULL."""
    return F.when(~F.isnan(column), column)


def zero_to_null(column: Column) -> Column:
    """A disguised zero, or NaN, becomes NULL; every other reading is kept as a double."""
    return F.nullif(nan_to_null(column), F.lit(0.0))


def clip(column: Column, low: float | None, high: float | None) -> Column:
    """Limit to [low, high]; NULL and NaN give NULL, which ``least``/``greatest`` would turn into a bound."""
    column = out = reading(column)
    if high is not None:
        out = F.when(column > F.lit(high), F.lit(high)).otherwise(out)
    if low is not None:
        out = F.when(column < F.lit(low), F.lit(low)).otherwise(out)
    return out


def band(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands: ``x <= edges[0]`` is ``labels[0]``, beyond the last edge ``labels[-1]``."""
    if len(labels) != len(edges) + 1:
        raise ValueError("a band needs one label more than it has edges")
    column = reading(column)
    out = F.when(column <= F.lit(float(edges[0])), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(column <= F.lit(float(edge)), F.lit(label))
    return out.when(column.isNotNull(), F.lit(labels[-1]))


def interval_number(column: Column, edges: Sequence[float]) -> Column:
    """1-based number of the right-closed interval of ``edges``; the lowest edge belongs to interval 1.

    Values outside the outer edges, and NULL, give NULL.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    column = reading(column)
    out = F.when((column < F.lit(edges[0])) | (column > F.lit(edges[-1])), F.lit(None).cast("int"))
    for number, edge in enumerate(edges[1:], start=1):
        out = out.when(column <= F.lit(edge), F.lit(number))
    return out


def ratio(numerator: Column, denominator: Column) -> Column:
    """A double quotient that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(nan_to_null(numerator), nan_to_null(denominator))


def scaled_product(left: Column, right: Column, divisor: float) -> Column:
    return nan_to_null(left) * nan_to_null(right) / F.lit(float(divisor))


def reached(column: Column, threshold: float) -> Column:
    """1 when the reading reaches the threshold; a missing reading never does."""
    return F.coalesce(reading(column) >= F.lit(threshold), F.lit(False)).cast("int")


def points(tests: Mapping[str, float]) -> Column:
    """Number of columns that reach their threshold."""
    total = F.lit(0)
    for name, threshold in tests.items():
        total = total + reached(F.col(name), threshold)
    return total


def class_label(target: Column, positive: str, negative: str) -> Column:
    return F.when(target == 1, F.lit(positive)).otherwise(F.lit(negative))


def position_in_range(column: Column, low: float, high: float) -> Column:
    """0 at the declared minimum, 1 at the declared maximum."""
    return (nan_to_null(column) - F.lit(float(low))) / F.lit(float(high) - float(low))


def decide(probability: Column, threshold: float) -> Column:
    return (nan_to_null(probability) >= F.lit(float(threshold))).cast("int")


def display_id(key: Column, pattern: str = "#P-%03d") -> Column:
    return F.format_string(pattern, key)


def severity(percent: Column) -> Column:
    """How serious a missing percentage is: above 20 high, above 5 medium, else low."""
    return F.when(percent > 20, "high").when(percent > 5, "medium").otherwise("low")


def p_value_text(p: Column) -> Column:
    """Scientific below 0.001, otherwise four decimals."""
    return F.when(p < 0.001, F.format_string("%.2e", p)).otherwise(F.round(p, 4).cast("string"))
