"""Statistical profile of a table: one aggregate pass for all columns, quantiles from their own fit."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import class_label, is_missing, nan_to_null, severity
from .moments import column_moments, pearson
from .quantiles import column_quantiles, group_quantiles
from .shape import batched_rows, rows_of

NUMERIC_TYPES = ("byte", "short", "integer", "long", "float", "double", "decimal")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC_TYPES and f.name not in exclude]


def _number(value: float | None) -> Column:
    return F.lit(None if value is None else float(value)).cast("double")


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def _floats(values) -> list[float | None]:
    return [None if v is None else float(v) for v in values]


def _centre(value) -> float:
    """A finite number to measure distances from."""
    return float(value) if value is not None and math.isfinite(value) else 0.0


def numbers(df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """The columns as doubles, NaN as NULL; an integer column cannot hold NaN and is only cast."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return df.select(
        *[
            (nan_to_null(F.col(c)) if kinds[c] in ("float", "double") else F.col(c).cast("double")).alias(c)
            for c in columns
        ],
        *extra,
    )


def summary_statistics(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3, mode: str = "exact", **limits
) -> DataFrame:
    """Count, mean, std, five-number summary, biased skewness and excess kurtosis, zeros and NULLs.

    Besides the quantiles, one scan for all columns: it sums powers of the distance to the median, which is at most
    one standard deviation from the mean, and the moments about the mean follow from them.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    values = numbers(df, columns)
    fits = column_quantiles(values, columns, [0.25, 0.5, 0.75], mode, **limits)
    spine = [(0, i, c, fits[c].count, *_floats(fits[c].values)) for i, c in enumerate(columns)]
    table = df.sparkSession.createDataFrame(
        spine, "g int, i int, feature string, present long, q25 double, median double, q75 double"
    )
    centres = [_centre(fits[c].values[1]) for c in columns]
    sums = column_moments(values, columns, centres, centres, centres, table)
    n, shift = F.col("present"), F.col("s1") / F.col("present")
    s2 = F.col("s2") - F.col("s1") * shift
    s3 = F.col("s3") - 3 * shift * F.col("s2") + 2 * n * shift * shift * shift
    s4 = F.col("s4") - 4 * shift * F.col("s3") + 6 * shift * shift * F.col("s2") - 3 * n * F.pow(shift, F.lit(4))
    powers = {"p2": s2, "p3": s3, "p4": s4, "mean": F.col("median") + shift}
    wide = sums.withColumns({k: F.when(n > 0, e) for k, e in powers.items()})
    enough, total, zeros = (n > 2) & (F.col("p2") > 0), F.col("seen"), F.col("zeros").cast("bigint")
    rounded = lambda e, name: F.round(e, digits).alias(name)
    return wide.select(
        "feature",
        "present",
        rounded(F.col("mean"), "mean"),
        rounded(F.when(n > 1, F.sqrt(F.col("p2") / (n - 1))), "std"),
        rounded(F.col("low"), "min"),
        *[rounded(F.col(c), c) for c in ("q25", "median", "q75")],
        rounded(F.col("high"), "max"),
        rounded(F.when(enough, F.sqrt(n) * F.col("p3") / F.pow("p2", F.lit(1.5))), "skewness"),
        rounded(F.when(enough, n * F.col("p4") / (F.col("p2") * F.col("p2")) - 3), "kurtosis"),
        zeros.alias("zero_count"),
        F.round(_percent(zeros, total), 2).alias("zero_pct"),
        (total - n).alias("null_count"),
        F.round(_percent(total - n, total), 2).alias("null_pct"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """The short form: count, mean, std, min, quartiles, max."""
    wide = summary_statistics(df, columns, **options)
    return wide.select("feature", "present", "mean", "std", "min", "q25", "median", "q75", "max")


def column_info(df: DataFrame) -> DataFrame:
    """Name, type and number of present values of every column."""
    types = dict(df.dtypes)
    one = df.agg(*[F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return rows_of(
        one,
        [
            {"column_no": F.lit(i + 1), "field": F.lit(c), "type": F.lit(types[c]), "present": F.col(f"n{i}")}
            for i, c in enumerate(df.columns)
        ],
    )


def corrected_skewness(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Skewness with the small-sample correction."""
    aggs, rows = [], []
    for i, name in enumerate(columns):
        c = nan_to_null(F.col(name))
        aggs += [F.skewness(c).alias(f"s{i}"), F.count(c).cast("double").alias(f"n{i}")]
        n = F.col(f"n{i}")
        corrected = F.when(n > 2, F.col(f"s{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        rows.append({"feature": F.lit(name), "skewness": F.round(corrected, digits)})
    return rows_of(df.agg(*aggs), rows)


def missingness(raw: DataFrame, zero_columns: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Zeros against NULLs per column, and which of the two means missing."""
    columns = [c for c in raw.columns if c not in exclude]
    kinds = {f.name: f.dataType.typeName() for f in raw.schema.fields}
    aggs, rows = [F.count(F.lit(1)).alias("all")], []
    for i, name in enumerate(columns):
        zero = (F.col(name) == 0) if kinds[name] in NUMERIC_TYPES else F.lit(False)
        aggs += [F.count_if(zero).alias(f"z{i}"), F.count_if(is_missing(raw, name)).alias(f"m{i}")]
        hidden = name in zero_columns
        missing = F.col(f"z{i}") if hidden else F.col(f"m{i}")
        rows.append(
            {
                "feature": F.lit(name),
                "total_rows": F.col("all"),
                "zero_count": F.col(f"z{i}"),
                "disguised": F.lit(hidden),
                "missing_count": missing,
                "missing_pct": F.round(_percent(missing, F.col("all")), 2),
            }
        )
    return rows_of(raw.agg(*aggs), rows)


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing percentage per column with its severity, worst first."""
    one = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)])
    percent = [F.col(f"m{i}") * 100 for i in range(len(columns))]
    rows = [
        {"feature": F.lit(c), "missing_pct": F.round(p, 2), "severity": severity(p)}
        for c, p in zip(columns, percent)
    ]
    return rows_of(one, rows).orderBy(F.desc("missing_pct"), "feature")


def before_after(
    raw: DataFrame, cleaned: DataFrame, zero_columns: Sequence[str], exclude: Sequence[str] = ()
) -> DataFrame:
    """Missing cells before cleaning next to what is left afterwards, per column."""
    first = missingness(raw, zero_columns, exclude)
    names = [c for c in raw.columns if c not in exclude and c in cleaned.columns]
    one = cleaned.agg(*[F.count_if(is_missing(cleaned, c)).alias(f"m{i}") for i, c in enumerate(names)])
    second = rows_of(one, [{"feature": F.lit(c), "null_after": F.col(f"m{i}")} for i, c in enumerate(names)])
    return first.join(second, "feature", "left")


def group_statistics(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    groups: Sequence = (0, 1),
    digits: int = 2,
    mode: str = "exact",
    **limits,
) -> DataFrame:
    """Mean, median and interquartile range of every column in every group, one row per column."""
    fits = group_quantiles(df, columns, [0.25, 0.5, 0.75], target, groups, mode, **limits)
    aggs, rows = [], []
    for i, name in enumerate(columns):
        row = {"feature": F.lit(name)}
        for g in groups:
            here = nan_to_null(F.when(F.col(target) == F.lit(g), F.col(name)))
            aggs.append(F.avg(here).alias(f"a{i}_{g}"))
            q25, median, q75 = fits[g, name].values
            spread = None if q25 is None else q75 - q25
            row[f"mean_{g}"] = F.round(F.col(f"a{i}_{g}"), digits)
            row[f"median_{g}"] = F.round(_number(median), digits)
            row[f"iqr_{g}"] = F.round(_number(spread), digits)
        rows.append(row)
    return rows_of(df.agg(*aggs), rows)


def outlier_fences(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, digits: int = 2, mode: str = "exact", **limits
) -> DataFrame:
    """Quartile fences (the lower one may be negative) and how many present values lie beyond them."""
    fits = column_quantiles(df, columns, [0.25, 0.75], mode, **limits)
    aggs, rows = [], []
    for i, name in enumerate(columns):
        c, fit = nan_to_null(F.col(name)), fits[name]
        low, high = fit.values
        if fit.count:
            reach = multiplier * (high - low)
            fences = (low - reach, high + reach)
            beyond = (c < F.lit(fences[0])) | (c > F.lit(fences[1]))
        else:
            reach, fences, beyond = None, (None, None), F.lit(False)
        aggs += [F.count_if(beyond).alias(f"o{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}")]
        rows.append(
            {
                "feature": F.lit(name),
                "q25": F.round(_number(low), digits),
                "q75": F.round(_number(high), digits),
                "iqr": F.round(_number(None if low is None else high - low), digits),
                "lower_fence": F.round(_number(fences[0]), digits),
                "upper_fence": F.round(_number(fences[1]), digits),
                "outlier_count": F.col(f"o{i}"),
                "outlier_pct": F.round(_percent(F.col(f"o{i}"), F.lit(fit.count)), 2),
                "min_value": F.round(F.col(f"min{i}"), digits),
                "max_value": F.round(F.col(f"max{i}"), digits),
            }
        )
    return rows_of(df.agg(*aggs), rows)


def class_balance(df: DataFrame, target: str, positive: str | None = None, negative: str | None = None) -> DataFrame:
    """Records and share per class; with labels, a missing target counts as the negative label."""
    if positive is None:
        counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("records"))
    else:
        label = class_label(F.col(target), positive, negative).alias("class")
        counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records").cast("double")).scalar()
    return counts.withColumn("share", F.col("records") / total)


def crosstab(df: DataFrame, column: str, target: str, classes: Sequence = (0, 1), digits: int = 6) -> DataFrame:
    """Share of every class inside each level, in percent; a missing level is left out."""
    known = df.where(F.col(column).isNotNull() & F.col(target).isin(*classes))
    counts = known.groupBy(column).agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col(target) == F.lit(c)).alias(f"n_{c}") for c in classes],
    )
    shares = [F.round(_percent(F.col(f"n_{c}"), F.col("records")), digits).alias(f"pct_{c}") for c in classes]
    return counts.select(column, *shares)


def correlation(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson r of every ordered pair over the rows where both are present, from one scan."""
    return pearson(numbers(df, columns), columns, digits)


#: column pairs handled in one aggregate
PAIRS_PER_SCAN = 15


def correlation_of(df: DataFrame, pairs, columns: Sequence[str], digits: int) -> DataFrame:
    """``pairs`` maps (row, column) to the two expressions; each unordered pair is computed once."""
    entries = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns[i:], start=i):
            left, right = pairs[a, b]
            value = F.corr(left, right) if i != j else F.when(F.min(left) < F.max(left), F.lit(1.0))
            out = F.round(F.nanvl(F.col(f"r{i}_{j}"), F.lit(None).cast("double")), digits)
            rows = [
                {"row_field": F.lit(x), "column_field": F.lit(y), "correlation": out}
                for x, y in sorted({(a, b), (b, a)})
            ]
            entries.append(([value.alias(f"r{i}_{j}")], rows))
    return batched_rows(df, entries, PAIRS_PER_SCAN)


def box_statistics(
    df: DataFrame,
    columns: Sequence[str],
    by: str | None = None,
    groups: Sequence | None = None,
    mode: str = "exact",
    **limits,
) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 interquartile ranges, outliers, extremes, mean."""
    if by is None:
        fits = {(None, c): f for c, f in column_quantiles(df, columns, [0.25, 0.5, 0.75], mode, **limits).items()}
    else:
        fits = group_quantiles(df, columns, [0.25, 0.5, 0.75], by, groups, mode, **limits)
    # every group and column once; a reach of NaN takes nothing in
    order = list(groups) if by is not None else [None]
    spine, centres, floors, ceilings = [], [], [], []
    for g, group in enumerate(order):
        for i, name in enumerate(columns):
            fit = fits[group, name]
            q1, median, q3 = _floats(fit.values)
            reach = 1.5 * (q3 - q1) if fit.count else math.nan
            centres.append(_centre(median))
            floors.append(q1 - reach if fit.count else math.nan)
            ceilings.append(q3 + reach if fit.count else math.nan)
            spine.append((g, i, group, name, q1, median, q3))
    kind = df.schema[by].dataType.simpleString() if by is not None else "string"
    table = df.sparkSession.createDataFrame(
        spine, f"g int, i int, _group {kind}, field string, q1 double, median double, q3 double"
    )
    member = None
    if by is not None:
        member = F.lit(None).cast("int")
        for g, group in reversed(list(enumerate(order))):
            member = F.when(F.col(by) == F.lit(group), F.lit(g)).otherwise(member)
    values = numbers(df, columns, [] if member is None else [member.alias("_member")])
    sums = column_moments(
        values, columns, centres, floors, ceilings, table, None if member is None else F.col("_member")
    )
    return sums.select(
        *([] if by is None else [F.col("_group").alias(by)]),
        "field",
        "q1",
        "median",
        "q3",
        F.coalesce("low_inside", "q1").alias("lower"),
        F.coalesce("high_inside", "q3").alias("upper"),
        (F.col("n") - F.col("inside")).cast("bigint").alias("outliers"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        F.when(F.col("n") > 0, F.col("median") + F.col("s1") / F.col("n")).alias("mean"),
    )
