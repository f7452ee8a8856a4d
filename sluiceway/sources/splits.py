"""Ranges of a column that hold about equally many rows, for reading a remote table side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.names import column, quoted

# Rows of a range are off by this share of all rows at most.
ACCURACY = 10_000


def derived_ranges(rows: DataFrame, name: str, parts: int) -> list[str]:
    """Conditions on a column, of which every row meets exactly one: `parts` ranges at most, and NULL.

    `rows` are all rows, or a sample of them: then the ranges are as even as the sample, and still miss no row. Bounds
    are quantiles from one mergeable sketch. A value more frequent than a range has rows ends one, since a value can't
    be cut. Numbers, dates and timestamps only.
    """
    if parts < 1:
        raise ValueError(f"{parts} parts")
    kind = rows.schema[name].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        raise TypeError(f"column {name} is {kind.simpleString()}, which has no quantiles")
    text = quoted(name)
    if parts == 1:
        return [f"{text} IS NOT NULL", f"{text} IS NULL"]
    shares = [i / parts for i in range(1, parts)]
    cell = column(name)
    # NaN is above every number, so it is in the last range without being a bound.
    real = F.when(~F.isnan(cell), cell) if isinstance(kind, (T.DoubleType, T.FloatType)) else cell
    found = rows.agg(F.transform(F.percentile_approx(real, shares, ACCURACY), lambda b: b.cast("string")).alias("b")).first().b
    prefix = {T.DateType: "DATE ", T.TimestampType: "TIMESTAMP "}.get(type(kind))
    bounds = [f"{prefix}'{b}'" if prefix else b for b in dict.fromkeys(found or [])]
    if not bounds:
        return [f"{text} IS NOT NULL", f"{text} IS NULL"]
    between = [f"{text} >= {low} AND {text} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{text} < {bounds[0]}", *between, f"{text} >= {bounds[-1]}", f"{text} IS NULL"]
