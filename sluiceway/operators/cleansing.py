"""Cleansing of raw text columns and cutting of fixed-width lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.cleansing import Rule, cleanse
from sluiceway.functions.names import column

# Fixed values: (first character, length) of the fields of a raw line.
RAW_LINE_FIELDS = ((1, 3), (4, 50), (54, 6), (60, 50), (110, 6), (116, 50))


def cleanse_columns(
    df: DataFrame,
    names: Sequence[str],
    charset: str = "utf-8",
    rules: Sequence[Rule] | None = None,
    raw: bool = True,
) -> DataFrame:
    """Apply the character rules of a charset, or the given ones, to text columns."""
    return df.withColumns({n: cleanse(column(n), charset, rules, raw) for n in names})


def cut_fields(
    df: DataFrame,
    fields: Sequence[tuple[int, int]] = RAW_LINE_FIELDS,
    names: Sequence[str] | None = None,
    line: str = "value",
    trim: bool = False,
) -> DataFrame:
    """Cut a line column into fields by first character and length."""
    names = names or [f"col_{i}" for i in range(1, len(fields) + 1)]

    def cut(start: int, length: int):
        text = F.substring(column(line), start, length)
        return F.trim(text) if trim else text

    return df.select(*[cut(*place).alias(name) for place, name in zip(fields, names, strict=True)])
