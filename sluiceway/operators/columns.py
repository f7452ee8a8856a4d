"""Operators that add, drop, rename, clean or cast columns.

All of them are narrow: one projection each, no shuffle, whatever the number of
columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.casts import lenient_cast
from sluiceway.functions.names import column
from sluiceway.functions.types import WHOLE_TIMES, parse_type, type_class

# Names of the audit and run columns.
AUDIT_PERIOD = "fecinfo"
AUDIT_BATCH = "batch_id"
AUDIT_TIME = "load_ts"
RUN_PERIOD = "fecinformacion"


def null_to_empty(df: DataFrame) -> DataFrame:
    """NULL becomes '' in every string column."""

    def filled(field: T.StructField):
        value = column(field.name)
        return F.coalesce(value, F.lit("")) if isinstance(field.dataType, T.StringType) else value

    return df.select(*[filled(f).alias(f.name) for f in df.schema.fields])


def clean_blanks(
    df: DataFrame,
    dest_types: Mapping[str, str],
    null_to_empty: bool = False,
    classify: str = "catalog",
) -> DataFrame:
    """Prepare NULL and blank values for the destination's types.

    Bound for a string column, NULL becomes '' when ``null_to_empty`` is set.
    Bound for any other type, text without a visible character becomes NULL.
    """

    def cleaned(field: T.StructField):
        value = column(field.name)
        kind = type_class(dest_types[field.name], classify) if field.name in dest_types else None
        is_text = isinstance(field.dataType, T.StringType)
        if kind == "string" and null_to_empty:
            return F.coalesce(value if is_text else value.cast("string"), F.lit(""))
        if kind == "other" and is_text:
            return F.when(F.trim(value) != "", value)
        return value

    return df.select(*[cleaned(f).alias(f.name) for f in df.schema.fields])


def cast_to_destination(
    df: DataFrame, dest_types: Mapping[str, str], dialect: str = "destination"
) -> DataFrame:
    """Cast every column the destination knows; what does not fit becomes NULL."""
    return df.select(
        *[
            lenient_cast(column(f.name), f.dataType, parse_type(dest_types[f.name], dialect)).alias(f.name)
            if f.name in dest_types
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def align_by_position(
    df: DataFrame, destination: Sequence[tuple[str, str]], dialect: str = "destination"
) -> DataFrame:
    """Give the i-th column the i-th destination name.

    Extra columns are cut; missing ones are padded with NULL of the
    destination's type, because a JDBC sink cannot write an untyped NULL.
    """
    places = [f"_{i}" for i in range(len(df.columns))]
    kept = [F.col(p).alias(name) for p, (name, _) in zip(places, destination)]
    padded = [
        F.lit(None).cast(parse_type(text, dialect)).alias(name)
        for name, text in destination[len(kept):]
    ]
    return df.toDF(*places).select(*kept, *padded)


def align_by_name(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Destination order, unknown columns dropped, nothing padded.

    With no name in common the frame is returned as it is.
    """
    common = [n for n in names if n in df.columns]
    return df.select(*map(column, common)) if common else df


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in listed order; at least one must."""
    kept = [n for n in names if n in df.columns]
    if not kept:
        raise ValueError(f"none of {list(names)} is a column of {df.columns}")
    return df.select(*map(column, kept))


def add_audit_columns(
    df: DataFrame, period: str | None = None, batch_id: int | str | None = None
) -> DataFrame:
    """Add the run's period, batch and load time; columns already there are only cast."""
    values = {
        AUDIT_PERIOD: (F.lit("" if period is None else str(period)), "string"),
        AUDIT_BATCH: (F.lit(-1 if batch_id is None else int(batch_id)), "int"),
        AUDIT_TIME: (F.current_timestamp(), "timestamp"),
    }
    return df.withColumns(
        {
            name: (column(name) if name in df.columns else value).cast(type_name)
            for name, (value, type_name) in values.items()
        }
    )


def run_partitions(df: DataFrame, batch_id: str | None, period: str | None) -> dict[str, str]:
    """Batch and period as columns to add and partition by, those the frame lacks."""
    values = {AUDIT_BATCH: batch_id, RUN_PERIOD: period}
    return {
        name: str(value)
        for name, value in values.items()
        if value is not None and name not in df.columns
    }


def add_run_partitions(df: DataFrame, batch_id: str | None, period: str | None) -> DataFrame:
    """Add batch and period as constant columns; a column already there is not replaced."""
    added = run_partitions(df, batch_id, period)
    return df.withColumns({name: F.lit(value) for name, value in added.items()}) if added else df


def add_period_for_table(
    df: DataFrame, partition_columns: Sequence[str], period: str | None
) -> DataFrame:
    """Add the run's period when the table is partitioned by it and the frame lacks it."""
    wanted = RUN_PERIOD in (c.lower() for c in partition_columns)
    present = RUN_PERIOD in (c.lower() for c in df.columns)
    if wanted and not present and period is not None:
        return df.withColumn(RUN_PERIOD, F.lit(str(period)))
    return df


def match_column_case(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename columns that differ from the given names only by case."""
    present = {c.lower(): c for c in df.columns}
    renames = {
        present[n.lower()]: n
        for n in names
        if n.lower() in present and present[n.lower()] != n
    }
    return df.withColumnsRenamed(renames) if renames else df


def rows_to_json(df: DataFrame, name: str = "value") -> DataFrame:
    """One JSON text per row; NULL fields are left out of it, times keep their microseconds."""
    return df.select(F.to_json(F.struct(*map(column, df.columns)), WHOLE_TIMES).alias(name))


def join_fields(df: DataFrame, delimiter: str = "~|~", name: str = "value") -> DataFrame:
    """One text per row with every field in place; NULL is an empty field."""
    fields = [F.coalesce(column(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(delimiter, *fields).alias(name))


def require_header(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Check the column names, whatever their case, and put them in declared order."""
    present = {c.lower(): c for c in df.columns}
    declared = [c.lower() for c in expected]
    missing = [c for c in declared if c not in present]
    surplus = [c for c in present if c not in declared]
    if missing or surplus:
        raise ValueError(f"header check failed: missing {missing}, not declared {surplus}")
    return df.select(*[column(present[low]).alias(name) for low, name in zip(declared, expected)])
