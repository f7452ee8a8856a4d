"""Sink for tables of Spark's catalog, and the catalog inventory."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.names import column, is_yes, quoted
from sluiceway.operators.columns import add_period_for_table, match_column_case
from sluiceway.operators.protection import Method, protect_columns
from sluiceway.sinks.files import Tap, no_tap, write_files


def _full_name(schema: str, table: str) -> str:
    return f"{quoted(schema)}.{quoted(table)}"


def table_columns(spark: SparkSession, schema: str, table: str) -> list[tuple[str, str, bool]]:
    """(name, type, is partition column) of a table, in its order."""
    found = spark.catalog.listColumns(_full_name(schema, table))
    return [(c.name, c.dataType, c.isPartition) for c in found]


def table_inventory(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema, by name."""
    return spark.sql(f"SHOW TABLES IN {quoted(schema)}").where(~F.col("isTemporary")).select("tableName")


def _described(spark: SparkSession, schema: str, table: str, what: str) -> str | None:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {_full_name(schema, table)}")
    row = about.where((F.col("col_name") == what) & (F.col("data_type") != "")).first()
    return row["data_type"] if row else None


def table_location(spark: SparkSession, schema: str, table: str) -> str:
    """Where the table's files lie."""
    location = _described(spark, schema, table, "Location")
    if location is None:
        raise ValueError(f"table {schema}.{table} has no location")
    return location.rstrip("/")


def table_format(spark: SparkSession, schema: str, table: str, asked: str | None = None) -> str:
    """The format of the table's files; another one that is asked for is an error."""
    own = (_described(spark, schema, table, "Provider") or "").lower()
    if asked and own not in ("", "hive", asked):
        raise ValueError(f"table {schema}.{table} holds {own}, not {asked}")
    return asked or (own if own not in ("", "hive") else "parquet")


def register_partitions(
    spark: SparkSession, schema: str, table: str, values: Mapping[str, str] | None = None
) -> None:
    """Tell the catalog about new partitions: the given one, or all that lie in the folder.

    Looking through the folder lists every partition of the table, so name the
    one just written whenever it is known.
    """
    name = _full_name(schema, table)
    if values:
        texts = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in values.items()}
        spec = ", ".join(f"{quoted(k)} = '{v}'" for k, v in texts.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
    else:
        spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")
    spark.catalog.refreshTable(name)


def prepare_table_rows(
    df: DataFrame, columns: Sequence[tuple[str, str, bool]], period: str | None
) -> DataFrame:
    """Rows in the table's columns: period added, case matched, gaps filled with typed NULL.

    A partition column that is still missing is an error, since its rows would
    have no place to go.
    """
    parts = [name for name, _, is_part in columns if is_part]
    out = match_column_case(add_period_for_table(df, parts, period), [c[0] for c in columns])
    missing = [p for p in parts if p not in out.columns]
    unknown = [c for c in out.columns if c not in [name for name, _, _ in columns]]
    if unknown:
        warnings.warn(f"the table has no columns {unknown}, they are left out", stacklevel=2)
    if missing:
        raise ValueError(f"partition columns of the table are not in the data: {missing}")
    return out.select(
        *[
            (column(name) if name in out.columns else F.lit(None).cast(type_text)).alias(name)
            for name, type_text, _ in columns
        ]
    )


def write_table(
    df: DataFrame,
    schema: str,
    table: str,
    mode: str = "append",
    period: str | None = None,
    file_format: str | None = None,
    distribute: bool = True,
    only_written_partitions: bool = False,
    tap: Tap = no_tap,
) -> None:
    """Write into a catalog table.

    The plain way is Spark's insert, which registers just the partitions it
    wrote.  With ``only_written_partitions`` an overwrite keeps the partitions it
    does not write to: files go to the table's location, and then partitions are
    registered.  ``file_format`` is the table's own unless given, and must agree
    with it.
    """
    spark = df.sparkSession
    file_format = table_format(spark, schema, table, file_format)
    columns = table_columns(spark, schema, table)
    parts = [name for name, _, is_part in columns if is_part]
    df = match_column_case(df, [c[0] for c in columns])
    in_data = [p for p in parts if p in df.columns]
    if in_data and distribute:
        df = df.hint("rebalance", *map(column, in_data))
    # The period is added after it, as a constant Spark need not sort by.
    rows = prepare_table_rows(tap(df), columns, period)
    if only_written_partitions and parts:
        write_files(
            rows,
            table_location(spark, schema, table),
            file_format=file_format,
            mode=mode,
            partition_by=parts,
            distribute=False,
            only_written_partitions=True,
        )
        register_partitions(spark, schema, table, None if in_data else {p: str(period) for p in parts})
    else:
        rows.write.mode(mode).insertInto(_full_name(schema, table))


def load_table(
    df: DataFrame,
    props: Mapping[str, object],
    period: str | None = None,
    methods: Mapping[str, Method] | None = None,
    tap: Tap = no_tap,
) -> str:
    """Run one catalog load of a job document and give the table's name.

    Protected columns are protected once.
    """
    schema, table = (str(props.get(k) or "").strip() for k in ("schema", "table"))
    if not schema or not table:
        raise ValueError("a catalog load needs 'schema' and 'table'")
    write_table(
        protect_columns(df, props.get("data_protect_columns"), methods),
        schema,
        table,
        mode=str(props.get("mode") or "append").strip().lower(),
        period=period,
        file_format=str(props.get("format") or "").strip().lower() or None,
        distribute=is_yes(props.get("distribute", "y")),
        only_written_partitions=is_yes(props.get("only_written_partitions")),
        tap=tap,
    )
    return f"{schema}.{table}"
