"""JDBC sinks, on Spark's JDBC writer.

Each sink is a plain frame operation followed by one append or overwrite.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from sluiceway.functions.names import is_yes, name_list, split_table_name
from sluiceway.functions.types import parse_type
from sluiceway.operators.columns import (
    add_audit_columns,
    align_by_name,
    align_by_position,
    cast_to_destination,
    clean_blanks,
    null_to_empty,
    select_existing,
)
from sluiceway.sinks.files import Tap, no_tap
from sluiceway.sources.jdbc import connection_options, remote_columns

# Connection names, drivers and URLs used when a job names none.
AUDITED = {
    "connection": "postgres-cnx-01",
    "driver": "org.postgresql.Driver",
    "url": "jdbc:postgresql://{{server}}:{{port}}/{{database}}",
}
TRUNCATING = {"driver": "com.teradata.jdbc.TeraDriver"}
ALIGNED = {
    "connection": "redshift-cnx-01",
    "port": "5439",
    "url": "jdbc:redshift://{{server}}:{{port}}/{{database}}",
}
BATCH_ROWS = 5000
# Connections a load opens at most unless it says otherwise: one per task would be thousands.
CONNECTIONS = 64


def required_table(props: Mapping[str, object]) -> str:
    table = str(props.get("dbtable") or "").strip()
    if not table:
        raise ValueError("a JDBC load needs 'dbtable'")
    return table


def _mode(props: Mapping[str, object]) -> str:
    return str(props.get("mode") or "append").strip().lower()


def _limits(props: Mapping[str, object]) -> dict[str, str]:
    """How many connections to open and how many rows to send at once."""
    return {
        "batchsize": str(props.get("batch_rows") or BATCH_ROWS),
        "numPartitions": str(props.get("connections") or CONNECTIONS),
    }


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str, tap: Tap = no_tap) -> None:
    """Hand a frame to Spark's JDBC writer.

    With a limit on connections the rows are repartitioned to that many tasks;
    left to itself the writer would run the whole stage before it in that few.
    """
    if options.get("numPartitions"):
        df = df.repartition(int(options["numPartitions"]))
    tap(df).write.format("jdbc").options(**options).mode(mode).save()


def audited_rows(
    df: DataFrame,
    props: Mapping[str, object],
    period: str | None = None,
    batch_id: str | int | None = None,
) -> DataFrame:
    """Rows with audit columns, reduced to the asked-for columns."""
    out = add_audit_columns(df, period, batch_id)
    wanted = name_list(props.get("select_cols"))
    return select_existing(out, wanted) if wanted else out


def audited_options(props: Mapping[str, object], connection: Mapping[str, object]) -> dict[str, str]:
    """Options of the audited sink.

    Each task writes in a transaction of its own.  Without one, a task that is
    run again after losing its executor would leave its first rows behind.
    """
    return {
        **connection_options(connection, AUDITED["url"], AUDITED["driver"]),
        **_limits(props),
        "dbtable": required_table(props),
        "truncate": "false",
        "isolationLevel": str(props.get("isolation") or "READ_COMMITTED"),
    }


def load_audited(
    df: DataFrame,
    props: Mapping[str, object],
    connection: Mapping[str, object],
    period: str | None = None,
    batch_id: str | int | None = None,
    tap: Tap = no_tap,
) -> str:
    """Append rows with the run's period, batch and load time."""
    options = audited_options(props, connection)
    write_jdbc(audited_rows(df, props, period, batch_id), options, _mode(props), tap)
    return options["dbtable"]


def truncating_rows(df: DataFrame, props: Mapping[str, object]) -> DataFrame:
    """Rows with NULL text as '' when asked for."""
    return null_to_empty(df) if is_yes(props.get("null_to_empty")) else df


def truncating_options(
    props: Mapping[str, object], connection: Mapping[str, object]
) -> tuple[dict[str, str], str]:
    """Options and mode: overwrite empties the table and keeps it, anything else appends."""
    if not connection.get("password"):
        raise ValueError("the connection has no password")
    overwrite = _mode(props) == "overwrite"
    options = {
        **connection_options(connection, default_driver=TRUNCATING["driver"]),
        **_limits(props),
        "dbtable": required_table(props),
    }
    return (options | {"truncate": "true"}, "overwrite") if overwrite else (options, "append")


def load_truncating(
    df: DataFrame,
    props: Mapping[str, object],
    connection: Mapping[str, object],
    tap: Tap = no_tap,
) -> str:
    """Append, or overwrite by emptying the table first."""
    options, mode = truncating_options(props, connection)
    write_jdbc(truncating_rows(df, props), options, mode, tap)
    return options["dbtable"]


def aligned_rows(
    df: DataFrame,
    destination: Sequence[tuple[str, str]],
    by_position: bool = False,
    null_to_empty: bool = False,
    dialect: str = "destination",
) -> DataFrame:
    """Rows in the destination's columns and types; `dialect` says whose type texts they are.

    Aligned by position or by name, blanks cleaned for the type, then cast.  The
    casts turn blank text into NULL by themselves, so only columns that stay
    text are cleaned first.
    """
    types = dict(destination)
    texts = {n: t for n, t in destination if isinstance(parse_type(t, dialect), StringType)}
    out = align_by_position(df, destination) if by_position else align_by_name(df, list(types))
    return cast_to_destination(clean_blanks(out, texts, null_to_empty), types, dialect)


def aligned_options(
    props: Mapping[str, object], connection: Mapping[str, object]
) -> tuple[dict[str, str], str]:
    """Options and mode of the aligned sink; overwrite empties the table and keeps it."""
    if not connection.get("server") or not connection.get("database"):
        raise ValueError("the connection needs 'server' and 'database'")
    filled = {**connection, "port": connection.get("port") or ALIGNED["port"]}
    schema, table = split_table_name(required_table(props), str(connection.get("schema") or ""))
    options = {
        **connection_options(filled, ALIGNED["url"]),
        **_limits(props),
        "dbtable": f"{schema}.{table}",
        "currentSchema": schema,
    }
    if _mode(props) == "overwrite":
        return options | {"truncate": "true"}, "overwrite"
    return options, "append"


def load_aligned(
    df: DataFrame,
    props: Mapping[str, object],
    connection: Mapping[str, object],
    destination: Sequence[tuple[str, str]] | None = None,
    tap: Tap = no_tap,
) -> str:
    """Write rows fitted to the destination table, whose columns are looked up unless given."""
    options, mode = aligned_options(props, connection)
    table = options["dbtable"]
    if destination is None:
        lookup = {k: v for k, v in options.items() if k not in ("dbtable", "truncate")}
        destination = remote_columns(df.sparkSession, lookup, table)
    if not destination:
        raise ValueError(f"no columns found for {table}")
    rows = aligned_rows(
        df, destination, is_yes(props.get("load_position")), is_yes(props.get("null_to_empty"))
    )
    write_jdbc(rows, options, mode, tap)
    return table
