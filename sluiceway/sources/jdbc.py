"""JDBC readers and destination inventories, on Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.names import fill_template, split_table_name

# What a connection must hold before it is used for reading.
REQUIRED = ("driver", "username", "password", "server", "port", "database", "connection_url")


@dataclass(frozen=True)
class ReadSplit:
    """How to read a remote table in parallel, by ranges of one column."""

    column: str
    lower: str | int
    upper: str | int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def connection_options(
    connection: Mapping[str, object], default_url: str = "", default_driver: str = ""
) -> dict[str, str]:
    """Spark options of a named connection; ``{{key}}`` in the URL is filled in."""
    options = {
        "url": fill_template(str(connection.get("connection_url") or default_url), connection),
        "driver": str(connection.get("driver") or default_driver),
        "user": str(connection.get("username") or ""),
        "password": str(connection.get("password") or ""),
    }
    return {k: v for k, v in options.items() if v}


def read_options(
    connection: Mapping[str, object],
    dbtable: str | None = None,
    query: str | None = None,
    split: ReadSplit | None = None,
    fetch_size: int | None = None,
) -> dict[str, str]:
    """All options of one JDBC read; a query wins over a table.

    Spark refuses to split a ``query``, so a split one is read as a derived table.
    """
    missing = [key for key in REQUIRED if not connection.get(key)]
    if missing:
        raise ValueError(f"connection is incomplete, missing {missing}")
    if not query and not dbtable:
        raise ValueError("a JDBC read needs 'dbtable' or 'query'")
    options = connection_options(connection)
    if query and split is None:
        options["query"] = query
    else:
        options["dbtable"] = f"({query}) q" if query else str(dbtable)
    if split is not None:
        options |= split.options()
    if fetch_size:
        options["fetchsize"] = str(fetch_size)
    return options


def read_jdbc(
    spark: SparkSession,
    connection: Mapping[str, object],
    dbtable: str | None = None,
    query: str | None = None,
    split: ReadSplit | None = None,
    fetch_size: int | None = None,
    ranges: Sequence[str] | None = None,
) -> DataFrame:
    """Read a remote table or query.  Filters and columns on a table are pushed down.

    ``ranges`` are conditions of which every row meets exactly one, such as
    ``splits.derived_ranges`` gives; each is read by a task of its own.
    """
    options = read_options(connection, dbtable, query, split, fetch_size)
    if ranges:
        if split is not None:
            raise ValueError("a JDBC read is split by ranges or by bounds, not by both")
        place = f"({query}) q" if query else str(dbtable)
        about = {k: v for k, v in options.items() if k not in ("url", "query", "dbtable")}
        return spark.read.jdbc(options["url"], place, predicates=list(ranges), properties=about)
    return spark.read.format("jdbc").options(**options).load()


def _remote_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def remote_tables(spark: SparkSession, options: Mapping[str, str], schema: str) -> DataFrame:
    """Tables and views of a remote schema."""
    text = schema.replace("'", "''")
    return _remote_query(
        spark,
        options,
        "SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{text}' AND table_type IN ('BASE TABLE', 'VIEW')",
    )


def remote_columns(
    spark: SparkSession, options: Mapping[str, str], dbtable: str, default_schema: str | None = None
) -> list[tuple[str, str]]:
    """Column names and type texts of a remote table, in its own order.

    Spark asks the driver for the table's schema and reads no rows, so this
    works the same on every database.
    """
    schema, table = split_table_name(dbtable, default_schema)
    found = spark.read.format("jdbc").options(**options).option("dbtable", f"{schema}.{table}").load()
    # Spark's names of types that destination catalogs spell otherwise.
    respell = {"double": "double precision", "float": "real", "string": "text"}
    return [(f.name, respell.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in found.schema.fields]
