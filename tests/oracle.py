"""Compare every query with its oracle.  Run as a script: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import DataFrame, SparkSession

import __spark_entry__ as driver


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> str:
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    return repr(value)


def rows_of(names: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = rows_of(df.columns, df.collect())
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    want = rows_of(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {n: str(t) for n, t in zip(names, [d[1] for d in found.description])}
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} rows differ, e.g. {str(wrong[0][0])[:300]} != {str(wrong[0][1])[:300]}"
    loose = {
        f.name: (f.dataType.simpleString(), kinds[f.name])
        for f in df.schema.fields
        if not same_kind(f.dataType.simpleString(), kinds[f.name])
    }
    return f"types differ: {loose}" if loose else None


def same_kind(spark_type: str, duck_type: str) -> bool:
    expected = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "smallint": "SMALLINT",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
        "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
    }
    return expected.get(spark_type) == duck_type


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = session(), database(sf_dir)
    oracles, bad = driver.oracle_sql(), 0
    for name, run in driver.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, connection, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'same'}", flush=True)
    print(f"{bad} problems")
