"""Registration of queries and the helpers they share."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.crypto import CipherKey
from sluiceway.sinks.staging import staging_folder
from sluiceway.sources.batches import DATA_FOLDER, DESCRIPTOR, batch_folder

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

# A key for these queries alone; a real job passes its own.
EXAMPLE_KEY = CipherKey.derive("an example passphrase", b"an example salt", b"example vector 1")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its oracle."""

    def register(run: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Put one small document onto the shared file system."""
    spark.range(1).coalesce(1).select(F.lit(text).alias("value")).write.text(path)


def write_batch(
    df: DataFrame, batch_id: str, period: str, about: dict, **csv_options: object
) -> str:
    """Lay out a batch folder with its descriptor; give the root it lies in."""
    root = staging_folder(df.sparkSession, "batches")
    folder = batch_folder(root, batch_id, period)
    data = f"{folder}/{DATA_FOLDER}"
    if about.get("format") == "parquet":
        df.write.parquet(data)
    else:
        df.write.options(sep=about.get("delimiter", "|"), **csv_options).csv(data)
    write_small_text(df.sparkSession, f"{folder}/{DESCRIPTOR}", json.dumps({"metadata": about}))
    return root
