"""One row per stage of a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = pa.schema(
    [
        ("run_id", pa.string()),
        ("batch_id", pa.string()),
        ("period", pa.string()),
        ("stage", pa.string()),
        ("target", pa.string()),
        ("rows", pa.int64()),
        ("status", pa.string()),
        ("error", pa.string()),
        ("logged_at", pa.timestamp("us", tz="UTC")),
    ]
)


@dataclass
class Entry:
    """What one stage did.  ``rows`` is None where counting would cost a scan of its own."""

    run_id: str
    batch_id: str | None
    period: str | None
    stage: str
    target: str
    rows: int | None
    status: str
    error: str | None
    logged_at: dt.datetime


def entries_frame(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    """The entries of a run, a handful of rows, as a frame."""
    return spark.createDataFrame(pa.Table.from_pylist([asdict(e) for e in entries], SCHEMA)).coalesce(1)


def append_log(spark: SparkSession, path: str, entries: list[Entry]) -> None:
    """Append a run's entries to the run log, one small file a run."""
    entries_frame(spark, entries).write.mode("append").parquet(path)


def sample_rows(df: DataFrame, count: int = 5) -> DataFrame:
    """A few rows to look at.  Give it protected rows only."""
    return df.limit(count)
