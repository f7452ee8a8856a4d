"""Appending by run: what a run appends replaces what the same run appended before.

A table of runs is a folder. Every attempt of a run writes its rows to a folder of its own; a manifest beside them names
the attempt that counts for each run, and only that is read. An attempt counts once its manifest row is written, after
its files are there, so a run that dies leaves nothing to be read, and one that is run again leaves its rows once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.names import column, name_list
from sluiceway.sinks.files import write_files

RUN = "run_id"
# A leading underscore keeps the manifest out of what Spark reads as data.
_MANIFEST, _ROWS, _ATTEMPT = "_runs", "rows", "_attempt"
_ENTRY = "run_id string, attempt string, rows long, columns string, committed_at timestamp"


def append_run(df: DataFrame, path: str, run_id: str, partition_by: str | Sequence[str] | None = None) -> int:
    """Append the rows of a run to the table at `path` and give their number.

    A run appended before is replaced, whatever it held, also by no rows at all. The number of rows comes from the
    footers of the files that are committed with it. All runs of a table are partitioned alike. Runs of one id must not
    be appended at the same time.
    """
    if not run_id:
        raise ValueError("a run needs an id")
    if RUN in df.columns or _ATTEMPT in df.columns:
        raise ValueError(f"the rows have a column {RUN} or {_ATTEMPT} already")
    spark = df.sparkSession
    attempt = f"a{uuid.uuid4().hex}"
    place = f"{path}/{_ROWS}/{_ATTEMPT}={attempt}"
    write_files(df, place, mode="errorifexists", partition_by=name_list(partition_by))
    rows = spark.read.schema(df.schema).parquet(place).count()
    entry = [F.lit(run_id), F.lit(attempt), F.lit(rows).cast("long"), F.lit(df.schema.json()), F.current_timestamp()]
    names = ["run_id", "attempt", "rows", "columns", "committed_at"]
    spark.range(1).select(*[e.alias(n) for e, n in zip(entry, names)]).write.mode("append").parquet(f"{path}/{_MANIFEST}")
    return rows


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, attempt, rows, columns, committed_at) of the attempt that counts for each run: the last one committed."""
    entries = spark.read.schema(_ENTRY).parquet(f"{path}/{_MANIFEST}")
    latest = F.max(F.struct("committed_at", "attempt", "rows", "columns")).alias("last")
    return entries.groupBy("run_id").agg(latest).select("run_id", "last.attempt", "last.rows", "last.columns", "last.committed_at")


def _all_columns(schemas: Sequence[str]) -> T.StructType:
    """Columns of all runs, in order of their first run; a column has one type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in T.StructType.fromJson(json.loads(schema)).fields:
            known = found.setdefault(field.name, T.StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise TypeError(f"column {field.name} is {known.dataType.simpleString()} in one run and {field.dataType.simpleString()} in another")
    return T.StructType(list(found.values()))


def read_runs(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """The rows of all committed runs, or of some, with their run id first.

    Only folders of attempts that count are listed and read; the driver sees one entry per run. Columns a run lacks
    are NULL for it.
    """
    known = committed_runs(spark, path)
    if runs is not None:
        known = known.where(F.col("run_id").isin(list(runs)))
    entries = known.orderBy("committed_at", "attempt").collect()
    if not entries:
        raise FileNotFoundError(f"{path} has no committed run" + (f" of {runs}" if runs else ""))
    schema = _all_columns([e["columns"] for e in entries])
    # A run without rows may have no folder with files, but it has a folder.
    places = [f"{path}/{_ROWS}/{_ATTEMPT}={e.attempt}" for e in entries]
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(_ATTEMPT, T.StringType())])).option("basePath", f"{path}/{_ROWS}").parquet(*places)
    named = known.select(F.col("run_id").alias(RUN), F.col("attempt").alias("_named"))
    return rows.join(F.broadcast(named), column(_ATTEMPT) == F.col("_named")).select(RUN, *map(column, schema.names))


def remove_outdated(spark: SparkSession, path: str) -> int:
    """Delete the folders of attempts that no longer count, or never did, and give their number.

    To be called while no run is being appended: an attempt under way is not in the manifest yet.
    """
    keep = {f"{_ATTEMPT}={e.attempt}" for e in committed_runs(spark, path).select("attempt").collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_ROWS}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName() not in keep]
    for place in gone:
        system.delete(place, True)
    return len(gone)
