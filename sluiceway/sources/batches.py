"""Batch folders: a descriptor next to a ``data`` folder."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluiceway.functions.types import parse_type
from sluiceway.sources.files import (
    DELIMITER,
    GZIP_FILES,
    PLAIN_FILES,
    has_files,
    read_delimited,
    read_parquet,
)

# Names in a batch folder, and the place of a column given by name only.
DESCRIPTOR = "metadata.json"
DATA_FOLDER = "data"
LAST_PLACE = 999_999


def batch_root(paths: Mapping[str, str | None]) -> str:
    """The first root that is filled in: object store, then on-premise."""
    for key in ("path_data_s3", "path_data_onprem"):
        root = (paths.get(key) or "").strip()
        if root:
            return root.rstrip("/")
    raise ValueError("paths name no data root")


def batch_folder(root: str, batch_id: str | None, period: str | None) -> str:
    """Where a batch of a period lies; both are required."""
    if not batch_id or not period:
        raise ValueError("a batch folder needs a batch id and a period")
    return f"{root.rstrip('/')}/{batch_id}_{period}"


def read_descriptor(spark: SparkSession, folder: str) -> dict:
    """The batch's descriptor, a small JSON document."""
    path = f"{folder.rstrip('/')}/{DESCRIPTOR}"
    try:
        return json.loads(spark.read.text(path, wholetext=True).first()["value"])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(path) from error


def _place(entry: Mapping | str) -> int:
    if not isinstance(entry, Mapping):
        return LAST_PLACE
    try:
        return int(str(entry.get("order") or "0"))
    except ValueError:
        return 0


def descriptor_schema(descriptor: Mapping) -> T.StructType | None:
    """The declared schema, or None when no columns are declared.

    Columns come sorted by ``order`` (0 when missing or no number); a column
    given by name only is a string and comes last; one without a name is dropped.
    """
    entries = (descriptor.get("metadata") or {}).get("columns")
    if not entries:
        return None
    schema = T.StructType()
    for entry in sorted(entries, key=_place):
        declared = entry if isinstance(entry, Mapping) else {"name": str(entry)}
        name = (declared.get("name") or "").strip()
        if name:
            schema = schema.add(name, parse_type(declared.get("data_type") or "STRING"))
    return schema


def read_batch(
    spark: SparkSession,
    root: str,
    batch_id: str,
    period: str,
    partitions: int | None = None,
) -> DataFrame:
    """Read a batch as its descriptor says: parquet, or delimited text without header.

    Only files with a data extension are read; a folder without any is read
    whole.  ``partitions`` spreads the rows of unsplittable gzip files.
    """
    folder = batch_folder(root, batch_id, period)
    descriptor = read_descriptor(spark, folder)
    about = descriptor.get("metadata") or {}
    data = f"{folder}/{DATA_FOLDER}"
    if (about.get("format") or "").lower() == "parquet":
        return read_parquet(spark, data)
    gzip = (about.get("compression") or "").lower() == "gzip"
    files = GZIP_FILES if gzip else PLAIN_FILES
    return read_delimited(
        spark,
        data,
        schema=descriptor_schema(descriptor),
        delimiter=about.get("delimiter") or DELIMITER,
        files=files if has_files(spark, data, files) else None,
        partitions=partitions if gzip else None,
    )
