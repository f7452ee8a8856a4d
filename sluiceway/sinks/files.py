"""File sinks: parquet, delimited text, JSON lines, text."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from sluiceway.functions.names import column, is_yes, name_list, stamp_period
from sluiceway.functions.types import WHOLE_TIMES
from sluiceway.operators.columns import run_partitions
from sluiceway.operators.protection import Method, protect_columns

# What each format can be compressed with.
_TEXT_CODECS = ("none", "uncompressed", "bzip2", "gzip", "lz4", "snappy", "deflate")
CODECS = {
    "parquet": ("none", "uncompressed", "snappy", "gzip", "lz4", "lz4_raw", "zstd", "brotli", "lzo"),
    "csv": _TEXT_CODECS,
    "json": _TEXT_CODECS,
    "text": _TEXT_CODECS,
}

# Applied to the rows in the stage that writes them, after any shuffle.
Tap = Callable[[DataFrame], DataFrame]


def no_tap(df: DataFrame) -> DataFrame:
    return df


def output_path(bucket: str | None, name: str | None = None, period: str = "") -> str:
    """``bucket`` or ``bucket/name``, with the period stamped into the name."""
    root = (bucket or "").strip()
    if not root:
        raise ValueError("a file sink needs 'bucket'")
    name = (name or "").strip()
    return f"{root.rstrip('/')}/{stamp_period(name, period)}" if name else root.rstrip("/")


def check_format(file_format: str, compression: str | None) -> None:
    """Refuse an unknown format or codec before any work is done."""
    if file_format not in CODECS:
        raise ValueError(f"unknown file format {file_format!r}, know {sorted(CODECS)}")
    if compression and compression not in CODECS[file_format]:
        raise ValueError(f"{file_format} files cannot be compressed with {compression!r}")


def present_partitions(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Partition columns the frame has; the others are left out with a warning."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        warnings.warn(f"partition columns not in the data, left out: {missing}", stacklevel=2)
    return [n for n in names if n in df.columns]


def _as_text(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The row as JSON in ``value``, partition columns beside it."""
    # A text sink takes one data column, and a partition column may not share its name.
    packed = F.to_json(F.struct(*map(column, df.columns)), WHOLE_TIMES)
    return df.select(packed.alias("value"), *[column(p) for p in partition_by if p != "value"])


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    header: bool = True,
    delimiter: str | None = None,
    extension: str | None = None,
    distribute: bool = True,
    only_written_partitions: bool = False,
    rows_per_file: int | None = None,
    run_columns: Mapping[str, str] | None = None,
    tap: Tap = no_tap,
) -> None:
    """Write a frame as files.

    ``text`` with a delimiter is delimited text; without one every row is JSON
    text.  With partition columns, rows are first rebalanced by them, so that a
    partition value gets few files instead of one per task; adaptive execution
    splits a value that holds too much.  ``run_columns`` are constants to add and
    partition by, which takes neither shuffle nor sort.
    ``only_written_partitions`` lets an overwrite keep the partitions it does not
    write to.
    """
    check_format(file_format, compression)
    if file_format == "text" and delimiter:
        file_format = "csv"
    parts = present_partitions(df, partition_by)
    if parts and distribute:
        df = df.hint("rebalance", *map(column, parts))
    df = tap(df)
    if run_columns:
        # Added last: Spark then sees that they are constant, and does not sort by them.
        df = df.withColumns({name: F.lit(value) for name, value in run_columns.items()})
        parts += run_columns
    if file_format == "text":
        df = _as_text(df, parts)

    writer: DataFrameWriter = df.write.format(file_format).mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    options: dict[str, object] = dict(WHOLE_TIMES) if file_format in ("csv", "json") else {}
    if compression:
        options["compression"] = compression
    if file_format == "csv":
        options["header"] = header
        options["sep"] = delimiter or ","
        if extension:
            options["extension"] = extension
    if only_written_partitions:
        options["partitionOverwriteMode"] = "dynamic"
    if rows_per_file:
        options["maxRecordsPerFile"] = rows_per_file
    writer.options(**options).save(path)


def load_files(
    df: DataFrame,
    props: Mapping[str, object],
    batch_id: str | None = None,
    period: str | None = None,
    methods: Mapping[str, Method] | None = None,
    tap: Tap = no_tap,
) -> str:
    """Run one file load of a job document and give the path written."""
    path = output_path(props.get("bucket"), props.get("name"), period or "")
    out = protect_columns(df, props.get("data_protect_columns"), methods)
    auto = is_yes(props.get("auto_partition"))

    def text(key: str, default: str = "") -> str:
        return str(props.get(key) or default).strip()

    write_files(
        out,
        path,
        file_format=text("format", "parquet").lower(),
        mode=text("mode", "overwrite").lower(),
        partition_by=name_list(props.get("partition_by") or props.get("partitions")),
        compression=text("compression").lower() or None,
        header=is_yes(props.get("header", "y")),
        delimiter=props.get("delimiter") or None,
        extension=text("extension") or None,
        distribute=is_yes(props.get("distribute", "y")),
        only_written_partitions=is_yes(props.get("only_written_partitions")),
        rows_per_file=int(props["rows_per_file"]) if props.get("rows_per_file") else None,
        run_columns=run_partitions(out, batch_id, period) if auto else None,
        tap=tap,
    )
    return path
