"""The extract stage: from a job's modules to the base frame."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.names import is_yes, name_list, stamp_period
from sluiceway.operators.cleansing import cleanse_columns, cut_fields
from sluiceway.operators.columns import require_header
from sluiceway.operators.protection import Method, protect_columns
from sluiceway.operators.quality import split_rejects
from sluiceway.plans.job import Job
from sluiceway.sinks.files import write_files
from sluiceway.sources.batches import batch_root, read_batch
from sluiceway.sources.files import DELIMITER, read_delimited
from sluiceway.sources.jdbc import ReadSplit, read_jdbc


def _enabled(block: Mapping[str, Any] | None) -> bool:
    return bool(block) and is_yes(block.get("enabled_ind", "y"))


def _split(module: Mapping[str, Any]) -> ReadSplit | None:
    """Parallel reading as a job spells it, with Spark's own option names."""
    if not module.get("partitionColumn"):
        return None
    return ReadSplit(
        str(module["partitionColumn"]),
        module["lowerBound"],
        module["upperBound"],
        int(module["numPartitions"]),
    )


def read_jdbc_module(spark: SparkSession, job: Job, module: Mapping[str, Any]) -> DataFrame:
    """Read what a JDBC extract module names."""
    name = module.get("data_connection")
    if not name:
        raise ValueError("a JDBC extract needs 'data_connection'")
    return read_jdbc(
        spark,
        job.connection(str(name)),
        dbtable=module.get("dbtable"),
        query=module.get("query"),
        split=_split(module),
        fetch_size=module.get("fetchsize"),
    )


def _read_file(spark: SparkSession, job: Job, props: Mapping[str, Any]) -> DataFrame:
    name = stamp_period(str(props.get("name") or ""), job.period or "")
    path = f"{str(props['path']).rstrip('/')}/{name}.{props.get('extension') or 'txt'}"
    delimiter, header = props.get("delimiter") or DELIMITER, is_yes(props.get("header", "y"))
    clean = props.get("clean")
    if not _enabled(clean):
        return read_delimited(spark, path, delimiter=delimiter, header=header)
    charset = str(clean.get("charset") or "utf-8")
    if clean.get("fields"):
        lines = cleanse_columns(spark.read.text(path), ["value"], charset)
        places = [(int(start), int(length)) for start, length in clean["fields"]]
        return cut_fields(lines, places, name_list(props.get("columns")) or None)
    # Byte rules need one character per byte, which is what this decoding gives.
    encoding = "ISO-8859-1" if charset == "cp1252" else None
    rows = read_delimited(spark, path, delimiter=delimiter, header=header, encoding=encoding)
    return cleanse_columns(rows, rows.columns, charset, raw=False)


def read_file_module(
    spark: SparkSession, job: Job, props: Mapping[str, Any], methods: Mapping[str, Method] | None = None
) -> DataFrame:
    """Read a delimited file the way its module describes it.

    Cleansing, header check, quality split against the reject limit, and
    protection, each only where the module switches it on.  Rejected rows go to
    ``reject.path`` when there is one.
    """
    df = _read_file(spark, job, props)
    expected = name_list(props.get("columns"))
    if expected:
        df = require_header(df, expected)
    quality, reject = props.get("quality_integration"), props.get("reject") or {}
    if _enabled(quality):
        limit = float(reject["umbral"]) if _enabled(reject) and reject.get("umbral") else None
        df, rejected, totals = split_rejects(
            df,
            keys=name_list(quality.get("columns_key")),
            critical=name_list(quality.get("columns_critical")),
            limit_percent=limit,
            long_keys=is_yes(quality.get("long_keys")),
        )
        if totals.rejected and reject.get("path"):
            guarded = protect_columns(rejected, props.get("data_protection"), methods)
            write_files(guarded, str(reject["path"]), mode="append")
    return protect_columns(df, props.get("data_protection"), methods)


def shares_base(job: Job) -> str:
    """What becomes of a base that several consumers read: as the settings named `extract` say.

    Without a word, what is costly to read or may change between two reads, a JDBC
    source or a file with a quality check, is written to the shared folder once.
    Other files are scanned by each consumer, which reads just what it needs.
    """
    asked = str(job.settings("extract").get("share") or "").lower()
    if asked:
        return asked
    modules = job.modules("extract")
    checked = any(_enabled((m.get("properties") or {}).get("quality_integration")) for m in modules)
    remote = any(str(m.get("extract_type") or "").lower() == "jdbc" for m in modules)
    return "table" if remote or checked else "none"


def read_base(
    spark: SparkSession, job: Job, methods: Mapping[str, Method] | None = None
) -> tuple[DataFrame, str]:
    """The base frame and a name for the log.

    A JDBC module wins, then a file module; a job without either reads its batch
    folder under the configured root.  A module of type ``batch`` may say into how
    many ``partitions`` the rows of gzip files are spread.
    """
    modules = job.modules("extract")
    for module in modules:
        if str(module.get("extract_type") or "").lower() == "jdbc":
            return read_jdbc_module(spark, job, module), f"jdbc:{module.get('dbtable') or 'query'}"
    for module in modules:
        if str(module.get("type") or "").lower() == "file":
            props = module.get("properties") or {}
            return read_file_module(spark, job, props, methods), f"file:{props.get('name')}"
    batch = next((m for m in modules if str(m.get("type") or "").lower() == "batch"), {})
    if modules and not batch:
        raise ValueError("no extract module of a known kind")
    spread = (batch.get("properties") or {}).get("partitions")
    root = batch_root(job.settings("paths"))
    rows = read_batch(spark, root, job.batch_id, job.period, int(spread) if spread else None)
    return rows, f"batch:{job.batch_id}_{job.period}"
