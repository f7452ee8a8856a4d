"""Types of delimited text, found by one aggregate over columns that the text is parsed into once.

A column's type is the highest level any of its cells reaches on a ladder: integer, bigint, decimal, double for numbers;
date, timestamp for times. Levels merge by maximum, so tasks, files and repeated tasks merge in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.names import column
from sluiceway.sinks.staging import remove_staged, staging_folder
from sluiceway.sources.files import DELIMITER, read_delimited

# Types by level, from 1; a cell beyond the last fits none.
NUMBERS = ("int", "bigint", "decimal(38,0)", "double")
TIMES = ("date", "timestamp")
NEITHER = 99

_WHOLE = "^[+-]?[0-9]+$"
_DECIMAL = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?(?:Z|[+-][0-9]{2}:[0-9]{2})?$"


def number_level(cell: Column) -> Column:
    """Level of a cell among numbers; NULL for NULL."""
    fits = [cell.try_cast(name).isNotNull() for name in NUMBERS[:3]]
    whole = F.when(fits[0], 1).when(fits[1], 2).when(fits[2], 3).otherwise(4)
    return F.when(cell.rlike(_WHOLE), whole).when(cell.rlike(_DECIMAL), 4).when(cell.isNotNull(), NEITHER)


def time_level(cell: Column) -> Column:
    """Level of a cell among times; NULL for NULL."""
    day = cell.rlike(_DAY) & cell.try_cast("date").isNotNull()
    moment = cell.rlike(_MOMENT) & cell.try_cast("timestamp").isNotNull()
    return F.when(day, 1).when(moment, 2).when(cell.isNotNull(), NEITHER)


def found_types(texts: DataFrame) -> dict[str, str]:
    """Type of each column of texts: by one aggregate, whatever the number of columns. Columns without a cell stay text."""
    levels = texts.agg(
        *[F.max(number_level(column(c))).alias(f"number_{i}") for i, c in enumerate(texts.columns)],
        *[F.max(time_level(column(c))).alias(f"time_{i}") for i, c in enumerate(texts.columns)],
    ).first()

    def named(i: int) -> str:
        for level, types in ((levels[f"number_{i}"], NUMBERS), (levels[f"time_{i}"], TIMES)):
            if level is not None and level <= len(types):
                return types[level - 1]
        return "string"

    return {c: named(i) for i, c in enumerate(texts.columns)}


def read_typed(
    spark: SparkSession,
    path: str,
    delimiter: str = DELIMITER,
    header: bool = False,
    files: str | None = None,
    encoding: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read delimited text with the types its cells have.

    The text is parsed once, into a table in the shared folder; types come from that table's columns, and so do the rows
    read later, which take the columns they need only. Gzip files are decompressed once. The table stays until the
    shared folder is cleared; a read that fails removes it.
    """
    texts = read_delimited(spark, path, delimiter=delimiter, header=header, files=files, encoding=encoding, partitions=partitions)
    names, place = texts.columns, staging_folder(spark, "typed")
    try:
        # Names by place: what a header says may be no name of a parquet column.
        texts.toDF(*[f"c{i}" for i in range(len(names))]).write.parquet(place)
        staged = spark.read.schema(", ".join(f"c{i} string" for i in range(len(names)))).parquet(place)
        types = found_types(staged)
    except Exception:
        remove_staged(spark, place)
        raise
    return staged.select(*[F.col(f"c{i}").cast(types[f"c{i}"]).alias(name) for i, name in enumerate(names)])
