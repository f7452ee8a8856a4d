"""File readers: parquet, delimited text, fixed-width text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluiceway.functions.cleansing import CHARSET_RULES, Rule
from sluiceway.operators.cleansing import RAW_LINE_FIELDS, cleanse_columns, cut_fields

# The default delimiter, and data files by extension in any case.
DELIMITER = "|"
PLAIN_FILES = "*.{[cC][sS][vV],[tT][xX][tT],[dD][aA][tT]}"
GZIP_FILES = "*.[gG][zZ]"


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a parquet file or folder; filters and columns reach the scan.

    A declared schema keeps partition columns as declared, where inference
    would turn a period such as ``0202510`` into a number.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    delimiter: str = DELIMITER,
    header: bool = False,
    infer: bool = False,
    files: str | None = None,
    partitions: int | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """Read delimited text, plain or compressed.

    With a schema, a cell that does not parse is NULL.  Without one every
    column is a string, unless ``infer`` asks for one more pass to guess types.
    A gzip file cannot be split and is read by one task; ``partitions`` spreads
    its rows before anything costly happens to them.
    """
    reader = spark.read.option("sep", delimiter).option("header", header)
    if encoding:
        reader = reader.option("encoding", encoding)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


def read_headerless(spark: SparkSession, path: str, delimiter: str = DELIMITER) -> DataFrame:
    """Read delimited text without a header line; columns are ``col_1`` to ``col_n``."""
    df = read_delimited(spark, path, delimiter=delimiter, infer=True)
    return df.toDF(*[f"col_{i}" for i in range(1, len(df.columns) + 1)])


def _with_header(spark: SparkSession, path: str) -> DataFrame:
    df = read_delimited(spark, path, header=True, infer=True)
    # Blank header cells come out as _c0, _c1, ...: there was no header.
    return read_headerless(spark, path) if all(c.startswith("_c") for c in df.columns) else df


def read_first_available(spark: SparkSession, folder: str) -> DataFrame:
    """Read ``data.parquet``, else ``data.txt``, else ``data.csv`` of a folder."""
    # Candidate names, in order of preference.
    candidates = (("data.parquet", read_parquet), ("data.txt", _with_header), ("data.csv", _with_header))
    for name, read in candidates:
        try:
            return read(spark, f"{folder.rstrip('/')}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"{folder} holds none of {[name for name, _ in candidates]}")


def has_files(spark: SparkSession, folder: str, files: str) -> bool:
    """Whether a folder has a file of the given pattern; a missing folder is an error."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).load(folder)
    return not found.select("path").isEmpty()


def read_fixed_width(
    spark: SparkSession,
    path: str,
    fields: Sequence[tuple[int, int]] = RAW_LINE_FIELDS,
    names: Sequence[str] | None = None,
    charset: str = "utf-8",
    rules: Sequence[Rule] | None = None,
    trim: bool = False,
) -> DataFrame:
    """Read lines, cleanse them, then cut them by first character and length.

    The order matters: a cleansed line is the one whose positions count.
    """
    rules = CHARSET_RULES[charset] if rules is None else rules
    lines = cleanse_columns(spark.read.text(path), ["value"], charset, rules)
    return cut_fields(lines, fields, names, trim=trim)
