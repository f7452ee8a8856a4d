"""Type texts of batch descriptors and of destination catalogs."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Options of text formats that keep a time as it is; Spark's own formats end at the millisecond.
WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

_DECIMAL_ARGS = re.compile(r"^(?:DECIMAL|NUMERIC)[^(]*\(\s*(\d+)\s*,\s*(\d+)\s*\)")

# Descriptor type texts, first match wins, searched in upper case.
DESCRIPTOR_TYPES = (
    (r"BIGINT", T.LongType()),
    (r"SMALLINT", T.ShortType()),
    (r"\bINT\b", T.IntegerType()),
    (r"^INTEGER$", T.IntegerType()),
    (r"^LONG$", T.LongType()),
    (r"DOUBLE|FLOAT|REAL", T.DoubleType()),
    (r"DATE", T.DateType()),
    (r"TIMESTAMP|^TIME(ZONE)?$", T.TimestampType()),
)

# Destination catalog type texts, matched whole in lower case.
DESTINATION_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "int4": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "double precision": T.DoubleType(),
    "float8": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}

# Which destination texts hold characters, numbers or times.
CATALOG_STRINGS = r"^(character varying|varchar|character|char|text)$|^(varchar|char)\("
GENERIC_STRINGS = r"CHAR|CLOB|TEXT|STRING"
GENERIC_NUMBERS = r"INT|DEC|NUM|DOUBLE|FLOAT|REAL"
GENERIC_TIMES = r"DATE|TIME"


def _descriptor_type(text: str) -> T.DataType:
    upper = text.strip().upper()
    args = _DECIMAL_ARGS.match(upper)
    if args:
        return T.DecimalType(int(args.group(1)), int(args.group(2)))
    for pattern, spark_type in DESCRIPTOR_TYPES:
        if re.search(pattern, upper):
            return spark_type
    return T.StringType()


def _destination_type(text: str) -> T.DataType:
    lower = text.strip().lower()
    if lower in DESTINATION_TYPES:
        return DESTINATION_TYPES[lower]
    if lower.startswith(("decimal", "numeric")):
        args = re.fullmatch(r"(?:decimal|numeric)\((\d+),(\d+)\)", lower)
        return T.DecimalType(*map(int, args.groups())) if args else T.DecimalType(38, 10)
    return T.TimestampType() if "timestamp" in lower else T.StringType()


# Type texts of Spark's own catalog say exactly which type they mean.
_DIALECTS = {"descriptor": _descriptor_type, "destination": _destination_type, "spark": T.DataType.fromDDL}


def parse_type(text: str | None, dialect: str = "descriptor") -> T.DataType:
    """The Spark type for a type text; unknown texts are strings."""
    return _DIALECTS[dialect](text or "")


def type_class(text: str, classify: str = "catalog") -> str | None:
    """``"string"``, ``"other"``, or ``None`` where the column is left alone.

    ``catalog`` treats everything that is not a character type as ``other``;
    ``generic`` only knows numbers and times, so e.g. a boolean is left alone.
    """
    if classify == "catalog":
        return "string" if re.search(CATALOG_STRINGS, text.lower()) else "other"
    upper = text.upper()
    if re.search(GENERIC_NUMBERS, upper) or re.search(GENERIC_TIMES, upper):
        return "other"
    return "string" if re.search(GENERIC_STRINGS, upper) else None
