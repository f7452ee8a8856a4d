"""Casts that give NULL for a value that does not fit, on any session setting.

A failing ``try_cast`` raises and catches an exception inside the JVM, at a cost
of many microseconds a row.  Text that cannot be of the target type is therefore
kept away from the cast by a pattern; the cast still has the last word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blanks around a value, spellings of truth, and number patterns.
_BLANKS = r"[\x00-\x20\x7f]*"
TRUE_WORDS = "t|true|y|yes|1"
FALSE_WORDS = "f|false|n|no|0"
ONLY_DECIMALS = rf"^{_BLANKS}[+-]?\.[0-9]*{_BLANKS}$"
DECIMAL_NUMBER = rf"^{_BLANKS}[+-]?(\p{{Nd}}+\.?\p{{Nd}}*|\.\p{{Nd}}+)([eE][+-]?\p{{Nd}}+)?{_BLANKS}$"
FLOATING_NUMBER = (
    rf"^{_BLANKS}[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?{_BLANKS}$|0[xX]|(?i:inf|nan))"
)

# How many digits always fit, and how many can fit at all.
_DIGITS = {
    T.ByteType: (2, 3),
    T.ShortType: (4, 5),
    T.IntegerType: (9, 10),
    T.LongType: (18, 19),
}


def _text_to_whole(value: Column, target: T.IntegralType) -> Column:
    """Text to an integer; a decimal part is cut off ("1.5" is 1, ".5" is 0).

    Plain short numbers, by far the most common, take the first branch.
    """
    short, long = _DIGITS[type(target)]
    number = rf"^{_BLANKS}([+-]?0*[0-9]{{1,{long}}})(?:\.[0-9]*)?{_BLANKS}$"
    return (
        F.when(value.rlike(rf"^[+-]?[0-9]{{1,{short}}}$"), value.try_cast(target))
        .when(value.rlike(number), F.regexp_extract(value, number, 1).try_cast(target))
        .when(value.rlike(ONLY_DECIMALS), F.lit(0).cast(target))
    )


def _text_to_boolean(value: Column) -> Column:
    def one_of(words: str) -> Column:
        return value.rlike(f"(?i)^{_BLANKS}({words}){_BLANKS}$")

    return F.when(one_of(TRUE_WORDS), True).when(one_of(FALSE_WORDS), False)


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast without ever failing the job: what does not fit becomes NULL."""
    if source == target:
        return value
    if isinstance(source, T.StringType):
        if isinstance(target, T.IntegralType):
            return _text_to_whole(value, target)
        if isinstance(target, T.BooleanType):
            return _text_to_boolean(value)
        if isinstance(target, T.DecimalType):
            return F.when(value.rlike(DECIMAL_NUMBER), value.try_cast(target))
        if isinstance(target, (T.DoubleType, T.FloatType)):
            return F.when(value.rlike(FLOATING_NUMBER), value.try_cast(target))
    if isinstance(source, (T.DateType, T.BinaryType)) and isinstance(target, T.NumericType):
        return F.lit(None).cast(target)
    return value.try_cast(target)
