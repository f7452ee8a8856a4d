"""Ordered character rules for raw text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]

# Fixed values: (found, replacement), applied in this order.
SHARED_RULES: tuple[Rule, ...] = (
    ("'", ""),
)
UTF8_RULES: tuple[Rule, ...] = (
    ("\u2013", "-"),  # en dash
    ("\u00a0", " "),  # no-break space
    ("\u00c3\u0153", "\u00dc"),  # U umlaut, encoded twice
)
# The same three as the bytes of a single-byte text, then the single bytes.
CP1252_RULES: tuple[Rule, ...] = (
    ("\u00e2\u0080\u0093", "-"),
    ("\u00c2\u00a0", " "),
    ("\u00c3\u0083\u00c5\u0093", "\u00dc"),
    ("\u0096", "-"),
    ("\u0092", "'"),
    ("\u0094", ""),
    ("\u0085", ""),
    ("\u0093", ""),
    ("\u0090", ""),
    ("\u0091", ""),
    ("\u0095", ""),
    ("\u0097", ""),
    ("\u008a", "S"),
)
CHARSET_RULES = {"utf-8": SHARED_RULES + UTF8_RULES, "cp1252": SHARED_RULES + CP1252_RULES}


def raw_bytes_as_text(value: Column) -> Column:
    """One character per byte, so that byte rules can be written as text rules."""
    return F.decode(value.cast("binary"), "ISO-8859-1")


def cp1252_characters(value: Column) -> Column:
    """From one character per byte to the characters a cp1252 text means by them."""
    found, meant = "", ""
    for byte in range(0x80, 0xA0):
        character = bytes([byte]).decode("cp1252", errors="ignore")
        if character:
            found, meant = found + chr(byte), meant + character
    # Hardly a text has one of these left, and translating a long text is slow.
    return F.when(value.rlike(f"[{found}]"), F.translate(value, found, meant)).otherwise(value)


def apply_rules(value: Column, rules: Sequence[Rule]) -> Column:
    """Apply (found, replacement) rules one after another.

    One replace per rule is faster on long texts than one translate for all.
    """
    return reduce(lambda text, rule: F.replace(text, F.lit(rule[0]), F.lit(rule[1])), rules, value)


def cleanse(
    value: Column,
    charset: str = "utf-8",
    rules: Sequence[Rule] | None = None,
    raw: bool = True,
) -> Column:
    """Cleanse one text column.

    ``utf-8`` text is cleansed as characters.  ``cp1252`` text is cleansed byte
    by byte and then decoded; it is ``raw`` when its reader kept the bytes, and
    not when the reader already made one character of each byte.
    """
    rules = CHARSET_RULES[charset] if rules is None else rules
    if charset == "cp1252":
        return cp1252_characters(apply_rules(raw_bytes_as_text(value) if raw else value, rules))
    return apply_rules(value, rules)
