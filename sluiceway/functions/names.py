"""Names, flags and lists as they appear in job documents."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of an enabled flag.
YES = ("y", "yes", "true", "1")


def is_yes(value: object) -> bool:
    """Whether a job flag is switched on; absent means off."""
    return str(value if value is not None else "").strip().lower() in YES


def name_list(value: str | Iterable[str] | None) -> list[str]:
    """Read ``"a, b"`` or ``["a", "b"]`` as a list of names, blanks dropped."""
    if value is None:
        return []
    parts = value.split(",") if isinstance(value, str) else value
    return [name for name in (str(p).strip() for p in parts) if name]


def quoted(name: str) -> str:
    """The name as one SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Reference a top-level column by its exact name, dots included."""
    return F.col(quoted(name))


def stamp_period(name: str, period: str) -> str:
    """Put the run's period into an output name.

    A ``{fecinfo}`` placeholder is replaced wherever it stands; without one, a
    trailing ``_abc`` in any case becomes ``_<period>``.
    """
    if "{fecinfo}" in name:
        return name.replace("{fecinfo}", period)
    stem, mark = name[:-4], name[-4:]
    return f"{stem}_{period}" if mark.lower() == "_abc" else name


def fill_template(template: str, values: Mapping[str, object]) -> str:
    """Replace ``{{key}}`` tokens; a token without a value is left in place."""
    return re.sub(
        r"\{\{(\w+)\}\}",
        lambda m: str(values[m.group(1)]) if m.group(1) in values else m.group(0),
        template,
    )


def split_table_name(name: str, default_schema: str | None = None) -> tuple[str, str]:
    """Split ``schema.table`` at the first dot, else use the default schema."""
    schema, dot, table = name.strip().partition(".")
    if not dot:
        schema, table = (default_schema or ""), schema
    schema, table = schema.strip(), table.strip()
    if not schema or not table:
        raise ValueError(f"cannot tell schema and table apart in {name!r}")
    return schema, table
