"""Column protection: hashing and reversible encryption.

Protection fails closed.  A column that is not there, or a method nobody knows,
stops the job instead of letting clear values through.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from sluiceway.functions.crypto import CipherKey, decrypt_text, encrypt_text, sha256_hex
from sluiceway.functions.names import column, is_yes, name_list

# Method names that mean SHA-256.
SHA256_METHODS = ("volt-sha-256", "sha-256", "sha256")


class ProtectionError(ValueError):
    """A column could not be protected as asked."""


Method = Callable[[Column], Column]


def _replace(df: DataFrame, names: Sequence[str], method: Method) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ProtectionError(f"columns to protect are not in the data: {missing}")
    return df.withColumns({n: method(column(n)) for n in names}) if names else df


def hash_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace columns by the hex SHA-256 of their text."""
    return _replace(df, names, sha256_hex)


def encrypt_columns(df: DataFrame, names: Sequence[str], key: CipherKey) -> DataFrame:
    """Replace columns by their AES cipher text; equal values stay equal."""
    return _replace(df, names, lambda value: encrypt_text(value, key))


def decrypt_columns(df: DataFrame, names: Sequence[str], key: CipherKey) -> DataFrame:
    """Replace cipher text by what it hides; other text becomes NULL."""
    return _replace(df, names, lambda value: decrypt_text(value, key))


def protection_methods(keys: Mapping[str, CipherKey] | None = None) -> dict[str, Method]:
    """Methods by lower-case name: the hashes, and one cipher per named key."""
    methods: dict[str, Method] = {name: sha256_hex for name in SHA256_METHODS}
    for name, key in (keys or {}).items():
        methods[name.lower()] = lambda value, key=key: encrypt_text(value, key)
    return methods


def protect_columns(
    df: DataFrame,
    spec: Mapping[str, object] | None,
    methods: Mapping[str, Method] | None = None,
) -> DataFrame:
    """Apply a job's protection block.

    Reads ``{type, columns}`` of a load, and ``{name_method, columns_sensitive,
    enabled_ind}`` of a source.  No block, no columns, or a block that is
    switched off, changes nothing.
    """
    if not spec or ("enabled_ind" in spec and not is_yes(spec["enabled_ind"])):
        return df
    names = name_list(spec.get("columns") or spec.get("columns_sensitive"))
    if not names:
        return df
    method_name = str(spec.get("type") or spec.get("name_method") or "").strip().lower()
    known = protection_methods() if methods is None else methods
    if method_name not in known:
        raise ProtectionError(f"unknown protection method {method_name!r}")
    return _replace(df, names, known[method_name])
