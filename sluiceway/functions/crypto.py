"""Hash and cipher expressions, all inside the JVM."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Key derivation and cipher parameters.
KDF_ROUNDS = 100_000
KEY_BYTES = 32
IV_BYTES = 16


@dataclass(frozen=True)
class CipherKey:
    """An AES-256 key and the fixed initial vector used with it.

    The fixed vector keeps equal values equal, so protected columns stay
    joinable; it also shows which rows share a value.
    """

    key: bytes = field(repr=False)
    iv: bytes = field(repr=False)

    def __post_init__(self) -> None:
        if len(self.key) != KEY_BYTES or len(self.iv) != IV_BYTES:
            raise ValueError(f"need a {KEY_BYTES}-byte key and a {IV_BYTES}-byte vector")

    @classmethod
    def derive(cls, passphrase: str, salt: bytes, iv: bytes, rounds: int = KDF_ROUNDS) -> CipherKey:
        """Stretch a passphrase once, on the driver."""
        key = hashlib.pbkdf2_hmac("sha256", passphrase.encode(), salt, rounds, dklen=KEY_BYTES)
        return cls(key, iv)

    def column(self) -> Column:
        """Key and vector as a one-row subquery.

        Unlike literals, which plans, the UI and event logs print, its values
        show up nowhere.
        """
        row = pa.table({"key": pa.array([self.key], pa.binary()), "iv": pa.array([self.iv], pa.binary())})
        secret = SparkSession.active().createDataFrame(row)
        return secret.select(F.struct("key", "iv")).scalar()


def sha256_hex(value: Column) -> Column:
    """Lower-case hex SHA-256 of the value's text; NULL stays NULL."""
    return F.sha2(value.cast("string"), 256)


def encrypt_text(value: Column, key: CipherKey) -> Column:
    """AES-256-CBC with PKCS padding, as one line of base64; NULL stays NULL."""
    secret = key.column()
    sealed = F.aes_encrypt(value.cast("string"), secret["key"], F.lit("CBC"), F.lit("PKCS"), secret["iv"])
    # Spark puts the vector in front of the cipher text and wraps base64 lines.
    body = F.substring(sealed, IV_BYTES + 1, 2**31 - 1)
    return F.replace(F.base64(body), F.lit("\r\n"), F.lit(""))


def decrypt_text(value: Column, key: CipherKey) -> Column:
    """Inverse of :func:`encrypt_text`; anything that is no cipher text gives NULL."""
    secret = key.column()
    body = F.try_to_binary(value, F.lit("base64"))
    opened = F.try_aes_decrypt(F.concat(secret["iv"], body), secret["key"], F.lit("CBC"), F.lit("PKCS"))
    # No cipher text is empty: padding always fills at least one block.
    return F.when(value.rlike("[0-9A-Za-z+/]"), F.try_validate_utf8(opened.cast("string")))
