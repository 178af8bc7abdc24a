"""Layout-independent pseudo-random numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_HEX_DIGITS = 8
HASH_RANGE = float(16**HASH_HEX_DIGITS)


def hash_number(key: Column, salt: str | Column = "") -> Column:
    """Whole number of 32 bits that depends only on the key's text and the salt, a text or a column."""
    text = key.cast("string")
    salted = isinstance(salt, Column) or salt != ""
    digest = F.md5(F.concat(F.lit(salt), text) if salted else text)
    return F.conv(F.substring(digest, 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def unit_hash(key: Column, salt: str | Column = "") -> Column:
    """Uniform number in [0, 1): the hash over its range."""
    return hash_number(key, salt) / F.lit(HASH_RANGE)
