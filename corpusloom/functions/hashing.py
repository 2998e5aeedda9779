"""Seeded hashing in place of random numbers, so that a re-run task draws the same values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13
HASH_SPAN = 16**HEX_DIGITS


def seeded_digest(seed: int, *parts: Column | str) -> Column:
    """md5 of ``seed:part:part…`` as hexadecimal text."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def digest_integer(digest: Column, digits: int = HEX_DIGITS) -> Column:
    """The leading hexadecimal digits of a digest as BIGINT."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def uniform(seed: int, *parts: Column | str) -> Column:
    """A value strictly between 0 and 1 that depends only on the seed and the parts."""
    return (digest_integer(seeded_digest(seed, *parts)) + F.lit(0.5)) / F.lit(float(HASH_SPAN))
