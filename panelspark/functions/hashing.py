"""Reproducible pseudo-random numbers: functions of (seed, row key), free of partitioning.

Keys should be integer or string columns; the text form of floating-point numbers differs
between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(keys: list[str | Column], seed: int | str = 42) -> Column:
    """32 hex digits of md5(seed | key | key ...)."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hex_number(h: Column, start: int, digits: int) -> Column:
    """Integer value of a slice of hex digits (at most 15)."""
    return F.conv(F.substring(h, start, digits), 16, 10).cast("bigint")


def uniform(h: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Uniform number in [lo, hi) from the first 8 hex digits."""
    u = hex_number(h, 1, 8) / F.lit(4294967296.0)
    return u if (lo, hi) == (0.0, 1.0) else F.lit(lo) + u * F.lit(hi - lo)


def normal(h: Column, mean: float = 0.0, std: float = 1.0) -> Column:
    """Approximately normal number: centred sum of the first 12 bytes (integer arithmetic)."""
    total = F.lit(0).cast("bigint")
    for start in (1, 13):
        word = hex_number(h, start, 12)
        for shift in range(0, 48, 8):
            total = total + F.shiftright(word, shift).bitwiseAND(F.lit(255))
    z = (total + F.lit(6)) / F.lit(256.0) - F.lit(6.0)
    return z if (mean, std) == (0.0, 1.0) else F.lit(mean) + z * F.lit(std)
