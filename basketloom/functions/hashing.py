"""Seeded, engine-independent hashing: draws for sampling and codes for categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_key(seed: int, *columns: str) -> Column:
    """A uniform 32-digit hex key per row; ordering by it is a reproducible shuffle."""
    parts = [F.lit(str(seed))] + [F.col(name).cast("string") for name in columns]
    return F.md5(F.concat_ws("|", *parts))


def hex_digits(key: Column, width: int = 3, count: int = 4) -> list[Column]:
    """Cut a hex key into ``count`` pieces of ``width`` digits, most significant first."""
    return [F.substring(key, 1 + width * i, width) for i in range(count)]


def category_code(value: Column) -> Column:
    """52 bits of the md5 of a category as a double (exact, no two-step rounding)."""
    return F.conv(F.substring(F.md5(value), 1, 13), 16, 10).cast("double")
