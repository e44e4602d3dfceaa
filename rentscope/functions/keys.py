"""Surrogate keys: md5 over text that is identical across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """Canonical text of a key part.

    Float text is not portable (1.0E7 vs 10000000.0), so fractional parts are
    rendered through decimal(38,10); everything else is a plain string cast.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.cast("decimal(38,10)").cast("string")
    return c.cast("string")


def concat_skip_nulls(*parts: Column) -> Column:
    """CONCAT that skips NULL parts (the warehouse dialect's rule)."""
    return F.concat_ws("", *parts)


def surrogate_key(*parts: Column, sep: str = "-", null_as: str | None = None) -> Column:
    """md5 hex of parts joined by ``sep``; NULL parts skipped or replaced."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(p, F.lit(null_as)) if null_as is not None else p)
    return F.md5(concat_skip_nulls(*pieces))
