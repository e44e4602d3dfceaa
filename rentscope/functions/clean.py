"""Column-level cleaning rules used by staging, silver and the company notes.

All of these are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the source rules): property types whose room count
# is forced to 0 and whose baths / garages / admin fee default to 0 when NULL.
NON_RESIDENTIAL_TYPES = (
    "local comercial", "bodega", "oficina", "consultorio",
    "edificio de oficinas", "casa lote", "lote", "edificio de apartamentos",
)

# Text that means "no zone".
BLANK_MARKERS = ("", "-")

# Fixed patterns for the company table's numeric text.
UNSIGNED_INT = r"^[0-9]+$"
UNSIGNED_MONEY = r"^[0-9]+(\.[0-9]+)?$"
SIGNED_MONEY = r"^-?[0-9]+(\.[0-9]+)?$"


def _is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _is_fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType))


def digits_int(c: Column, dtype: T.DataType | None = None) -> Column:
    """Keep digits only, then a safe int cast: '5+' -> 5, '' -> NULL.

    Numeric inputs are cast directly (3.0 -> 3), because the text route
    would read '3.0' as 30.
    """
    if dtype is not None and _is_integral(dtype):
        return c.try_cast("int")
    if dtype is not None and _is_fractional(dtype):
        return F.bround(c.cast("double")).try_cast("int")
    return F.regexp_replace(c.cast("string"), r"[^0-9]+", "").try_cast("int")


def safe_int(c: Column, dtype: T.DataType | None = None) -> Column:
    """Safe int: NULL on junk.  Text rounds half up, doubles half to even."""
    if dtype is not None and _is_integral(dtype):
        return c.try_cast("int")
    if dtype is not None and _is_fractional(dtype):
        return F.bround(c.cast("double")).try_cast("int")
    return F.round(c.cast("string").try_cast("double")).try_cast("int")


def blank_to_null(c: Column, markers=BLANK_MARKERS) -> Column:
    return F.when(c.isin(*markers), F.lit(None).cast("string")).otherwise(c)


def is_non_residential(type_col: Column, types=NON_RESIDENTIAL_TYPES) -> Column:
    return F.lower(type_col).isin(*types)


def strip_dollar(c: Column) -> Column:
    return F.replace(c, F.lit("$"), F.lit(""))


def money(c: Column) -> Column:
    """Money text after '$' removal, as double (exact parse of digit text)."""
    return strip_dollar(c).cast("decimal(38,2)").cast("double")


def col_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
