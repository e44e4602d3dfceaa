"""Exact rounding of ratios and averages.

ROUND(AVG(x), d) is decided by integer arithmetic on decimals (half away from
zero), so the answer does not depend on float summation order or on how an
engine rounds binary ties.  Sums are decimal(38): 10^12 rows of values up to
10^14 stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6  # decimals kept of each averaged value
WHOLE = "decimal(38,0)"


def _rounded(num: Column, den: Column) -> Column:
    """num / den to the nearest integer, half away from zero (NULL unless den > 0)."""
    n, d = num.cast(WHOLE), den.cast(WHOLE)
    top = (2 * F.abs(n) + d).cast(WHOLE)
    twice = (2 * d).cast(WHOLE)
    # a multiple of the divisor: the division is exact
    q = ((top - top % twice).cast(WHOLE) / twice).cast(WHOLE)
    return F.when(d > 0, F.when(n < 0, -q).otherwise(q))


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """num / den rounded half away from zero to ``digits`` decimals, exactly.

    ``num`` and ``den`` are integral; den > 0 (NULL otherwise).  The result is
    a decimal with ``digits`` decimals."""
    q = _rounded(num.cast(WHOLE) * (10 ** digits), den)
    return (q.cast(f"decimal(38,{digits})") / (10 ** digits)).cast(f"decimal(38,{digits})")


def avg_rounded(x: Column, digits: int, scale: int = SCALE) -> Column:
    """ROUND(AVG(x), digits) as a double, of values kept to ``scale`` decimals
    (aggregate; ``digits`` <= ``scale``)."""
    total = F.sum(x.cast(f"decimal(28,{scale})"))
    units = (total * F.lit(10 ** scale).cast("decimal(7,0)")).cast(WHOLE)
    q = _rounded(units, F.count(x).cast(WHOLE) * (10 ** (scale - digits)))
    return (q.cast(f"decimal(38,{digits})") / (10 ** digits)).cast("double")


# DuckDB text for the oracle SQL: the plain form, in the engine's own arithmetic.
def sql_avg_rounded(x: str, digits: int) -> str:
    return f"round(avg(CAST({x} AS DECIMAL(28,6))), {digits})"
