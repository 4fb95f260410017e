"""Numeric helpers that keep decimal results bit-compatible with the SQL oracle.

Rules (see SURVEY §1.4):
* double -> NUMERIC(18,4) rounds ``x * 10^4`` half away from zero. A plain
  ``cast(double as decimal)`` rounds the decimal expansion of ``x`` instead and
  disagrees on a few ratios, so ``to_dec4`` scales and rounds explicitly.
* decimal / integer is a DOUBLE ratio; cast the numerator to double first
  (ANSI decimal division would widen to decimal(38, s) instead).
* an average of NUMERIC(18,4) is computed from the exact scaled sum and the
  count, then rounded with ``to_dec4``.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

DEC4 = "decimal(18,4)"


def to_dec4(c: Column) -> Column:
    """double (or decimal) -> decimal(18,4), rounding half away from zero on x*1e4."""
    scaled = F.round(c.cast("double") * F.lit(10000.0))
    return (scaled.cast("decimal(20,0)") / F.lit(10000)).cast(DEC4)


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (ANSI-safe)."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def safe_ratio(num: Column, den: Column) -> Column:
    """``x / nullif(y, 0)`` as a double."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def avg_dec4(x: Column, window: WindowSpec) -> Column:
    """Windowed average of a decimal(18,4) column, rounded to decimal(18,4)."""
    scaled_sum = (F.sum(x).over(window) * F.lit(10000)).cast("bigint").cast("double")
    n = F.count(x).over(window)
    return to_dec4(F.when(n > 0, scaled_sum / n.cast("double") / F.lit(10000.0)))


def agg_avg_exact(x: Column) -> Column:
    """Grouped average of a decimal(18,4) column as a double: the exact scaled sum by the count."""
    scaled_sum = (F.sum(x) * F.lit(10000)).cast("bigint").cast("double")
    n = F.count(x)
    return F.when(n > 0, scaled_sum / n.cast("double") / F.lit(10000.0))


def avg_double_dec4(x: Column, window: WindowSpec) -> Column:
    """Windowed average of a double column, then decimal(18,4)."""
    return to_dec4(F.avg(x.cast("double")).over(window))


def within_tolerance(a: Column, b: Column, tol: float = 0.0001) -> Column:
    """``abs(a - b) < tol`` — the reference's float-equality check."""
    return F.abs(a.cast("double") - b.cast("double")) < F.lit(tol)
