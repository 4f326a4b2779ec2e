"""Column-level helpers shared by every operator. All are plain Spark expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def csum(cond: Column, value: ColumnOrName | int = 1) -> Column:
    """Conditional sum: ``SUM(CASE WHEN cond THEN value ELSE 0 END)``."""
    v = F.lit(value) if isinstance(value, int) else col(value)
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))


def cavg(cond: Column, value: ColumnOrName) -> Column:
    """Conditional average: ``AVG(CASE WHEN cond THEN value END)`` (NULL rows skipped)."""
    return F.avg(F.when(cond, col(value)))


def share(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` as DOUBLE: NULL when the denominator is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def share0(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Guarded share with ``ELSE 0.0``: 0.0 when the denominator is 0 or NULL."""
    return F.coalesce(share(num, den), F.lit(0.0))


def safe_double(c: ColumnOrName) -> Column:
    """Non-strict numeric cast (``try_cast``): bad text becomes NULL instead of failing."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def safe_int(c: ColumnOrName) -> Column:
    return F.expr(f"try_cast({c} AS BIGINT)") if isinstance(c, str) else c.try_cast("bigint")


def concat_skip_null(*cols: ColumnOrName, sep: str = "") -> Column:
    """String concatenation that skips NULL parts, the way DuckDB's ``CONCAT`` does."""
    return F.concat_ws(sep, *[col(c) for c in cols])


def count_not_null(*cols: ColumnOrName) -> Column:
    """Horizontal count of non-null values (``sum_horizontal(is_not_null)``)."""
    return reduce(add, [col(c).isNotNull().cast("int") for c in cols])


def mmss_to_seconds(c: ColumnOrName) -> Column:
    """``MM:SS`` text to seconds; malformed text gives NULL."""
    text = col(c)
    minutes = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")
    return minutes * 60 + seconds


def round_half_up(c: ColumnOrName, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` on DOUBLE.

    Written out instead of ``round`` so that every engine rounds the same double the
    same way: Spark's ``round`` works on the shortest decimal text of the double, other
    engines on its binary value, and the two disagree when a value sits on a tie.
    """
    scale = float(10 ** digits)
    v = col(c).cast("double")
    # Beyond 2^53 / 10^d the scaled value is no longer an exact integer (and would overflow
    # the BIGINT floor): such magnitudes carry no digits at that scale and stay as they are.
    return F.when(F.abs(v) < 9e15 / scale, F.floor(v * scale + 0.5) / scale).otherwise(v)


def r6(c: ColumnOrName) -> Column:
    """Round a double metric to 6 decimals for reporting (order-independent hashes)."""
    return round_half_up(c, 6)


def money(c: ColumnOrName) -> Column:
    """Exact cents for money columns: sum these, then convert once."""
    return col(c).cast("decimal(18,2)")
