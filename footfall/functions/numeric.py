"""Numeric column builders and frame-wide fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_value(c) -> Column:
    """natural log; NaN is turned into null first (trap T6).  ln(0) is
    null in Spark (the original gave -inf)."""
    x = _c(c).cast("double")
    return F.log(F.nanvl(x, F.lit(None).cast("double")))


def exp_value(c) -> Column:
    """F15."""
    return F.exp(_c(c))


def threshold_flag(c, threshold: float) -> Column:
    """1.0 when value >= threshold, else 0.0 (missing -> 0.0)."""
    return F.when(_c(c) >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def clip_negative(c) -> Column:
    """Negatives -> 0.0; a missing value stays missing (not ``greatest``)."""
    x = _c(c)
    return F.when(x < 0, F.lit(0.0)).otherwise(x.cast("double"))


def masked_update(cond, a, b) -> Column:
    """P10: keep ``a`` where ``cond`` else ``b``."""
    return F.when(_c(cond), _c(a)).otherwise(_c(b))


def round_display(c, digits: int = 1) -> Column:
    """Half-even rounding, as NumPy's ``round``."""
    return F.bround(_c(c), digits)


def fill_missing(df: DataFrame, value: int = -1) -> DataFrame:
    """Fill null (and NaN) in numeric columns only (trap T14)."""
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        return df
    return df.na.fill(value, subset=numeric)
