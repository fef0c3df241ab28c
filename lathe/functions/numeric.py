"""Numeric scalars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """NULL -> literal per column, all in one projection; absent columns are
    ignored (schema-tolerant)."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def fill_nan(c, value: float = 0.0) -> Column:
    """NaN -> value (NULL stays NULL)."""
    return F.nanvl(_c(c), F.lit(float(value)))


def sum_columns(*cols) -> Column:
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def log1p_target(c) -> Column:
    return F.log1p(_c(c))


def expm1_inverse(c) -> Column:
    return F.expm1(_c(c))


def safe_ratio(num, den) -> Column:
    """A zero denominator is replaced by 1 before dividing."""
    d = _c(den)
    return _c(num) / F.when(d == 0, F.lit(1)).otherwise(d)


def smoothed_ratio(num, den) -> Column:
    return _c(num) / (_c(den) + F.lit(1))


def interaction(a, b) -> Column:
    return _c(a) * _c(b)


def square(a) -> Column:
    return _c(a) * _c(a)


def row_mean(cols) -> Column:
    """Mean across columns ignoring NULLs; all-NULL rows give NULL."""
    s = reduce(lambda a, b: a + b, [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [_c(c).isNotNull().cast("int") for c in cols])
    return s / F.nullif(n, F.lit(0))


def row_sum_clip(cols) -> Column:
    """``clip(1 - sum(flags), 0, 1)``: the "none of the above" flag."""
    s = reduce(lambda a, b: a + b, [_c(c) for c in cols])
    return F.least(F.greatest(F.lit(1) - s, F.lit(0)), F.lit(1))
