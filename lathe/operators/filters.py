"""Filters and predicates (F01-F11).  Plain ``filter``s so Catalyst pushes
them into the parquet scan where the column allows it."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filter_range(df: DataFrame, col: str, lo=None, hi=None, equals: dict | None = None) -> DataFrame:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) <= F.lit(hi))
    for k, v in (equals or {}).items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)


def match_ci_either(a, b, value: str) -> Column:
    """Case-insensitive equality on either column; NULLs count as no match."""
    v = F.lit(value.upper())
    return F.coalesce(F.upper(_c(a)) == v, F.lit(False)) | F.coalesce(F.upper(_c(b)) == v, F.lit(False))


def drop_nulls(df: DataFrame, subset=None) -> DataFrame:
    subset = [c for c in (subset or df.columns) if c in df.columns]
    return df.na.drop("any", subset=subset) if subset else df


def drop_all_nulls(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with no NULL, plus a one-pass report (rows before / kept / lost)."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns])
    report = df.agg(F.count(F.lit(1)).alias("rows_before"),
                    F.count_if(complete).alias("rows_after"))
    report = report.withColumn("rows_lost", F.col("rows_before") - F.col("rows_after"))
    return df.filter(complete), report


def filter_regex_not(df: DataFrame, col: str, pattern: str, case_insensitive: bool = True) -> DataFrame:
    """Drop rows whose text matches; rows with NULL text go too (the
    predicate is NULL)."""
    rx = ("(?i)" if case_insensitive else "") + pattern
    return df.filter(~F.col(col).rlike(rx))


def fit_mean_std(df: DataFrame, col: str) -> tuple[float, float]:
    """Mean and population std of a column: one aggregate, two scalars."""
    r = df.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("s")).first()
    return r["m"], r["s"]


def filter_zscore(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Keep ``|x - mean| / pop_std <= k`` (statistics fitted in one pass)."""
    m, s = fit_mean_std(df, col)
    if not s:
        return df
    return df.filter(F.abs((F.col(col) - F.lit(m)) / F.lit(s)) <= F.lit(k))


def filter_upper_cap(df: DataFrame, col: str, cap) -> DataFrame:
    return df.filter(F.col(col) < F.lit(cap))


def filter_in_list(df: DataFrame, col: str, values) -> DataFrame:
    """Membership: a literal list becomes ``IN``; a DataFrame of values a
    left-semi join (AQE broadcasts it once it has measured its size)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias("_v")).distinct()
        return df.join(v, F.col(col) == F.col("_v"), "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def filter_text_length(df: DataFrame, col: str, max_len: int) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.length(col) > 0) & (F.length(col) <= max_len))


def contains_any(c, words) -> Column:
    """Any literal substring occurs (one alternation regex, quoted)."""
    rx = "|".join(re.escape(w) for w in words)
    if not rx:  # no words: nothing occurs
        return F.lit(False)
    return _c(c).rlike(rx)


def anti_filter(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where the predicate holds; NULL predicate keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))
