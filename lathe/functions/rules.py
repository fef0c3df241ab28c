"""Rule-driven flags and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lathe.functions.text import safe_name


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_flags(c, patterns: dict[str, str]) -> list[Column]:
    """One 0/1 flag per regex (several may fire); NULL text -> NULL flag.
    Return all flags so the caller puts them in one ``select``."""
    return [_c(c).rlike(p).cast("int").alias(name) for name, p in patterns.items()]


def first_match_label(c, rules: list[tuple[str, str]], null_label: str = "unknown",
                      default: str = "other") -> Column:
    """Exclusive label: the first matching rule wins."""
    expr = F.when(_c(c).isNull(), F.lit(null_label))
    for label, pattern in rules:
        expr = expr.when(_c(c).rlike(pattern), F.lit(label))
    return expr.otherwise(F.lit(default))


def tier_label(c, edges: list[tuple[str, float | None, float | None]],
               default: str | None = None) -> Column:
    """Half-open intervals ``lo <= x < hi`` (``None`` = unbounded)."""
    expr = None
    for label, lo, hi in edges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (_c(c) >= F.lit(lo))
        if hi is not None:
            cond = cond & (_c(c) < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def one_hot_to_label(cols: dict[str, str], default: str = "Unknown") -> Column:
    """Name of the first hot indicator column, else ``default``."""
    return F.coalesce(*[F.when(F.col(col) == 1, F.lit(name)) for name, col in cols.items()],
                      F.lit(default))


def one_hot_fixed(c, values: list[str], prefix: str) -> list[Column]:
    return [(_c(c) == F.lit(v)).cast("int").alias(f"{prefix}_{safe_name(v)}") for v in values]


def multi_hot_contains(c, options: list[str], prefix: str) -> list[Column]:
    """0/1 per option by literal substring (NULL text -> NULL)."""
    return [_c(c).contains(o).cast("int").alias(f"{prefix}_{safe_name(o)}") for o in options]
