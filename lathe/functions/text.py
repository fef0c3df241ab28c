"""String scalars (P01-P08, P14, P23, P24).  All are built-in Catalyst
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_name(value: str, max_len: int | None = None) -> str:
    """Column-name-safe, lower-case form of a category value."""
    s = re.sub(r"[^a-zA-Z0-9]", "_", str(value)).lower()
    return s[:max_len] if max_len else s


def safe_names(values: list, max_len: int | None = None) -> list[str]:
    """``safe_name`` of each value; names that would repeat get ``_2``, ``_3`` …"""
    taken, out = set(), []
    for v in values:
        base = name = safe_name(v, max_len)
        k = 2
        while name in taken:
            name, k = f"{base}_{k}", k + 1
        taken.add(name)
        out.append(name)
    return out


def strip_blanks(c) -> Column:
    """Without leading and trailing white space (blanks, tabs, line breaks)."""
    return F.btrim(_c(c), F.lit(" \t\n\r\f\x0b"))


def parse_amount(c, strict: bool = True) -> Column:
    """``"1,250,000"`` -> 1250000.0.  Strict casts raise on bad text (ANSI),
    lenient ones give NULL."""
    s = F.regexp_replace(_c(c).cast("string"), ",", "")
    return s.cast("double") if strict else s.try_cast("double")


def parse_price(c) -> Column:
    """``"$1,234.00"`` -> 1234.0, unparsable -> NULL."""
    return F.translate(_c(c).cast("string"), "$,", "").try_cast("double")


def parse_percent(c) -> Column:
    """``"97%"`` -> 97.0, ``"N/A"`` -> NULL."""
    return F.translate(_c(c).cast("string"), "%", "").try_cast("double")


def lacks_prefix(c, prefix: str) -> Column:
    return ~_c(c).startswith(prefix)


def normalize_text(c, mode: str = "letters") -> Column:
    """``letters``: lower, drop everything but ASCII letters and blanks, trim.
    ``dots``: drop dots, trim, lower."""
    if mode == "letters":
        return strip_blanks(F.regexp_replace(F.lower(_c(c)), r"[^a-zA-Z\s]", ""))
    if mode == "dots":
        return F.lower(strip_blanks(F.regexp_replace(_c(c), r"\.", "")))
    raise ValueError(mode)


def canonicalize(c, rules: list[tuple[str, str]], default=None) -> Column:
    """First rule whose substring occurs wins: ``[(substring, label), ...]``."""
    expr = None
    for sub, label in rules:
        cond = _c(c).contains(sub)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default) if default is not None else _c(c))


def normalize_range_label(c) -> Column:
    """``"5-7 years"`` -> ``"5 - 7 years"`` (also the singular form)."""
    return F.regexp_replace(strip_blanks(c), r"^(\d+)-(\d+)\s+(years?)$", "$1 - $2 $3")


def parse_flag(c, true_value: str = "t", null_as: bool | None = None) -> Column:
    """``'t'`` -> true, anything else -> false; NULL stays NULL unless
    ``null_as`` is given."""
    out = _c(c) == F.lit(true_value)
    return out if null_as is None else F.coalesce(out, F.lit(null_as))


def text_length(c, unit: str = "bytes") -> Column:
    return F.octet_length(_c(c)) if unit == "bytes" else F.char_length(_c(c))


def word_count(c, sep: str = " ") -> Column:
    """Tokens of a plain split on ``sep``; empty tokens count (as a split
    keeps them); NULL text gives NULL."""
    return F.size(F.split(_c(c), re.escape(sep), -1))


def text_length_features(df: DataFrame, cols: list[str], unit: str = "bytes",
                         drop: bool = True) -> DataFrame:
    """``<col>_length`` and ``<col>_word_count`` for every present text
    column, in one projection; the text columns are dropped afterwards."""
    present = [c for c in cols if c in df.columns]
    new = []
    for c in present:
        new += [text_length(c, unit).cast("int").alias(f"{c}_length"),
                word_count(c).cast("int").alias(f"{c}_word_count")]
    keep = [c for c in df.columns if not (drop and c in present)]
    return df.select(*keep, *new)


def format_percent(x, digits: int = 1) -> Column:
    return F.concat(F.round(_c(x), digits).cast("string"), F.lit("%"))


def parse_percent_text(c) -> Column:
    return F.regexp_replace(_c(c), "%", "").try_cast("double")


def split_explode_distinct(df: DataFrame, col: str, sep: str = ",",
                           out: str = "token") -> DataFrame:
    """Vocabulary of a multi-value text column: split, trim, distinct,
    empty tokens dropped."""
    tok = df.select(F.explode(F.split(F.col(col), re.escape(sep), -1)).alias(out))
    return tok.select(strip_blanks(out).alias(out)).where(F.col(out) != "").distinct()
