"""Date and time scalars."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str = "M/d/yyyy H:mm:ss") -> Column:
    """Lenient parse: unparsable text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


def iso_weekday(c) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_c(c)) + F.lit(1)


def timestamp_parts(c, prefix: str = "") -> list[Column]:
    return [F.month(_c(c)).alias(f"{prefix}month"),
            iso_weekday(c).alias(f"{prefix}day_of_week"),
            F.hour(_c(c)).alias(f"{prefix}hour")]


def days_between(later, earlier, fill: int | None = None) -> Column:
    d = F.datediff(_c(later), _c(earlier))
    return d if fill is None else F.coalesce(d, F.lit(fill))
