"""Dates of the opportunity report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def created_at(text: Column) -> Column:
    """ISO date-time with fraction and trailing ``Z``; NULL on other text."""
    return F.try_to_timestamp(F.rtrim(text, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))


def short_date(text: Column) -> Column:
    """``M/d/yy``; the years 69 to 99 belong to the last century. NULL on other text."""
    parsed = F.to_date(F.try_to_timestamp(text, F.lit("M/d/yy")))
    return F.when(F.year(parsed) > 2068, F.add_months(parsed, -1200)).otherwise(parsed)


def days_between(close: Column, created: Column) -> Column:
    """Whole days from ``created`` to ``close``, rounded down."""
    seconds = F.unix_micros(close.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))
    return F.floor(seconds / F.lit(86_400_000_000)).cast("bigint")
