"""Reading schemaless JSON values (``VARIANT``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LONG_LIMIT = float(2**63)


def kind(value: Column) -> Column:
    """Type name of a variant value: STRING, BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, VOID, ..."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def is_number(value: Column) -> Column:
    k = kind(value)
    return F.coalesce((k == "BIGINT") | (k == "DOUBLE") | k.startswith("DECIMAL"), F.lit(False))


def absent(value: Column) -> Column:
    """True for a missing path and for JSON null."""
    return value.isNull() | F.is_variant_null(value)


def number_to_long(value: Column) -> Column:
    """A JSON number as a long: truncated toward zero, clamped at the ends of the range."""
    real = F.try_variant_get(value, "$", "double")
    return (
        F.when(real >= F.lit(_LONG_LIMIT), F.lit(2**63 - 1))
        .when(real <= F.lit(-_LONG_LIMIT), F.lit(-(2**63)))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "bigint"), real.cast("bigint")))
    )
