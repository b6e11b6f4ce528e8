"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read without recomputing them.

    A filter on an ordinary projected column is pushed below the projection, which evaluates
    its expression again for every use. A generator of one row is not crossed by that rule, so
    an expensive expression such as a JSON parse runs once per row.
    """
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(packed)))


def name(column: str) -> Column:
    """Reference a column whose name may hold spaces, dots or ``#``."""
    return F.col("`" + column.replace("`", "``") + "`")
