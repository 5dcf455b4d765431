"""Columns that filters above must not pull apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) columns so that they are evaluated exactly once per row.

    A filter on a projected column is pushed below the projection by substituting the whole expression,
    which then runs in the filter and again in the projection, and nested ones multiply. Emitting the columns
    from a one-row generator stops the substitution; filters on other columns still pass.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
