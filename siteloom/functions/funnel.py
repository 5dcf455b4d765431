"""Rows left after each of a list of filters, counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def funnel(df: DataFrame, filters: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(step_no, step, n_rows), after the columns ``by`` that are counted apart.

    Step 0 is "all", then the rows passing the filters up to each one.
    """
    names, counts, passed = ["all", *filters], [F.count(F.lit(1)).alias("c0")], F.lit(True)
    for i, condition in enumerate(filters.values(), start=1):
        passed = passed & condition
        counts.append(F.count_if(passed).alias(f"c{i}"))
    steps = [
        F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"c{i}").alias("n_rows"))
        for i, n in enumerate(names)
    ]
    return df.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*steps)))
