"""Connected components of a link table, by alternating large-star and small-star steps.

Source: Kiveris et al., "Connected components in MapReduce and beyond" (2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm.shared import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or its not larger) neighbours to the least of its neighbours and itself."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    seen = both.join(least, "u")
    if large:
        made = seen.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return made.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its least node.

    Self-links and repeated or reversed links are allowed. Each round is written to the shared folder; the result
    is a set of stars, reached when a round changes nothing.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        now = written(_stars(_stars(now, large=True), large=False), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    return tuple(row)
