"""Interval joins as equi-joins on position bins.

A point lies in one bin; an interval is repeated over every bin it covers, so a (contig, bin) equi-join
plus the exact range predicate finds each pair once. No pair outside a shared bin is ever formed, and a
whole contig never becomes one join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.session import BROADCAST_MAX_ROWS, fits_broadcast, small_side

# Entries that a broadcast index may hold, in all its arrays together: at about 300 bytes an entry this is 30 MB.
INDEX_MAX_ENTRIES = 100_000


def bin_of(pos, width: int):
    return F.floor(pos / F.lit(width)).cast("bigint")


def bin_intervals(intervals: DataFrame, start, end, width: int) -> DataFrame:
    """Repeat each interval over the bins of [start, end]; adds ``_bin``."""
    first, last = bin_of(F.greatest(start, F.lit(0)), width), bin_of(end, width)
    return intervals.where(end >= F.greatest(start, F.lit(0))).withColumn("_bin", F.explode(F.sequence(first, last)))


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    contig: str,
    pos: str,
    start: str,
    end: str,
    pad: int = 0,
    width: int = 500_000,
    how: str = "inner",
    salts: int = 16,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Join points to the intervals with ``start - pad <= pos <= end + pad`` on the same contig.

    Intervals are broadcast if their rows, repeated over the bins they cover, were counted to be few; then the points
    are not shuffled. Otherwise both sides are
    shuffled by (contig, bin, salt): the points of a crowded bin spread over ``salts`` tasks by a hash of
    their columns, and each interval is sent to all of them.
    """
    low, high = F.col(start) - pad, F.col(end) + pad
    left = points.withColumn("_bin", bin_of(F.col(pos), width))
    right = bin_intervals(intervals, low, high, width)
    keys = [contig, "_bin"]
    if fits_broadcast(right, max_broadcast_rows):
        right = F.broadcast(right)
    elif salts > 1:
        atomic = [f.name for f in points.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*atomic), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("_salt")
    left, right = left.alias("p"), right.alias("i")
    same_bin = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in keys]
    condition = (F.col(f"p.{pos}") >= low) & (F.col(f"p.{pos}") <= high)
    for equal in same_bin:
        condition = condition & equal
    kept = [F.col(f"p.{c}") for c in points.columns]
    kept += [F.col(f"i.{c}") for c in intervals.columns if c != contig]
    return left.join(right, condition, how).select(*kept)


def interval_index(intervals: DataFrame, *, contig: str, start: str, end: str, width: int, entry: Column) -> DataFrame:
    """One row for each bin that some interval [start, end] touches: contig, ``_bin`` and the sorted array ``entries``.

    A point joined to its one bin row looks through the array in the row, so it stays one row however many
    intervals overlap there. An array holds as many entries as intervals touch its bin: choose ``width`` for few.
    """
    binned = bin_intervals(intervals, F.col(start), F.col(end), width)
    return binned.groupBy(contig, "_bin").agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def index_join(
    points: DataFrame,
    index: DataFrame,
    *,
    contig: str,
    pos: str,
    width: int,
    salts: int = 4,
    max_broadcast_rows: int = INDEX_MAX_ENTRIES,
) -> DataFrame:
    """Every point once, with the ``entries`` of its bin (NULL where no interval touches it).

    The index is broadcast if its entries, not its bins, were counted to be few: a row is as long as its array.
    Otherwise the points of a crowded bin are dealt to ``salts`` by a hash of their columns and the bin's row is
    repeated for each; both sides are then sorted and merged.
    """
    left, keys = points.withColumn("_bin", bin_of(F.col(pos), width)), [contig, "_bin"]
    if (index.agg(F.sum(F.size("entries"))).first()[0] or 0) <= max_broadcast_rows:
        index = F.broadcast(index)
    elif salts > 1:
        atomic = [f.name for f in points.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*atomic), F.lit(salts)).cast("int"))
        index = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
        keys.append("_salt")
    return left.join(index, keys, "left").select(*points.columns, "entries")


def pairs_within(
    sites: DataFrame, *, contig: str, pos: str, key: str, window: int, crowd: int | None = None, keep: Column | None = None
) -> DataFrame:
    """Self-join of sites: each unordered pair on one contig at most ``window`` apart, once.

    The left site (lower position, then lower key) looks in its own bin and the next one only. Columns of
    the two sides come out as ``a_<name>`` and ``b_<name>``. With ``crowd``, the right sites of a bin that holds
    more than so many are dealt to salts, and the left sites that look there are sent to all of them; other bins
    have one salt. ``keep`` is a further condition on ``a_`` and ``b_`` columns; it is part of the join, so other
    pairs are never made into rows.
    """
    own = [c for c in sites.columns if c != contig]
    here = bin_of(F.col(pos), window)
    left = sites.select(contig, *[F.col(c).alias(f"a_{c}") for c in own], F.explode(F.array(here, here + 1)).alias("_bin"))
    right = sites.select(contig, *[F.col(c).alias(f"b_{c}") for c in own], here.alias("_bin"))
    keys = [contig, "_bin"]
    if crowd is not None:
        full = right.groupBy(*keys).agg(F.ceil(F.count("*") / crowd).cast("int").alias("_salts")).where("_salts > 1")
        full = small_side(full)
        salts = F.coalesce("_salts", F.lit(1))
        left = left.join(full, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        right = right.join(full, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(f"b_{key}"), salts).cast("int"))
        left, right, keys = left.drop("_salts"), right.drop("_salts"), [*keys, "_salt"]
    gap = F.col(f"b_{pos}") - F.col(f"a_{pos}")
    ordered = (gap > 0) | ((gap == 0) & (F.col(f"a_{key}") < F.col(f"b_{key}")))
    wanted = ordered & (gap <= window)
    return left.join(right, keys).where(wanted if keep is None else wanted & keep).drop("_bin", "_salt")
