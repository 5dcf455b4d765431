"""Exact Hardy-Weinberg tests on (homRef, het, homAlt) counts, mid-p corrected.

Given the allele counts, P(h) of h heterozygotes follows from its neighbour by one multiplication
(Wigginton, Cutler & Abecasis 2005):
``P(h-2)/P(h) = h(h-1) / (4(r+1)(c+1))`` and ``P(h+2)/P(h) = 4rc / ((h+2)(h+1))`` with r, c the rarer
and commoner homozygotes at h. Two folds walk down and up from the observed h with weight 1, so the
test is row-local: no log-gamma, no exploded support and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIE = 1e-9  # relative tolerance within which two probabilities count as equal


def _walk(support: Column, ratio) -> Column:
    """Fold (weight, total, tail) over the support; tail holds what is no likelier than observed."""
    zero = F.lit(0.0)
    start = F.struct(F.lit(1.0).alias("w"), zero.alias("total"), zero.alias("tail"))

    def step(state: Column, h: Column) -> Column:
        w = state["w"] * ratio(h)
        tail = F.when(w < 1.0 - TIE, w).when(w <= 1.0 + TIE, w * 0.5).otherwise(0.0)
        return F.struct(w.alias("w"), (state["total"] + w).alias("total"), (state["tail"] + tail).alias("tail"))

    return F.aggregate(support, start, step)


def _steps(keep: Column, first: Column, last: Column, by: int) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(keep, F.sequence(first, last, F.lit(by).cast("bigint"))).otherwise(none)


def walks(hom_ref: Column, het: Column, hom_alt: Column) -> tuple[Column, Column]:
    """(down, up) states of the two folds; stage them as columns, then combine with the p-values."""
    het = het.cast("bigint")
    rare = F.least(hom_ref, hom_alt).cast("bigint")
    common = F.greatest(hom_ref, hom_alt).cast("bigint")
    two = F.lit(2).cast("bigint")

    def down_ratio(h: Column) -> Column:
        moved = (het - h) / 2
        return h * (h - 1.0) / (4.0 * (rare + moved + 1) * (common + moved + 1))

    def up_ratio(h: Column) -> Column:  # h is the heterozygote count stepped to
        moved = (h - 2 - het) / 2
        return 4.0 * (rare - moved) * (common - moved) / (h * (h - 1.0))

    down = _walk(_steps(het >= 2, het, two, -2), down_ratio)
    up = _walk(_steps(rare >= 1, het + 2, het + 2 * rare, 2), up_ratio)
    return down, up


def two_sided_p(down: Column, up: Column) -> Column:
    return (0.5 + down["tail"] + up["tail"]) / (1.0 + down["total"] + up["total"])


def excess_het_p(down: Column, up: Column) -> Column:
    """P(more heterozygotes) + half P(observed), in a form that stays finite in either far tail."""
    return 1.0 / (1.0 + (0.5 + down["total"]) / (0.5 + up["total"]))
