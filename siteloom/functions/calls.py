"""Expressions over one genotype's ``calls`` array (-1 marks a missing allele)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = -1


def is_called(calls: Column) -> Column:
    """All alleles present; a NULL call counts as missing."""
    return F.coalesce(~F.array_contains(calls, MISSING), F.lit(False))


def blank_half_call(calls: Column) -> Column:
    """A call with any missing allele becomes wholly missing."""
    return F.when(F.array_contains(calls, MISSING), F.array(F.lit(MISSING), F.lit(MISSING))).otherwise(calls)


def is_hom_ref(calls: Column) -> Column:
    return (F.get(calls, F.lit(0)) == 0) & (F.get(calls, F.lit(1)) == 0)


def is_hom_alt(calls: Column) -> Column:
    return (F.get(calls, F.lit(0)) == 1) & (F.get(calls, F.lit(1)) == 1)


def is_het_ref_alt(calls: Column) -> Column:
    return F.array_contains(calls, 0) & F.array_contains(calls, 1)


def alt_dosage(calls: Column) -> Column:
    """Number of alternate alleles, NULL when the call is missing."""
    return F.when(is_called(calls), F.size(calls) - F.size(F.filter(calls, lambda a: a == 0)))


def alt_fraction(depths: Column) -> Column:
    """AD1 / (AD0 + AD1); NULL when the depths are absent or sum to zero."""
    ref, alt = F.get(depths, F.lit(0)), F.get(depths, F.lit(1))
    return F.try_divide(alt, ref + alt)


def low_mid_high(ordered: Column) -> tuple[Column, Column, Column]:
    """Smallest, upper-median and largest element of a sorted array; NULLs when it is empty."""
    n = F.size(ordered)
    return (
        F.get(ordered, F.lit(0)),
        F.get(ordered, F.floor(n / 2).cast("int")),
        F.get(ordered, n - 1),
    )
