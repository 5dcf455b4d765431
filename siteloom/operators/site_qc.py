"""Site filters, the pass-count funnel and the p-value histogram."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siteloom.functions import alleles
from siteloom.functions.funnel import funnel

# Default thresholds of the site filters.
MIN_CALL_RATE = 0.97
MIN_AF, MAX_AF = 0.01, 0.99
MIN_EXCESS_HET_P = 1e-16
SEX_CONTIGS = ("X", "Y")


def site_filters(
    min_call_rate: float = MIN_CALL_RATE,
    min_af: float = MIN_AF,
    max_af: float = MAX_AF,
    min_excess_het_p: float = MIN_EXCESS_HET_P,
) -> dict[str, Column]:
    """The filters in order, by name, over the output of variant_qc (biallelic rows)."""
    af = F.get("alleleFrequencies", F.lit(1))
    return {
        "call_rate": F.col("callRate") > min_call_rate,
        "allele_frequency": (af > min_af) & (af < max_af),
        "excess_het": F.col("pValueExcessHet") > min_excess_het_p,
        "snp": alleles.is_snp(F.col("referenceAllele"), F.get("alternateAlleles", F.lit(0))),
        "autosome": ~alleles.strip_contig_prefix(F.col("contigName")).isin(*SEX_CONTIGS),
    }


def filter_sites(df: DataFrame, **thresholds) -> DataFrame:
    """Rows passing every filter."""
    kept = df
    for condition in site_filters(**thresholds).values():
        kept = kept.filter(condition)
    return kept


def filter_sites_observed(df: DataFrame, **thresholds) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``filter_sites``, and a function that gives the funnel once the rows were written or otherwise used in full.

    The counts are taken by the filters themselves as the rows pass, so they cost no scan of their own. A second action
    on the same rows doesn't change them; before the first one the function waits. As with all metrics observed in
    passing, a task that is run again after a lost executor may count its rows twice; ``qc_funnel`` never does.
    """
    steps = {"all": None} | site_filters(**thresholds)
    seen, kept = [Observation(f"qc-{i}") for i in range(len(steps))], df
    for watch, condition in zip(seen, steps.values()):
        kept = kept if condition is None else kept.filter(condition)
        kept = kept.observe(watch, F.count(F.lit(1)).alias("n"))

    def counted() -> DataFrame:
        rows = [(i, name, watch.get["n"]) for i, (name, watch) in enumerate(zip(steps, seen))]
        return df.sparkSession.createDataFrame(rows, "step_no int, step string, n_rows bigint")

    return kept, counted


def qc_funnel(df: DataFrame, **thresholds) -> DataFrame:
    """Sites left after each filter in turn, all counted in one pass: (step_no, step, n_rows)."""
    return funnel(df, site_filters(**thresholds))


def log10_p_histogram(df: DataFrame, low: float = -16.0, high: float = 0.0, bins: int = 16) -> DataFrame:
    """Counts of log10(pValueExcessHet) per equal-width bin; 0 and bins+1 hold what lies outside."""
    p = F.col("pValueExcessHet")
    bucket = F.when(p <= 0, 0).otherwise(F.width_bucket(F.log10(p), F.lit(low), F.lit(high), F.lit(bins)))
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_sites"))
