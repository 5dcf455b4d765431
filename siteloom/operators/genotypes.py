"""Row-local work on the nested genotypes array: nothing here explodes or shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import calls, equilibrium
from siteloom.functions.once import compute_once
from siteloom.operators.sites import strip_contig

GENOTYPE_FIELDS = ("sampleId", "phased", "depth", "conditionalQuality", "alleleDepths")


def project_genotypes(df: DataFrame, extra_fields: Sequence[str] = ()) -> DataFrame:
    """Keep the named genotype fields only and blank half calls."""
    fields = [*GENOTYPE_FIELDS, *extra_fields]
    return df.withColumn(
        "genotypes",
        F.transform(
            "genotypes",
            lambda g: F.struct(calls.blank_half_call(g["calls"]).alias("calls"), *[g[f].alias(f) for f in fields]),
        ),
    )


def mark_called(df: DataFrame) -> DataFrame:
    """``called``: one boolean per genotype, kept so a later allele split can tell masked from missing."""
    return df.withColumn("called", F.transform(F.col("genotypes")["calls"], calls.is_called))


def process_genotypes(df: DataFrame, extra_fields: Sequence[str] = ()) -> DataFrame:
    """Strip the contig prefix, project genotypes, mark called ones and drop the raw INFO map."""
    return (
        df.transform(strip_contig).transform(project_genotypes, extra_fields).transform(mark_called).drop("attributes")
    )


def drop_hom_ref(df: DataFrame) -> DataFrame:
    """Remove 0/0 genotypes from the array."""
    hom_ref = lambda g: F.coalesce(calls.is_hom_ref(g["calls"]), F.lit(False))
    return df.withColumn("genotypes", F.filter("genotypes", lambda g: ~hom_ref(g)))


def call_summary_stats(df: DataFrame) -> DataFrame:
    """Per-site call counts: callRate, nCalled, nUncalled, nHet, nHomozygous[], nNonRef, nAllelesCalled,
    alleleCounts[], alleleFrequencies[]; arrays are indexed by allele, reference first.

    The genotypes are visited twice by a lambda; all counts after that are array built-ins.
    """
    staged = (
        df.withColumn("_n", F.size("genotypes"))
        .withColumn("_called", F.filter(F.col("genotypes")["calls"], calls.is_called))
        .withColumn(
            "_zygosity",
            F.transform("_called", lambda c: F.when(F.array_min(c) == F.array_max(c), F.array_min(c)).otherwise(-1)),
        )
        .withColumn("_alleles", F.flatten("_called"))
        .withColumn("_index", F.sequence(F.lit(0), F.size("alternateAlleles")))
    )

    def occurrences(array: str, value) -> F.Column:
        return (F.size(array) - F.size(F.array_remove(array, value))).cast("bigint")

    counted = staged.withColumns(
        {
            "nCalled": F.size("_called").cast("bigint"),
            "nUncalled": (F.col("_n") - F.size("_called")).cast("bigint"),
            "nHet": occurrences("_zygosity", F.lit(-1)),
            "nHomozygous": F.transform("_index", lambda i: occurrences("_zygosity", i)),
            "nAllelesCalled": F.size("_alleles").cast("bigint"),
            "alleleCounts": F.transform("_index", lambda i: occurrences("_alleles", i)),
        }
    )
    return counted.withColumns(
        {
            "callRate": F.try_divide("nCalled", "_n"),
            "nNonRef": F.col("nCalled") - F.get("nHomozygous", F.lit(0)),
            "alleleFrequencies": F.transform("alleleCounts", lambda c: F.try_divide(c, F.col("nAllelesCalled"))),
        }
    ).drop("_n", "_called", "_zygosity", "_alleles", "_index")


def _equilibrium(df: DataFrame, results: dict) -> DataFrame:
    hom_ref = F.get("nHomozygous", F.lit(0))
    hom_alt = F.coalesce(F.get("nHomozygous", F.lit(1)), F.lit(0))
    down, up = equilibrium.walks(hom_ref, F.col("nHet"), hom_alt)
    staged = df.withColumn("_down", down).withColumn("_up", up)
    tested = {name: test(F.col("_down"), F.col("_up")) for name, test in results.items()}
    return staged.withColumns(tested).drop("_down", "_up")


def hardy_weinberg(df: DataFrame) -> DataFrame:
    """Exact two-sided mid-p ``pValueHwe`` of a biallelic site; needs call_summary_stats."""
    return _equilibrium(df, {"pValueHwe": equilibrium.two_sided_p})


def excess_heterozygosity(df: DataFrame) -> DataFrame:
    """Exact one-sided mid-p ``pValueExcessHet``; needs call_summary_stats."""
    return _equilibrium(df, {"pValueExcessHet": equilibrium.excess_het_p})


# The columns call_summary_stats adds.
CALL_STATS = [
    "callRate",
    "nCalled",
    "nUncalled",
    "nHet",
    "nHomozygous",
    "nNonRef",
    "nAllelesCalled",
    "alleleCounts",
    "alleleFrequencies",
]


def variant_qc(df: DataFrame) -> DataFrame:
    """Call statistics plus the excess-heterozygosity test: what the site filters read, ready to be filtered."""
    tested = df.transform(call_summary_stats).transform(excess_heterozygosity)
    return compute_once(tested, {c: F.col(c) for c in [*CALL_STATS, "pValueExcessHet"]})


def mean_impute(df: DataFrame) -> DataFrame:
    """Add ``mean_dosage`` of the site and ``dosages``, each missing call replaced by that mean."""
    staged = df.withColumn("_alt", F.transform(F.col("genotypes")["calls"], calls.alt_dosage))
    total = F.aggregate("_alt", F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0)))
    observed = F.size(F.filter("_alt", lambda d: d.isNotNull()))
    return (
        staged.withColumn("mean_dosage", F.try_divide(total, observed))
        .withColumn(
            "dosages", F.transform("_alt", lambda d: F.coalesce(d.cast("double"), F.col("mean_dosage")))
        )
        .drop("_alt")
    )


def genotype_probabilities(df: DataFrame) -> DataFrame:
    """``gp``: per genotype a one-hot [RR, RA, AA] vector from the hard call, NULL when missing."""

    def one_hot(c):
        dosage = calls.alt_dosage(c)
        return F.when(
            dosage.isNotNull(), F.array(*[F.when(dosage == k, 1.0).otherwise(0.0) for k in range(3)])
        )

    return df.withColumn("gp", F.transform(F.col("genotypes")["calls"], one_hot))


def explode_entries(df: DataFrame, *keys: str, sample_index=None) -> DataFrame:
    """Long layout: one row per (site, sample) with ``n_alt`` (NULL when missing).

    ``sample_index`` maps the genotype struct to the sample's number; by default it is the position in
    the array, which is the sample's column in a population VCF.
    """
    rows = df.select(*keys, F.posexplode("genotypes").alias("_i", "_g"))
    index = F.col("_i") if sample_index is None else sample_index(F.col("_g"))
    return rows.select(
        *keys,
        index.cast("bigint").alias("sample_idx"),
        F.col("_g")["sampleId"].alias("sampleId"),
        calls.alt_dosage(F.col("_g")["calls"]).alias("n_alt"),
    )
