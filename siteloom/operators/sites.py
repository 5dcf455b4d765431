"""Site identifiers and the genotype lookup row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import alleles, calls

# Columns of the lookup row, in output order (expression AS name).
LOOKUP_FIELDS = [
    "contigName",
    "start",
    "end",
    "referenceAllele",
    "alternateAlleles",
    "filters",
    "qual",
    "INFO_OLD_MULTIALLELIC AS multiAllelic",
    "uid",
    "CHR",
    "POS",
    "REF",
    "ALT",
    "AC",
    "aaf",
    "get(nHomozygous, 0) AS homRR",
    "nHet AS hetRA",
    "homAA",
    "pValueHwe",
    "callRate",
    "nUncalled AS noCall",
    "depth_quartiles",
    "het_alleleDepth_quartiles",
    "hom_alleleDepth_quartiles",
    "genotypes",
]


def uid_to_site(df: DataFrame) -> DataFrame:
    """Add the 0-based site columns described by ``uid`` (CHR:POS:REF:ALT)."""
    part = F.split("uid", ":")
    start = part[1].cast("bigint") - 1
    return df.withColumns(
        {
            "contigName": part[0],
            "start": start,
            "end": start + F.length(part[2]),
            "referenceAllele": part[2],
            "alternateAlleles": F.array(part[3]),
        }
    )


def site_to_uid(df: DataFrame) -> DataFrame:
    """Add CHR, 1-based POS, REF, ALT and uid; the sites must be biallelic (split them first)."""
    named = df.withColumns(
        {
            "CHR": F.col("contigName"),
            "POS": F.col("start") + 1,
            "REF": F.col("referenceAllele"),
            "ALT": F.get("alternateAlleles", F.lit(0)),
        }
    )
    return named.withColumn("uid", alleles.uid(F.col("CHR"), F.col("POS"), F.col("REF"), F.col("ALT")))


def strip_contig(df: DataFrame) -> DataFrame:
    return df.withColumn("contigName", alleles.strip_contig_prefix(F.col("contigName")))


def alt_or_default(df: DataFrame, array_col: str, name: str, default=0) -> DataFrame:
    """The alternate allele's element of a per-allele array, or a default where there is none."""
    has_alt = F.size(array_col) > 1
    return df.withColumn(name, F.when(has_alt, F.get(array_col, F.lit(1))).otherwise(F.lit(default)))


def depth_quartiles(df: DataFrame) -> DataFrame:
    """[min, median, max] depth over called genotypes; NULL elements when none is called."""
    called = F.filter("genotypes", lambda g: calls.is_called(g["calls"]) & (g["depth"] > -1))
    ordered = df.withColumn("_depths", F.sort_array(called["depth"]))
    return ordered.withColumn("depth_quartiles", F.array(*calls.low_mid_high(F.col("_depths")))).drop("_depths")


def _balance(df: DataFrame, member, any_member, name: str) -> DataFrame:
    """{min, median, max} alternate-read fraction over the member genotypes, zeros when there is none."""
    fractions = F.transform(
        F.filter("genotypes", lambda g: member(g["calls"])), lambda g: calls.alt_fraction(g["alleleDepths"])
    )
    staged = df.withColumn("_ab", F.sort_array(F.filter(fractions, lambda a: a.isNotNull())))
    names = ("min", "median", "max")
    found = F.struct(*[c.alias(n) for c, n in zip(calls.low_mid_high(F.col("_ab")), names)])
    zeros = F.struct(*[F.lit(0.0).alias(n) for n in names])
    return staged.withColumn(name, F.when(any_member, found).otherwise(zeros)).drop("_ab")


def het_allele_balance(df: DataFrame) -> DataFrame:
    """Needs ``nHet`` (call_summary_stats)."""
    return _balance(df, calls.is_het_ref_alt, F.col("nHet") > 0, "het_alleleDepth_quartiles")


def hom_allele_balance(df: DataFrame) -> DataFrame:
    """Needs ``homAA`` (alt_or_default over nHomozygous)."""
    return _balance(df, calls.is_hom_alt, F.col("homAA") > 0, "hom_alleleDepth_quartiles")


def extract_values(df: DataFrame, fields_to_include: Sequence[str] = ()) -> DataFrame:
    """Lookup row of one split site; ``fields_to_include`` are further select expressions.

    Needs the outputs of call_summary_stats, hardy_weinberg and site_to_uid.
    """
    return (
        df.transform(alt_or_default, "nHomozygous", "homAA")
        .transform(alt_or_default, "alleleCounts", "AC")
        .transform(alt_or_default, "alleleFrequencies", "aaf", 0.0)
        .transform(depth_quartiles)
        .transform(het_allele_balance)
        .transform(hom_allele_balance)
        .selectExpr(*LOOKUP_FIELDS, *fields_to_include)
    )
