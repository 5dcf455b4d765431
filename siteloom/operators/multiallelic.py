"""Splitting multi-allelic sites and repairing the calls the split masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import calls
from siteloom.functions.once import compute_once

MODES = ("masked", "downcode")


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def split_multiallelics(df: DataFrame, mode: str = "masked") -> DataFrame:
    """One row per alternate allele; biallelic sites pass through with splitFromMultiAllelic = false.

    In the split rows the row's own allele becomes 1 and the reference stays 0. Any other allele becomes
    -1 ("masked") or 0 ("downcode"). Per-allele depths are cut to [ref, own], and in downcode mode the
    reads of the other alleles are added to the reference. ``a_index`` is the 1-based allele number.

    Genotypes that hold likelihoods ``PL``, one for each genotype j/k at place k(k+1)/2 + j, get three: in downcode mode
    each is the least of the old ones that become this genotype, and ``conditionalQuality`` is the gap between the two
    least of them; in masked mode they are those of ref/ref, ref/own and own/own. Lists of another length stay.
    """
    _check(mode)
    likelihoods = "PL" in df.schema["genotypes"].dataType.elementType.names
    other = calls.MISSING if mode == "masked" else 0
    n_alt = F.size("alternateAlleles")
    label = F.concat(
        F.concat_ws(":", F.col("contigName"), (F.col("start") + 1).cast("string"), F.col("referenceAllele")),
        F.lit("/"),
        F.array_join("alternateAlleles", "/"),
    )
    kept = [c for c in df.columns if c not in ("alternateAlleles", "genotypes")]
    rows = (
        df.withColumn("splitFromMultiAllelic", n_alt > 1)
        .withColumn("INFO_OLD_MULTIALLELIC", F.when(n_alt > 1, label))
        .select(
            *[c for c in kept if c not in ("splitFromMultiAllelic", "INFO_OLD_MULTIALLELIC")],
            "splitFromMultiAllelic",
            "INFO_OLD_MULTIALLELIC",
            "genotypes",
            n_alt.alias("_n_alt"),
            F.posexplode("alternateAlleles").alias("_i", "_alt"),
        )
        .withColumn("a_index", F.col("_i") + 1)
        .withColumn("alternateAlleles", F.array("_alt"))
    )
    own = F.col("a_index")

    def recode(c):
        return F.transform(c, lambda a: F.when(a <= 0, a).when(a == own, 1).otherwise(other))

    def depths(ad):
        ref, alt = F.get(ad, F.lit(0)), F.get(ad, own)
        if mode == "downcode":
            ref = F.aggregate(ad, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0))) - alt
        return F.when(F.size(ad) == F.col("_n_alt") + 1, F.array(ref, alt)).otherwise(ad)

    def lattice(g):
        """How many own alleles each old genotype has is the same for all samples: ``_own`` holds it once a row."""
        if mode == "masked":
            places = [F.lit(0), own * (own + 1) / 2, own * (own + 3) / 2]
            least = F.array(*[F.get(g["PL"], place.cast("int")) for place in places])
        else:
            paired = F.zip_with(g["PL"], "_own", lambda p, n: F.struct(p.alias("p"), n.alias("n")))
            least = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda c: F.array_min(F.filter(paired, lambda x: x["n"] == c)["p"]))
        return F.when(F.size(g["PL"]) == F.size("_own"), least).otherwise(g["PL"])

    def quality(g):
        known = F.array_sort(F.filter(g["PL"], lambda p: p.isNotNull()))
        gap = (F.get(known, F.lit(1)) - F.get(known, F.lit(0))).cast("int")
        return F.when(F.size(g["PL"]) == 3, F.coalesce(gap, g["conditionalQuality"])).otherwise(g["conditionalQuality"])

    split = F.transform(
        "genotypes",
        lambda g: g.withField("calls", recode(g["calls"])).withField("alleleDepths", depths(g["alleleDepths"])),
    )
    if likelihoods:
        places = F.expr(
            "flatten(transform(sequence(0, _n_alt), k -> transform(sequence(0, k), j -> CAST(j = a_index AS INT) + CAST(k = a_index AS INT))))"
        )
        rows = compute_once(rows, {"_own": F.when(F.col("splitFromMultiAllelic"), places)})
        split = F.transform(split, lambda g: g.withField("PL", lattice(g)))
        if mode == "downcode":
            split = F.transform(split, lambda g: g.withField("conditionalQuality", quality(g)))
    result = F.when(F.col("splitFromMultiAllelic"), split).otherwise(F.col("genotypes"))
    rows = compute_once(rows, {"genotypes": result}) if likelihoods else rows.withColumn("genotypes", result)
    return rows.drop("_i", "_alt", "_n_alt", "_own")


def correct_multiallelics(df: DataFrame, mode: str = "masked") -> DataFrame:
    """Give masked alleles of *called* genotypes back to the reference: 0/. -> 0/0 and 1/. -> 0/1.

    ``called`` must have been marked before the split. A call whose both alleles were masked (a carrier of
    two other alternates) stays missing in "masked" mode and becomes 0/0 in "downcode" mode. The repaired
    call is sorted, so its phase order is lost.
    """
    _check(mode)

    def repair(g, called):
        masked = F.array_contains(g["calls"], calls.MISSING)
        if mode == "masked":
            masked = masked & (F.array_max(g["calls"]) >= 0)
        unmasked = F.sort_array(F.transform(g["calls"], lambda a: F.greatest(a, F.lit(0))))
        return g.withField("calls", F.when(called & masked, unmasked).otherwise(g["calls"]))

    repaired = F.zip_with("genotypes", "called", repair)
    return df.withColumn(
        "genotypes", F.when(F.col("splitFromMultiAllelic"), repaired).otherwise(F.col("genotypes"))
    ).drop("called")
