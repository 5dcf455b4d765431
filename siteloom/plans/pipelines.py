"""The four end-to-end pipelines, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.operators import csq, genotypes, harmonise, ld, liftover, multiallelic, normalize, site_qc, sites
from siteloom.operators.sumstats import Study, qc_summary_stats, to_vcf_rows
from siteloom.sources.annotation import parse_annotated_text


def lookup_table(
    pvcf: DataFrame, reference: DataFrame | None = None, fields_to_include: Sequence[str] = ()
) -> DataFrame:
    """Population rows -> genotype lookup rows: split, repair, align, count, drop 0/0, summarise.

    All steps are row-local but the alignment of indels, which is skipped without ``reference``.
    """
    split = (
        pvcf.transform(genotypes.process_genotypes)
        .transform(multiallelic.split_multiallelics)
        .transform(multiallelic.correct_multiallelics)
    )
    if reference is not None:
        split = align_sites(split, reference)
    return (
        split.transform(genotypes.call_summary_stats)
        .transform(genotypes.hardy_weinberg)
        .transform(sites.site_to_uid)
        .transform(genotypes.drop_hom_ref)
        .transform(sites.extract_values, fields_to_include)
    )


def align_sites(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Left-align biallelic site rows.

    Rows of single-base alleles pass untouched and unshuffled. For the others only the site columns go
    through the alignment, and its result is joined back by uid.
    """
    first_alt = F.get("alternateAlleles", F.lit(0))
    single = F.coalesce((F.length("referenceAllele") == 1) & (F.length(first_alt) == 1), F.lit(True))
    indels = df.where(~single).transform(sites.site_to_uid)
    moved = normalize.left_align(indels.select("uid", "CHR", "POS", "REF", "ALT").distinct(), reference).select(
        "uid", F.col("POS").alias("_pos"), F.col("REF").alias("_ref"), F.col("ALT").alias("_alt")
    )
    placed = indels.join(moved, "uid").withColumns(
        {
            "start": F.col("_pos") - 1,
            "end": F.col("_pos") - 1 + F.length("_ref"),
            "referenceAllele": F.col("_ref"),
            "alternateAlleles": F.array("_alt"),
        }
    )
    return df.where(single).unionByName(placed.select(*df.columns))


def annotation_table(text: DataFrame, missense: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Annotator text lines -> annotated variant-gene rows."""
    annotated = csq.annotate(parse_annotated_text(text), "csqs", missense, transcripts)
    return annotated.where(F.col("allEffects").isNotNull())


def matrix_qc(pvcf: DataFrame, mode: str = "downcode", **thresholds) -> DataFrame:
    """Population rows -> split, counted and filtered autosomal SNP rows."""
    return (
        split_for_qc(pvcf, mode).transform(genotypes.variant_qc).transform(site_qc.filter_sites, **thresholds)
    )


def matrix_qc_observed(pvcf: DataFrame, mode: str = "downcode", **thresholds):
    """``matrix_qc`` and its funnel, counted by the one action on the rows: see ``filter_sites_observed``."""
    counted = split_for_qc(pvcf, mode).transform(genotypes.variant_qc)
    return site_qc.filter_sites_observed(counted, **thresholds)


def split_for_qc(pvcf: DataFrame, mode: str = "downcode") -> DataFrame:
    """One row per alternate allele, the other alternates counted as reference."""
    called = pvcf.transform(genotypes.mark_called)
    return multiallelic.correct_multiallelics(multiallelic.split_multiallelics(called, mode), mode)


def pruned_probabilities(pvcf: DataFrame, sample_index=None, **ld_options) -> DataFrame:
    """Filtered rows -> LD-pruned rows with mean-imputed dosages and genotype probabilities.

    Split rows are told apart by the ``uid`` added here.
    """
    passed = matrix_qc(pvcf).transform(sites.site_to_uid)
    pruned = ld.ld_prune(passed, "uid", sample_index=sample_index, **ld_options)
    return pruned.transform(genotypes.mean_impute).transform(genotypes.genotype_probabilities)


def harmonise_study(
    raw: DataFrame, study: Study, reference: DataFrame, chain: DataFrame | None = None, **options
) -> DataFrame:
    """Source rows of one study -> the harmonised table.

    A study on the old build is lifted, which already checks alleles against the reference; one on the
    target build gets its REF fixed instead. Indels are then left-aligned. The source is read twice, whether or not
    it holds indels: once for the alignment of the multi-base rows, once for the others.
    """
    rows = raw.transform(qc_summary_stats, study).transform(to_vcf_rows)
    if study.build == "hg19":
        placed = liftover.lifted_rows(liftover.liftover(rows, chain, reference))
    else:
        placed = normalize.fix_reference(rows, reference).drop("ref_fixed")
    return harmonise.format_harmonised(normalize.left_align(placed, reference), **options)
