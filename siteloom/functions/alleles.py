"""Contigs, alleles and site identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Contig labels of the GRCh38 assembly that are recoded, and their lengths. The lengths of alternate
# and unplaced contigs come from the caller (a table, or the ##contig lines of the file).
CONTIG_LENGTHS = {
    "chr1": 248956422, "chr2": 242193529, "chr3": 198295559, "chr4": 190214555,
    "chr5": 181538259, "chr6": 170805979, "chr7": 159345973, "chr8": 145138636,
    "chr9": 138394717, "chr10": 133797422, "chr11": 135086622, "chr12": 133275309,
    "chr13": 114364328, "chr14": 107043718, "chr15": 101991189, "chr16": 90338345,
    "chr17": 83257441, "chr18": 80373285, "chr19": 58617616, "chr20": 64444167,
    "chr21": 46709983, "chr22": 50818468, "chrX": 156040895, "chrY": 57227415, "chrM": 16569,
}


def strip_contig_prefix(contig: Column) -> Column:
    """chr12 / CHR12 / Chr12 -> 12; every other name is left alone."""
    return F.regexp_replace(contig, "^(chr|CHR|Chr)", "")


def add_contig_prefix(contig: Column) -> Column:
    """1 -> chr1 … Y -> chrY, M and MT -> chrM, only for the recoded labels."""
    labels = [name[3:] for name in CONTIG_LENGTHS]
    named = F.when(contig.isin(labels), F.concat(F.lit("chr"), contig)).otherwise(contig)
    return F.when(contig == "MT", F.lit("chrM")).otherwise(named)


def contig_length(contig: Column, more: dict[str, int] | None = None) -> Column:
    """Length of a known (chr-prefixed) contig or one of ``more``, NULL for any other."""
    known = CONTIG_LENGTHS | (more or {})
    lengths = F.create_map(*[F.lit(v) for pair in known.items() for v in pair])
    return F.try_element_at(lengths, contig)


def uid(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """CHR:POS:REF:ALT with a 1-based position."""
    return F.concat_ws(":", chrom, pos.cast("string"), ref, alt)


def acgt_only(allele: Column) -> Column:
    return allele.rlike("^[ACGT]*$")


def reverse_complement(allele: Column) -> Column:
    return F.reverse(F.translate(allele, "ACGT", "TGCA"))


def is_snp(ref: Column, alt: Column) -> Column:
    """One substituted base: single letters that differ, or equal lengths with one mismatch."""
    same_length = F.length(ref) == F.length(alt)
    mismatches = F.size(
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.length(ref), F.lit(1))),
            lambda i: F.substring(ref, i, F.lit(1)) != F.substring(alt, i, F.lit(1)),
        )
    )
    return F.when(~same_length, False).when(F.length(ref) == 1, ref != alt).otherwise(mismatches == 1)
