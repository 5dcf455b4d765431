"""Consequence terms: rank, harmonised name and the record layout of annotation text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Term -> (priority, harmonised effect, islof). Any other term is (16, other, false).
TERMS = {
    "stop_gained": (1, "stop_gained", True),
    "frameshift_variant": (2, "frameshift", True),
    "splice_donor_variant": (3, "splice_donor", True),
    "splice_acceptor_variant": (4, "splice_acceptor", True),
    "stop_lost": (5, "stop_lost", True),
    "start_lost": (6, "start_lost", True),
    "missense_variant": (7, "missense", False),
    "inframe_insertion": (8, "inframe_indel", False),
    "inframe_deletion": (8, "inframe_indel", False),
    "splice_region_variant": (9, "splice_region", False),
    "synonymous_variant": (10, "synonymous", False),
    "start_retained_variant": (10, "synonymous", False),
    "stop_retained_variant": (10, "synonymous", False),
    "5_prime_UTR_variant": (11, "5_prime_UTR", False),
    "3_prime_UTR_variant": (12, "3_prime_UTR", False),
    "intron_variant": (13, "intronic", False),
    "upstream_gene_variant": (14, "upstream", False),
    "downstream_gene_variant": (15, "downstream", False),
}
OTHER = (16, "other", False)

# 0-based position of each kept field inside a "|"-separated annotation record.
RECORD_FIELDS = {
    "consequence": 1,
    "EnsemblGeneId": 4,
    "GeneName": 3,
    "exon": 8,
    "intron": 9,
    "transcript": 6,
    "hgvsc": 10,
    "hgvsp": 11,
    "canonical": 23,
    "mane": 24,
    "cds_position": 13,
    "protein_position": 14,
}


def _effect(entry: tuple[int, str, bool]) -> Column:
    priority, name, islof = entry
    return F.struct(
        F.lit(priority).alias("priority"), F.lit(name).alias("variantEffect"), F.lit(islof).alias("islof")
    )


def effects(consequence: Column) -> Column:
    """One (priority, variantEffect, islof) struct per "&"-joined term."""
    ranks = F.create_map(*[c for term, entry in TERMS.items() for c in (F.lit(term), _effect(entry))])
    return F.transform(
        F.split(consequence, "&"), lambda term: F.coalesce(F.try_element_at(ranks, term), _effect(OTHER))
    )


def worst_effect(consequence: Column) -> Column:
    """The effect with the lowest priority number."""
    return F.array_min(effects(consequence))


def records(csq: Column) -> Column:
    """array<struct> of the kept fields, one struct per ","-separated record."""
    pieces = F.transform(F.split(csq, ","), lambda record: F.split(record, r"\|"))
    return F.transform(
        pieces,
        lambda p: F.struct(*[F.get(p, F.lit(i)).alias(name) for name, i in RECORD_FIELDS.items()]),
    )
