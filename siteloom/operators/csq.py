"""Transcript consequences: parse, join, flag, and gather per variant and gene."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions import alleles, consequence
from siteloom.session import small_side

MISSENSE_KEYS = ["uid", "CHR", "POS", "REF", "ALT", "EnsemblGeneId"]
TRANSCRIPT_KEYS = ["EnsemblGeneId", "GeneName", "Transcript", "CHR"]

# Names and order of the gathered transcript struct, the effect struct and the group keys.
TRANSCRIPT_FIELDS = ["Transcript", "canonical", "hgvsc", "hgvsp", "cds", "aa", "exon", "intron", "lofFilters"]
EFFECT_FIELDS = [
    "priority",
    "variantEffect",
    "delMissenseCount",
    "missensePredictions",
    "revel",
    "completeTranscriptAnnotations",
]
GENE_KEYS = ["uid", "CHR", "REF", "ALT", "POS", "rsid", "isAncestralAllele", "GeneName", "EnsemblGeneId"]
EFFECT_KEYS = GENE_KEYS + ["variantEffect", "priority", "delMissenseCount", "missensePredictions", "revel"]
END_TRUNCATION = 0.95


def parse_csq(df: DataFrame, csq_col: str = "csqs") -> DataFrame:
    """One row per consequence record, its kept fields as columns; rows without text are left out."""
    return (
        df.withColumn("_csq", F.explode(consequence.records(F.col(csq_col))))
        .select("*", "_csq.*")
        .drop("_csq", "attributes", "val", csq_col)
    )


def harmonize_consequence(df: DataFrame) -> DataFrame:
    """Add priority and variantEffect of the most deleterious term of ``consequence``."""
    return (
        df.withColumn("_effect", consequence.worst_effect(F.col("consequence")))
        .withColumns({"priority": F.col("_effect.priority"), "variantEffect": F.col("_effect.variantEffect")})
        .drop("_effect")
    )


def prepare_missense(df: DataFrame) -> DataFrame:
    """Raw missense-prediction table -> join-ready columns; its nameless column is delMissenseCount."""
    fixed = {"rsid_151": "rsid", "": "delMissenseCount", "revel": "revel"}
    named = df.toDF(*[fixed.get(c.lower() if c else c, c) for c in df.columns])
    return named.withColumn("uid", alleles.uid(F.col("CHR"), F.col("POS"), F.col("REF"), F.col("ALT"))).select(
        *MISSENSE_KEYS, "ancestralAllele", "rsid", "missensePredictions", "delMissenseCount", "revel"
    )


def prepare_transcripts(df: DataFrame) -> DataFrame:
    """Raw transcript table -> join-ready columns."""
    return df.select(
        *TRANSCRIPT_KEYS,
        F.col("Strand").alias("strand"),
        F.col("Start").alias("cdsStart"),
        F.col("End").alias("cdsEnd"),
        F.col("CDSLength").alias("cdsLength"),
    )


def repeated_missense_keys(missense: DataFrame) -> DataFrame:
    """Keys held by several rows; each such key multiplies the annotation rows it joins."""
    return missense.groupBy(*MISSENSE_KEYS).count().where(F.col("count") > 1)


def join_transcripts(df: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Keep records on known protein-coding transcripts and add their coordinates."""
    return df.join(small_side(transcripts), TRANSCRIPT_KEYS)


def join_missense(df: DataFrame, missense: DataFrame) -> DataFrame:
    return df.join(missense, MISSENSE_KEYS, "left")


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def shape_fields(df: DataFrame) -> DataFrame:
    """Null out empty text, cut ranges and prefixes, and keep missense scores on missense effects only."""
    first = lambda name: F.get(F.split(name, "-"), F.lit(0))
    is_missense = F.col("variantEffect") == "missense"
    placed = df.withColumns({"cds_position": first("cds_position"), "protein_position": first("protein_position")})
    protein_length = F.floor(F.col("cdsLength") / 3).cast("int")

    def position(name: str, length: Column) -> Column:
        return F.when(F.length(name) > 0, F.concat_ws("_", F.col(name), length.cast("string")))

    return placed.withColumns(
        {
            "cds": position("cds_position", F.col("cdsLength")),
            "aa": position("protein_position", protein_length),
            "exon": F.replace(_filled("exon"), F.lit("/"), F.lit("_")),
            "intron": F.replace(_filled("intron"), F.lit("/"), F.lit("_")),
            "hgvsc": F.get(F.split("hgvsc", ":"), F.lit(1)),
            "hgvsp": F.get(F.split("hgvsp", ":"), F.lit(1)),
            "isAncestralAllele": F.coalesce(F.col("ALT") == F.col("ancestralAllele"), F.lit(False)),
            "delMissenseCount": F.when(is_missense, F.col("delMissenseCount")),
            "missensePredictions": F.when(is_missense, F.col("missensePredictions")),
            "revel": F.nullif(F.col("revel"), F.lit(".")),
            "canonical": F.when(F.col("canonical") == "YES", "yes").otherwise("no"),
        }
    )


def lof_flags(df: DataFrame, ancestral_rule: Column | None = None) -> DataFrame:
    """``lofFilters``: the loss-of-function caveats that hold, in fixed order joined by ",", or "NA".

    ``ancestral_rule`` decides which effects an ancestral alternate allele flags (default priority >= 4).
    """
    effect = F.col("variantEffect")
    before = F.col("POS") <= F.col("cdsStart")
    after = F.col("POS") >= F.col("cdsEnd")
    forward, backward = F.col("strand") == "+", F.col("strand") == "-"
    # The 5' end is the low end of a forward transcript and the high end of a backward one; a site that
    # qualifies as both takes the earlier rule.
    utr = (
        F.when(forward & before, "5_UTR_splice")
        .when(forward & after, "3_UTR_splice")
        .when(backward & after, "5_UTR_splice")
        .when(backward & before, "3_UTR_splice")
    )
    reached = F.try_divide(F.expr("try_cast(cds_position AS DOUBLE)"), F.col("cdsLength"))
    ancestral = F.col("priority") >= 4 if ancestral_rule is None else ancestral_rule
    flags = F.array_compact(
        F.array(
            F.when(effect.isin("splice_donor", "splice_acceptor"), utr),
            F.when((effect == "splice_donor") & F.col("hgvsc").contains("+2C>T"), "GC_2_GT_donor"),
            F.when(effect.isin("frameshift", "stop_gained") & (reached >= END_TRUNCATION), "EndTrunc"),
            F.when(F.col("isAncestralAllele") & ancestral, "ancestral_allele"),
        )
    )
    return df.withColumn("lofFilters", F.coalesce(F.nullif(F.array_join(flags, ","), F.lit("")), F.lit("NA")))


def group_transcripts(df: DataFrame, cols_2_include: Sequence[str] = ()) -> DataFrame:
    """Gather the transcripts that share a variant, gene and effect, in a fixed order."""
    return df.groupBy(*EFFECT_KEYS, *cols_2_include).agg(
        F.sort_array(F.collect_list(F.struct(*TRANSCRIPT_FIELDS))).alias("completeTranscriptAnnotations")
    )


def merge_effects(df: DataFrame, cols_2_include: Sequence[str] = ()) -> DataFrame:
    """One row per variant and gene: allEffects by rising priority, its first element as
    mostDeleteriousEffect, and canonicalAnnotations (first effect on a canonical transcript, reduced to that
    transcript)."""
    merged = df.groupBy(*GENE_KEYS, *cols_2_include).agg(
        F.sort_array(F.collect_list(F.struct(*EFFECT_FIELDS))).alias("allEffects")
    )
    is_canonical = lambda t: t["canonical"] == "yes"
    canonical = F.get(
        F.filter("allEffects", lambda e: F.exists(e["completeTranscriptAnnotations"], is_canonical)), F.lit(0)
    )
    return (
        merged.withColumn("mostDeleteriousEffect", F.get("allEffects", F.lit(0)))
        .withColumn("_canonical", canonical)
        .withColumn(
            "canonicalAnnotations",
            F.col("_canonical").withField(
                "completeTranscriptAnnotations",
                F.get(F.filter(F.col("_canonical.completeTranscriptAnnotations"), is_canonical), F.lit(0)),
            ),
        )
        .drop("_canonical")
    )


def _confidence(priority: Column, flagged: Column) -> Column:
    """HC / LC for truncating effects (priority <= 4) by their flags, LC for lost start or stop, else NA."""
    return (
        F.when((priority <= 4) & flagged, "LC")
        .when((priority <= 4) & ~flagged, "HC")
        .when(priority.isin(5, 6), "LC")
        .otherwise("NA")
    )


def canonical_effect(df: DataFrame) -> DataFrame:
    """canonicalAnnotations -> flat canonicalEffect struct, NULL where no canonical transcript is hit."""
    effect = F.col("canonicalAnnotations")
    transcript = effect["completeTranscriptAnnotations"]
    flat = F.struct(
        effect["variantEffect"].alias("variantEffect"),
        effect["priority"].cast("string").alias("priority"),
        transcript["Transcript"].alias("transcripts"),
        F.lit(True).alias("affectsCanonical"),
        effect["delMissenseCount"].cast("string").alias("delMissenseCount"),
        effect["missensePredictions"].alias("missensePredictions"),
        effect["revel"].cast("string").alias("revel"),
        *[transcript[f].alias(f) for f in TRANSCRIPT_FIELDS[2:]],
        _confidence(effect["priority"], transcript["lofFilters"] != "NA").alias("HClof"),
    )
    return df.withColumn("canonicalEffect", F.when(effect["variantEffect"].isNotNull(), flat)).drop(
        "canonicalAnnotations"
    )


def most_deleterious(df: DataFrame) -> DataFrame:
    """mostDeleteriousEffect -> flat struct with ":"-joined transcript columns and its confidence.

    Joined lists skip NULLs, so their positions need not line up.
    """
    effect = F.col("mostDeleteriousEffect")
    transcripts = effect["completeTranscriptAnnotations"]
    flagged = F.exists(transcripts, lambda t: t["lofFilters"] != "NA")
    joined = lambda f: F.concat_ws(":", transcripts[f])
    flat = F.struct(
        effect["variantEffect"].alias("variantEffect"),
        effect["priority"].cast("string").alias("priority"),
        joined("Transcript").alias("transcripts"),
        F.array_contains(transcripts["canonical"], "yes").alias("affectsCanonical"),
        effect["delMissenseCount"].cast("string").alias("delMissenseCount"),
        effect["missensePredictions"].alias("missensePredictions"),
        effect["revel"].cast("string").alias("revel"),
        *[joined(f).alias(f) for f in TRANSCRIPT_FIELDS[2:]],
        _confidence(effect["priority"], flagged).alias("HClof"),
    )
    return df.withColumn("mostDeleteriousEffect", flat)


def transcript_rows(df: DataFrame, csq_col: str, missense: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Parsed, joined, shaped and flagged records, one row each: the input of the two gatherings.

    Records off the known transcripts are dropped before the missense join. Its keys are contained in both
    gatherings' keys, so the partitioning by them serves the join and both gatherings: the records are
    shuffled once, whichever join Spark picks.
    """
    return (
        df.transform(parse_csq, csq_col)
        .transform(join_transcripts, transcripts)
        .transform(harmonize_consequence)
        .repartition(*MISSENSE_KEYS)
        .transform(join_missense, missense)
        .transform(shape_fields)
        .transform(lof_flags)
    )


def annotate(
    df: DataFrame,
    csq_col: str,
    missense: DataFrame,
    transcripts: DataFrame,
    cols_2_include: Sequence[str] = (),
) -> DataFrame:
    """Raw consequence text -> one row per variant and gene with canonicalEffect, mostDeleteriousEffect and
    allEffects. ``missense`` and ``transcripts`` are prepared tables."""
    return (
        df.transform(transcript_rows, csq_col, missense, transcripts)
        .transform(group_transcripts, cols_2_include)
        .transform(merge_effects, cols_2_include)
        .transform(canonical_effect)
        .transform(most_deleterious)
    )


def join_back(pvcf: DataFrame, annotations: DataFrame, how: str = "left") -> DataFrame:
    """Bring site annotations back to the full population rows by uid.

    Population rows that were stored by uid (``sources.bucketed``) stay where they are; only annotations move.
    """
    shared = [c for c in annotations.columns if c in pvcf.columns and c != "uid"]
    return pvcf.join(annotations.drop(*shared), "uid", how)
