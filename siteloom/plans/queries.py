"""The registered queries: each runs one operator over whole given tables and returns flat columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.functions import alleles
from siteloom.operators import (
    csq,
    genotypes,
    harmonise,
    ld,
    liftover,
    multiallelic,
    nearest,
    normalize,
    site_qc,
    sites,
    sumstats,
)
from siteloom.plans import fixtures, pipelines
from siteloom.session import scratch_path
from siteloom.sources import annotation, bucketed, matrix, vcf
from siteloom.sources import sumstats as sumstats_source

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

OLD_BUILD_STUDY, NEW_BUILD_STUDY = "NATION_0.tsv", "NATION_3.tsv"
BUCKETS = 16  # of the tables that the queries store; a cluster's tables take as many as keep one near 256 MB
LINKED_R2 = 0.2  # the sparse fixture has few pairs at the default threshold


def query(fn: Query) -> Query:
    """Register under the function's name; a ``_query`` suffix only avoids clashing with a module."""
    _REGISTRY[fn.__name__.removesuffix("_query")] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _round(*names: str) -> list:
    return [F.round(F.col(n).cast("double"), 6).alias(n) for n in names]


def _at(array: str, i: int):
    return F.get(F.col(array), F.lit(i))


def _calls(*keys: str, df: DataFrame, with_depths: bool = False) -> DataFrame:
    """One row per genotype: keys, sampleId, c0, c1 (and ad0, ad1)."""
    rows = df.select(*keys, F.explode("genotypes").alias("g"))
    cells = {"c0": ("calls", 0), "c1": ("calls", 1)}
    if with_depths:
        cells |= {"ad0": ("alleleDepths", 0), "ad1": ("alleleDepths", 1)}
    picked = [F.get(F.col(f"g.{field}"), F.lit(i)).cast("bigint").alias(n) for n, (field, i) in cells.items()]
    return rows.select(*keys, F.col("g.sampleId").alias("sampleId"), *picked)


def _sample(g):
    return g["sampleId"].cast("bigint")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = fixtures.pvcf(spark, sf_dir).transform(genotypes.process_genotypes)
    return processed.transform(multiallelic.split_multiallelics)


def _corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).transform(multiallelic.correct_multiallelics)


def _for_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.split_for_qc(fixtures.pvcf(spark, sf_dir)).transform(genotypes.variant_qc)


# --- identifiers and genotype arrays ----------------------------------------------------------------


@query
def uid_to_site(spark, sf_dir):
    rows = fixtures.variants(spark, sf_dir).select("sid", "uid").transform(sites.uid_to_site)
    return rows.select("sid", "contigName", "start", "end", "referenceAllele", _at("alternateAlleles", 0).alias("alt"))


@query
def site_to_uid(spark, sf_dir):
    rows = fixtures.sites(spark, sf_dir).selectExpr(
        "sid", "contigName", "start", "ref AS referenceAllele", "array(alt1) AS alternateAlleles"
    )
    return rows.transform(sites.site_to_uid).select("sid", "CHR", "POS", "REF", "ALT", "uid")


@query
def contig_strip(spark, sf_dir):
    named = fixtures.sites(spark, sf_dir).selectExpr(
        "sid",
        "concat(CASE sid % 4 WHEN 0 THEN 'chr' WHEN 1 THEN 'CHR' WHEN 2 THEN 'Chr' ELSE '' END,"
        " IF(sid % 7 = 0, 'Un_random', substr(contigName, 4))) AS contigName",
    )
    return named.transform(sites.strip_contig)


@query
def gt_project(spark, sf_dir):
    rows = fixtures.pvcf(spark, sf_dir).transform(genotypes.project_genotypes)
    return rows.select("sid", F.inline("genotypes")).select(
        "sid",
        "sampleId",
        "phased",
        F.col("depth").cast("bigint").alias("depth"),
        F.col("conditionalQuality").cast("bigint").alias("quality"),
        F.size("alleleDepths").cast("bigint").alias("n_depths"),
    )


@query
def gt_halfcall(spark, sf_dir):
    return _calls("sid", df=fixtures.pvcf(spark, sf_dir).transform(genotypes.project_genotypes))


@query
def gt_called(spark, sf_dir):
    rows = fixtures.pvcf(spark, sf_dir).transform(genotypes.mark_called)
    paired = F.zip_with("genotypes", "called", lambda g, c: F.struct(g["sampleId"].alias("sampleId"), c.alias("called")))
    return rows.select("sid", F.inline(paired))


@query
def gt_drop_homref(spark, sf_dir):
    return _calls("sid", df=fixtures.pvcf(spark, sf_dir).transform(genotypes.drop_hom_ref))


@query
def alt_or_default(spark, sf_dir):
    rows = fixtures.pvcf(spark, sf_dir).transform(sites.alt_or_default, "alternateAlleles", "second_alt", ".")
    return rows.select("sid", "second_alt")


@query
def split_multi(spark, sf_dir):
    old = "INFO_OLD_MULTIALLELIC"
    rows = _split(spark, sf_dir).withColumn("alt", _at("alternateAlleles", 0))
    flat = _calls("sid", "a_index", "alt", "splitFromMultiAllelic", old, df=rows, with_depths=True)
    return flat.withColumn("a_index", F.col("a_index").cast("bigint"))


@query
def fix_multi(spark, sf_dir):
    rows = _corrected(spark, sf_dir).withColumn("a_index", F.col("a_index").cast("bigint"))
    return _calls("sid", "a_index", df=rows)


@query
def fix_multi_downcode(spark, sf_dir):
    rows = pipelines.split_for_qc(fixtures.pvcf(spark, sf_dir)).withColumn("a_index", F.col("a_index").cast("bigint"))
    return _calls("sid", "a_index", df=rows, with_depths=True)


# --- genotype statistics ----------------------------------------------------------------------------


@query
def call_stats(spark, sf_dir):
    rows = fixtures.pvcf(spark, sf_dir).transform(genotypes.call_summary_stats)
    per_allele = F.arrays_zip("nHomozygous", "alleleCounts", "alleleFrequencies")
    return rows.select(
        "sid", "nCalled", "nUncalled", "nHet", "nNonRef", "nAllelesCalled", "callRate", F.posexplode(per_allele)
    ).select(
        "sid",
        F.col("pos").cast("bigint").alias("allele"),
        "nCalled",
        "nUncalled",
        "nHet",
        "nNonRef",
        "nAllelesCalled",
        F.col("col.nHomozygous").alias("n_hom"),
        F.col("col.alleleCounts").alias("ac"),
        F.round("col.alleleFrequencies", 6).alias("af"),
        *_round("callRate"),
    )


@query
def hwe(spark, sf_dir):
    rows = _corrected(spark, sf_dir).transform(genotypes.call_summary_stats).transform(genotypes.hardy_weinberg)
    return rows.select("sid", F.col("a_index").cast("bigint").alias("a_index"), *_round("pValueHwe"))


@query
def excess_het(spark, sf_dir):
    rows = _for_qc(spark, sf_dir)
    return rows.select("sid", F.col("a_index").cast("bigint").alias("a_index"), *_round("pValueExcessHet"))


def _counted(spark, sf_dir):
    rows = _corrected(spark, sf_dir).transform(genotypes.call_summary_stats)
    return rows.transform(sites.alt_or_default, "nHomozygous", "homAA").withColumn(
        "a_index", F.col("a_index").cast("bigint")
    )


@query
def depth_quartiles(spark, sf_dir):
    rows = _counted(spark, sf_dir).transform(sites.depth_quartiles)
    names = ("d_min", "d_med", "d_max")
    return rows.select(
        "sid", "a_index", *[_at("depth_quartiles", i).cast("bigint").alias(n) for i, n in enumerate(names)]
    )


def _quartiles(rows, column):
    return rows.select(
        "sid", "a_index", *[F.round(F.col(f"{column}.{n}"), 6).alias(f"ab_{n}") for n in ("min", "median", "max")]
    )


@query
def het_ab(spark, sf_dir):
    return _quartiles(_counted(spark, sf_dir).transform(sites.het_allele_balance), "het_alleleDepth_quartiles")


@query
def hom_ab(spark, sf_dir):
    return _quartiles(_counted(spark, sf_dir).transform(sites.hom_allele_balance), "hom_alleleDepth_quartiles")


@query
def site_lookup(spark, sf_dir):
    return _lookup_columns(pipelines.lookup_table(fixtures.pvcf(spark, sf_dir), fields_to_include=["sid"]))


@query
def site_lookup_normalised(spark, sf_dir):
    """The lookup table with its indels left-aligned against the reference first."""
    reference = fixtures.reference(spark, sf_dir)
    return _lookup_columns(pipelines.lookup_table(fixtures.pvcf(spark, sf_dir), reference, ["sid"]))


def _lookup_columns(rows):
    het, hom = "het_alleleDepth_quartiles", "hom_alleleDepth_quartiles"
    return rows.select(
        "sid",
        "contigName",
        "start",
        "end",
        "multiAllelic",
        "uid",
        "POS",
        "REF",
        "ALT",
        *[F.col(c).cast("bigint").alias(c) for c in ("AC", "homRR", "hetRA", "homAA", "noCall")],
        *_round("aaf", "pValueHwe", "callRate"),
        _at("depth_quartiles", 1).cast("bigint").alias("depth_median"),
        F.round(F.col(f"{het}.max"), 6).alias("het_max"),
        F.round(F.col(f"{hom}.median"), 6).alias("hom_median"),
        F.size("genotypes").cast("bigint").alias("n_genotypes"),
    )


@query
def site_qc_query(spark, sf_dir):
    rows = pipelines.matrix_qc(fixtures.pvcf(spark, sf_dir))
    return rows.select(
        "sid",
        "contigName",
        "start",
        F.col("a_index").cast("bigint").alias("a_index"),
        F.round("callRate", 6).alias("call_rate"),
        F.round(_at("alleleFrequencies", 1), 6).alias("af"),
        F.round("pValueExcessHet", 6).alias("p_excess_het"),
    )


@query
def qc_funnel(spark, sf_dir):
    return site_qc.qc_funnel(_for_qc(spark, sf_dir)).withColumn("step_no", F.col("step_no").cast("bigint"))


@query
def qc_funnel_written(spark, sf_dir):
    """The funnel that comes with writing the filtered rows, without a scan of its own."""
    kept, counted = site_qc.filter_sites_observed(_for_qc(spark, sf_dir))
    kept.write.parquet(scratch_path(spark, "qc-rows"))
    return counted().withColumn("step_no", F.col("step_no").cast("bigint"))


@query
def p_hist(spark, sf_dir):
    counts = site_qc.log10_p_histogram(_for_qc(spark, sf_dir), low=-4.0, bins=8)
    return counts.withColumn("bucket", F.col("bucket").cast("bigint"))


@query
def mean_impute(spark, sf_dir):
    rows = fixtures.pvcf(spark, sf_dir).transform(genotypes.mean_impute)
    paired = F.zip_with(
        "genotypes", "dosages", lambda g, d: F.struct(g["sampleId"].alias("sampleId"), d.alias("dosage"))
    )
    return rows.select("sid", "mean_dosage", F.inline(paired)).select(
        "sid", "sampleId", *_round("mean_dosage", "dosage")
    )


@query
def gp_export(spark, sf_dir):
    split = pipelines.split_for_qc(fixtures.pvcf(spark, sf_dir)).withColumn("a_index", F.col("a_index").cast("bigint"))
    rows = matrix.probability_rows(split, "sid", "a_index")
    return rows.select("sid", "a_index", "sampleId", *[_at("gp", i).alias(f"gp{i}") for i in range(3)], *_round("dosage"))


# --- intervals --------------------------------------------------------------------------------------


@query
def range_join_features(spark, sf_dir):
    rows = nearest.join_features(fixtures.variants(spark, sf_dir), fixtures.features(spark, sf_dir))
    return rows.select("uid", "CHR", "POS", "geneId", "biotype", "distance")


def _nearest_flat(rows):
    near = [
        rows.select("uid", F.lit(category).alias("category"), F.posexplode(column))
        for category, column in (("protein_coding", nearest.CODING), ("other", nearest.OTHER))
    ]
    return (
        near[0]
        .unionByName(near[1])
        .select(
            "uid",
            "category",
            (F.col("pos") + 1).cast("bigint").alias("rank"),
            F.col("col.GeneName").alias("GeneName"),
            F.col("col.EnsemblGeneId").alias("EnsemblGeneId"),
            F.col("col.biotype").alias("biotype"),
            F.col("col.distance").cast("bigint").alias("distance"),
        )
    )


@query
def nearest_genes(spark, sf_dir):
    return _nearest_flat(nearest.nearest_genes(fixtures.variants(spark, sf_dir), fixtures.features(spark, sf_dir)))


@query
def nearest_genes_salted(spark, sf_dir):
    """The path for feature tables too large to broadcast."""
    inputs = fixtures.variants(spark, sf_dir), fixtures.features(spark, sf_dir)
    return _nearest_flat(nearest.nearest_genes(*inputs, max_broadcast_rows=0))


def _split_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per site and allele with its genotypes, numbered by ``vid`` in the order of sites."""
    rows = pipelines.split_for_qc(fixtures.pvcf(spark, sf_dir))
    return rows.withColumn("vid", F.col("sid") * 2 + F.col("a_index").cast("bigint") - 1)


@query
def ld_pairs(spark, sf_dir):
    alleles = F.explode(F.sequence(F.lit(0), F.col("n_alt").cast("int") - 1))
    split = fixtures.sites(spark, sf_dir).withColumn("_i", alleles).withColumn("vid", F.col("sid") * 2 + F.col("_i"))
    return ld.site_pairs(split, "vid").select("contigName", "a_vid", "b_vid", "a_start", "b_start")


@query
def ld_r2(spark, sf_dir):
    rows = ld.ld_r2(_split_sites(spark, sf_dir), "vid", sample_index=_sample)
    return rows.select("a_vid", "b_vid", "n_both", *_round("r2"))


@query
def ld_prune(spark, sf_dir):
    rows = ld.ld_prune(_split_sites(spark, sf_dir), "vid", LINKED_R2, sample_index=_sample, tie_by_key=True)
    return rows.select("vid", "contigName", "start")


@query
def pruned_probabilities(spark, sf_dir):
    """Quality control, pruning, imputation and genotype probabilities in one pipeline; one row per entry."""
    rows = pipelines.pruned_probabilities(
        fixtures.pvcf(spark, sf_dir), max_r2=LINKED_R2, sample_index=_sample, tie_by_key=True
    )
    entries = F.arrays_zip(F.col("genotypes")["sampleId"].alias("sampleId"), "gp", "dosages")
    cells = rows.select("sid", "uid", "mean_dosage", F.inline(entries).alias("sampleId", "gp", "dosage"))
    probabilities = [_at("gp", i).alias(f"gp{i}") for i in range(3)]
    return cells.select("sid", "uid", "sampleId", *probabilities, *_round("mean_dosage", "dosage"))


@query
def ld_semi(spark, sf_dir):
    kept = fixtures.table(spark, sf_dir, "part").where("p_size > 25").selectExpr("p_partkey AS sid")
    return ld.keep_sites(fixtures.sites(spark, sf_dir), kept, "sid").select("sid", "contigName", "start")


# --- consequences -----------------------------------------------------------------------------------


def _missense(spark, sf_dir):
    return csq.prepare_missense(fixtures.missense(spark, sf_dir))


def _transcripts(spark, sf_dir):
    return csq.prepare_transcripts(fixtures.transcripts(spark, sf_dir))


def _parsed(spark, sf_dir):
    return fixtures.csq_sites(spark, sf_dir).transform(csq.parse_csq)


def _records(spark, sf_dir):
    return csq.transcript_rows(
        fixtures.csq_sites(spark, sf_dir), "csqs", _missense(spark, sf_dir), _transcripts(spark, sf_dir)
    )


def _transcript_list(column):
    return F.array_join(F.col(column)["Transcript"], ",")


@query
def csq_text_parse(spark, sf_dir):
    rows = annotation.parse_annotated_text(fixtures.annotated_text(spark, sf_dir))
    return rows.select("uid", "CHR", "POS", "REF", "ALT", "INFO", "csqs")


@query
def csq_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "uid",
        "consequence",
        "EnsemblGeneId",
        "GeneName",
        "exon",
        "intron",
        "transcript",
        "hgvsc",
        "hgvsp",
        "canonical",
        "mane",
        "cds_position",
        "protein_position",
    )


@query
def harmonize(spark, sf_dir):
    rows = _parsed(spark, sf_dir).transform(csq.harmonize_consequence)
    return rows.select("uid", "transcript", "consequence", F.col("priority").cast("bigint").alias("priority"), "variantEffect")


@query
def csq_transcripts(spark, sf_dir):
    rows = csq.join_transcripts(_parsed(spark, sf_dir), _transcripts(spark, sf_dir))
    return rows.select("uid", F.col("transcript").alias("transcript"), "strand", "cdsStart", "cdsEnd", "cdsLength")


@query
def csq_dbnsfp_left(spark, sf_dir):
    rows = csq.join_missense(_parsed(spark, sf_dir), _missense(spark, sf_dir))
    return rows.select("uid", "transcript", "rsid", "ancestralAllele", "delMissenseCount", "missensePredictions", "revel")


@query
def csq_fields(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "uid",
        "transcript",
        "cds",
        "aa",
        "exon",
        "intron",
        "hgvsc",
        "hgvsp",
        "isAncestralAllele",
        "delMissenseCount",
        "missensePredictions",
        "revel",
        "canonical",
    )


@query
def lof_flags(spark, sf_dir):
    return _records(spark, sf_dir).select("uid", "transcript", "variantEffect", "lofFilters")


@query
def csq_effect_groups(spark, sf_dir):
    rows = _records(spark, sf_dir).transform(csq.group_transcripts)
    return rows.select(
        "uid",
        "EnsemblGeneId",
        "variantEffect",
        F.col("priority").cast("bigint").alias("priority"),
        "rsid",
        "revel",
        _transcript_list("completeTranscriptAnnotations").alias("transcripts"),
        F.array_join(F.col("completeTranscriptAnnotations")["lofFilters"], ";").alias("flags"),
    )


def _merged(spark, sf_dir):
    return _records(spark, sf_dir).transform(csq.group_transcripts).transform(csq.merge_effects)


@query
def merge_effects(spark, sf_dir):
    return _merged(spark, sf_dir).select(
        "uid",
        "EnsemblGeneId",
        F.size("allEffects").cast("bigint").alias("n_effects"),
        F.array_join(F.col("allEffects")["variantEffect"], ",").alias("effects"),
        F.col("mostDeleteriousEffect.variantEffect").alias("worst"),
        F.col("canonicalAnnotations.variantEffect").alias("canonical_effect"),
        F.col("canonicalAnnotations.completeTranscriptAnnotations.Transcript").alias("canonical_transcript"),
    )


def _effect_columns(name):
    fields = [
        "variantEffect", "priority", "transcripts", "affectsCanonical", "delMissenseCount", "missensePredictions",
        "revel", *csq.TRANSCRIPT_FIELDS[2:], "HClof",
    ]
    return [F.col(f"{name}.{f}").alias(f) for f in fields]


@query
def most_deleterious(spark, sf_dir):
    rows = csq.most_deleterious(_merged(spark, sf_dir))
    return rows.select("uid", "EnsemblGeneId", *_effect_columns("mostDeleteriousEffect"))


@query
def canonical_effect(spark, sf_dir):
    rows = csq.canonical_effect(_merged(spark, sf_dir))
    return rows.select("uid", "EnsemblGeneId", *_effect_columns("canonicalEffect"))


def _annotated(spark, sf_dir, missense=None):
    text = fixtures.annotated_text(spark, sf_dir)
    missense = _missense(spark, sf_dir) if missense is None else missense
    return pipelines.annotation_table(text, missense, _transcripts(spark, sf_dir))


@query
def annotate_full(spark, sf_dir):
    return _flat_annotation(_annotated(spark, sf_dir))


def _flat_annotation(annotated):
    worst, canonical = F.col("mostDeleteriousEffect"), F.col("canonicalEffect")
    return annotated.select(
        "uid",
        "EnsemblGeneId",
        "rsid",
        "isAncestralAllele",
        F.array_join(F.col("allEffects")["variantEffect"], ",").alias("effects"),
        worst["variantEffect"].alias("worst"),
        worst["transcripts"].alias("worst_transcripts"),
        worst["lofFilters"].alias("worst_flags"),
        worst["HClof"].alias("worst_confidence"),
        canonical["variantEffect"].alias("canonical"),
        canonical["HClof"].alias("canonical_confidence"),
    )


def _own_table(spark, label):
    """A new table name and folder for a bucketed table of one run."""
    path = scratch_path(spark, label)
    return path.rsplit("/", 1)[-1].replace("-", "_"), path


@query
def annotate_stored(spark, sf_dir):
    """Annotation against a missense table that was laid out by its keys beforehand: it is not shuffled again."""
    stored = annotation.store_missense(_missense(spark, sf_dir), *_own_table(spark, "missense"), BUCKETS)
    return _flat_annotation(_annotated(spark, sf_dir, stored))


@query
def annot_joinback_stored(spark, sf_dir):
    """Annotations brought back to population rows that were stored by uid: the genotypes are not shuffled again."""
    annotated = _annotated(spark, sf_dir).select("uid", "EnsemblGeneId", "mostDeleteriousEffect")
    split = fixtures.pvcf(spark, sf_dir).transform(sites.strip_contig).transform(multiallelic.split_multiallelics)
    stored = bucketed.write_bucketed(split.transform(sites.site_to_uid), *_own_table(spark, "population"), ["uid"], BUCKETS)
    return _joined_back(stored, annotated)


@query
def annot_joinback(spark, sf_dir):
    annotated = _annotated(spark, sf_dir).select("uid", "EnsemblGeneId", "mostDeleteriousEffect")
    split = fixtures.pvcf(spark, sf_dir).transform(sites.strip_contig).transform(multiallelic.split_multiallelics)
    return _joined_back(split.transform(sites.site_to_uid), annotated)


def _joined_back(split, annotated):
    return csq.join_back(split, annotated).select(
        "sid",
        "uid",
        F.size("genotypes").cast("bigint").alias("n_genotypes"),
        "EnsemblGeneId",
        F.col("mostDeleteriousEffect.HClof").alias("confidence"),
    )


# --- summary statistics -----------------------------------------------------------------------------


def _study(spark, sf_dir, name=OLD_BUILD_STUDY):
    return sumstats_source.find_study(fixtures.studies(spark, sf_dir), name)


def _clean(spark, sf_dir):
    raw = fixtures.sumstats_raw(spark, sf_dir)
    return raw.transform(sumstats.qc_summary_stats, _study(spark, sf_dir))


def _body(spark, sf_dir):
    return _clean(spark, sf_dir).transform(sumstats.to_vcf_rows)


def _lifted(spark, sf_dir):
    chain, reference = fixtures.chain(spark, sf_dir), fixtures.reference(spark, sf_dir)
    return liftover.liftover(_body(spark, sf_dir), chain, reference)


@query
def meta_lookup(spark, sf_dir):
    found = sumstats_source.study_row(fixtures.studies(spark, sf_dir), NEW_BUILD_STUDY)
    return found.select("study", "phenotype_file", "phenotype", "build", "infoScore", "cases_AF", "total_N", "cases_N")


@query
def ss_read(spark, sf_dir):
    """The study's table written as TSV, then its mapped columns read back."""
    path = scratch_path(spark, "study")
    raw = fixtures.sumstats_raw(spark, sf_dir)
    raw.select("*", F.lit("unused").alias("extra")).write.csv(path, sep="\t", header=True)
    study = _study(spark, sf_dir)
    rows = sumstats.rename_columns(sumstats_source.read_summary_stats(spark, path, study), study)
    return rows.select("CHR", "POS", "ID", "otherAllele", "effectAllele", *_round("SE", "beta", "pvalue", "infoScore"))


@query
def ss_rename(spark, sf_dir):
    rows = sumstats.rename_columns(fixtures.sumstats_raw(spark, sf_dir), _study(spark, sf_dir))
    values = _round("SE", "beta", "effect_AF", "cases_AF")
    return rows.select("CHR", "POS", "ID", "otherAllele", *values, "total_N", "cases_N", "study", "phenotype")


@query
def ss_qc(spark, sf_dir):
    values = _round("SE", "beta", "pvalue", "infoScore", "effect_AF", "cases_AF", "controls_AF")
    return _clean(spark, sf_dir).select("CHR", "POS", "ID", "otherAllele", "effectAllele", *values)


@query
def ss_qc_cases_af(spark, sf_dir):
    """The optional filter on the frequency among cases."""
    raw, study = fixtures.sumstats_raw(spark, sf_dir), _study(spark, sf_dir)
    rows = sumstats.qc_summary_stats(raw, study, filter_cases_af=True)
    return rows.select("CHR", "POS", "ID", "otherAllele", "effectAllele", *_round("cases_AF"))


@query
def ss_funnel(spark, sf_dir):
    counts = sumstats.summary_funnel(fixtures.sumstats_raw(spark, sf_dir), _study(spark, sf_dir))
    return counts.withColumn("step_no", F.col("step_no").cast("bigint"))


def _all_studies(spark, sf_dir):
    paths = fixtures.write_studies_text(spark, sf_dir, scratch_path(spark, "studies"))
    return sumstats_source.read_studies(spark, paths, fixtures.studies(spark, sf_dir))


@query
def ss_qc_all(spark, sf_dir):
    """All studies of the metadata, of three column layouts, read and cleaned in one plan."""
    rows = sumstats.qc_studies(_all_studies(spark, sf_dir)).transform(sumstats.info_text)
    values = _round("SE", "beta", "pvalue", "infoScore", "effect_AF", "cases_AF", "controls_AF")
    names = ("phenotype_file", "study", "phenotype", "build", "CHR", "POS", "ID", "otherAllele", "effectAllele")
    return rows.select(*names, *values, "INFO")


@query
def ss_funnel_all(spark, sf_dir):
    counts = sumstats.studies_funnel(_all_studies(spark, sf_dir))
    return counts.withColumn("step_no", F.col("step_no").cast("bigint"))


@query
def ss_info_build(spark, sf_dir):
    return _clean(spark, sf_dir).transform(sumstats.info_text).select("CHR", "POS", "ID", "INFO")


@query
def ss_vcf_body(spark, sf_dir):
    return vcf.body_lines(_body(spark, sf_dir))


@query
def src_sites_vcf(spark, sf_dir):
    """Sites written as sorted variant text under its header, then read back."""
    path = scratch_path(spark, "sites")
    vcf.write_sites(_body(spark, sf_dir), path)
    return vcf.read_sites(spark, path)


@query
def info_parse(spark, sf_dir):
    rows = _body(spark, sf_dir).withColumn("INFO", F.concat("INFO", F.when(F.col("POS") % 2 == 0, ";SwappedAlleles").otherwise(";a=b=c;FLAG")))
    return harmonise.parse_info(rows).select(
        "CHR",
        "POS",
        "ID",
        "effectAllele",
        "phenotype",
        "study",
        "SwappedAlleles",
        "OriginalContig",
        "OriginalStart",
        "total_N",
        "snp_N",
        *_round(*harmonise.FRACTIONS),
    )


@query
def swap_fix(spark, sf_dir):
    rows = harmonise.parse_info(
        _body(spark, sf_dir).withColumn("INFO", F.concat("INFO", F.when(F.col("POS") % 2 == 0, ";SwappedAlleles").otherwise("")))
    )
    return harmonise.swap_fix(rows).select(
        "CHR",
        "POS",
        "ID",
        "effectAllele",
        "effectAllele_pre_swap",
        *_round("beta", "effect_AF", "cases_AF", "controls_AF"),
    )


@query
def liftover_query(spark, sf_dir):
    rows = liftover.lifted_rows(_lifted(spark, sf_dir))
    return rows.select("CHR", "POS", "ID", "REF", "ALT", "INFO")


@query
def liftover_reject(spark, sf_dir):
    return liftover.rejected_rows(_lifted(spark, sf_dir)).select("CHR", "POS", "ID", "reject_reason")


@query
def liftover_chains(spark, sf_dir):
    """Overlapping chains, spans over gaps and multi-base alleles: every row once, lifted or with its reason."""
    chains, reference = fixtures.chain_layers(spark, sf_dir), fixtures.reference(spark, sf_dir)
    rows = liftover.liftover(fixtures.spans(spark, sf_dir), chains, reference)
    return rows.select("ID", "CHR", "POS", "REF", "ALT", "SwappedAlleles", "OriginalContig", "OriginalStart", "reject_reason")


@query
def swap_count(spark, sf_dir):
    return liftover.count_swapped(liftover.lifted_rows(_lifted(spark, sf_dir)))


@query
def ref_check(spark, sf_dir):
    rows = normalize.fix_reference(_body(spark, sf_dir), fixtures.reference(spark, sf_dir))
    return rows.select("CHR", "POS", "ID", "REF", "ALT", "ref_fixed")


def _indels(spark, sf_dir):
    """An insertion or deletion of 1 to 6 reference bases after each order's position."""
    span = "array_join(transform(sequence(1L, k % 6 + 1), i -> {}), '')".format(fixtures.base("p + i"))
    return (
        fixtures.spread(fixtures.table(spark, sf_dir, "orders").select("o_orderkey"))
        .selectExpr("o_orderkey AS k", f"{fixtures.label('o_orderkey')} AS CHR", "o_orderkey * 37 + 1 AS p")
        .selectExpr("k", "CHR", "p AS POS", f"{fixtures.base('p')} AS first", f"{span} AS span")
        .selectExpr(
            "k",
            "CHR",
            "POS",
            "IF(k % 2 = 0, concat(first, span), first) AS REF",
            "IF(k % 2 = 0, first, concat(first, span)) AS ALT",
        )
    )


@query
def left_align(spark, sf_dir):
    rows = normalize.left_align(_indels(spark, sf_dir), fixtures.reference(spark, sf_dir))
    return rows.select("k", "CHR", "POS", "REF", "ALT")


@query
def uniq_uid(spark, sf_dir):
    raw = fixtures.sumstats_raw(spark, sf_dir)
    rows = raw.withColumn("uid", alleles.uid(F.col("chrom"), F.col("bp"), F.lit("A"), F.lit("C")))
    return harmonise.unique_rows(rows.select("uid", "chrom", "bp", "marker"))


def _harmonised_columns(rows):
    return rows.select(
        "uid",
        "CHR",
        "POS",
        "ID",
        "REF",
        "ALT",
        "effectAllele",
        "OriginalContig",
        "OriginalStart",
        "SwappedAlleles",
        "effectAllele_pre_swap",
        *_round(*harmonise.FRACTIONS),
        "total_N",
        "cases_N",
        "controls_N",
        "snp_N",
        "phenotype",
        "study",
    )


@query
def harmonised(spark, sf_dir):
    """A study on the old build: cleaned, lifted, aligned and formatted."""
    raw, chain = fixtures.sumstats_raw(spark, sf_dir), fixtures.chain(spark, sf_dir)
    study, reference = _study(spark, sf_dir), fixtures.reference(spark, sf_dir)
    return _harmonised_columns(pipelines.harmonise_study(raw, study, reference, chain))


@query
def harmonised_same_build(spark, sf_dir):
    """A study already on the target build: REF fixed instead of lifted."""
    study = _study(spark, sf_dir, NEW_BUILD_STUDY)
    raw = fixtures.sumstats_raw(spark, sf_dir, study.build)
    return _harmonised_columns(pipelines.harmonise_study(raw, study, fixtures.reference(spark, sf_dir)))


# --- text in and out --------------------------------------------------------------------------------


@query
def src_vcf_invalid_loci(spark, sf_dir):
    """Variant lines with recoded contigs, unknown contigs and positions off the end."""
    named = fixtures.sites(spark, sf_dir).selectExpr(
        r"""concat_ws('\t',
            CASE WHEN sid % 17 = 0 THEN 'chrUn_1' WHEN sid % 5 = 0 THEN contigName ELSE substr(contigName, 4) END,
            CASE WHEN sid % 13 = 0 THEN '0' WHEN sid % 19 = 0 THEN '400000000' ELSE CAST(POS AS STRING) END,
            concat('s', sid), ref, IF(n_alt = 2, concat(alt1, ',', alt2), alt1), '.', 'PASS', 'AC=1;DB',
            'GT:AD:DP', '0/1:3,.:9', './.:.:.', '1|1') AS value"""
    )
    parsed = vcf.valid_loci(vcf.parse_pvcf(named, ["p", "q", "r"]))
    return parsed.select("contigName", "start", "referenceAllele", "alternateAlleles", F.inline("genotypes")).select(
        "contigName",
        "start",
        "referenceAllele",
        F.array_join("alternateAlleles", ",").alias("alts"),
        "sampleId",
        F.array_join("calls", ",").alias("calls"),
        "phased",
        F.col("depth").cast("bigint").alias("depth"),
        F.size("alleleDepths").cast("bigint").alias("n_depths"),
        _at("alleleDepths", 0).cast("bigint").alias("ad0"),
        _at("alleleDepths", 1).cast("bigint").alias("ad1"),
    )


@query
def matrix_roundtrip(spark, sf_dir):
    """Split rows with bare contig labels, written as the two matrix tables and read back."""
    rows = pipelines.split_for_qc(fixtures.pvcf(spark, sf_dir)).select(
        "sid", F.col("a_index").cast("bigint").alias("a_index"), F.substring("contigName", 4, 9).alias("contigName"), "start", "genotypes"
    )
    keyed = rows.withColumn("vid", F.col("sid") * 2 + F.col("a_index") - 1)
    path = scratch_path(spark, "matrix")
    matrix.write_matrix(keyed, path, "vid", sample_index=_sample)
    sites, entries = matrix.read_matrix(spark, path)
    counted = entries.groupBy("contigName", "vid").agg(F.count("*").alias("n_entries"), F.sum("n_alt").cast("bigint").alias("n_alt"))
    return sites.join(counted, ["contigName", "vid"]).select("contigName", "vid", "start", "a_index", "n_entries", "n_alt")


@query
def src_vcf(spark, sf_dir):
    """Population text of all entries with its header, read back as nested rows with every FORMAT field."""
    path = scratch_path(spark, "pvcf")
    fixtures.write_pvcf_text(spark, sf_dir, path)
    rows = vcf.read_pvcf(spark, path)
    return rows.select("contigName", "start", "end", F.col("attributes")["SID"].alias("sid"), F.inline("genotypes")).select(
        "contigName",
        "start",
        "end",
        "sid",
        "sampleId",
        F.array_join("calls", ",").alias("calls"),
        "phased",
        F.col("depth").cast("bigint").alias("depth"),
        F.col("conditionalQuality").cast("bigint").alias("quality"),
        F.array_join(F.col("PL").cast("array<string>"), ",").alias("likelihoods"),
        F.round("AB", 6).alias("balance"),
        F.col("FT").alias("filter"),
    )


@query
def fix_multi_pl(spark, sf_dir):
    """Likelihoods read from text, carried through the projection and down-coded to each split allele."""
    path = scratch_path(spark, "pvcf")
    fixtures.write_pvcf_text(spark, sf_dir, path)
    rows = vcf.read_pvcf(spark, path).withColumn("sid", F.col("attributes")["SID"])
    called = genotypes.process_genotypes(rows, extra_fields=["PL"])
    split = multiallelic.correct_multiallelics(multiallelic.split_multiallelics(called, "downcode"), "downcode")
    cells = split.select("sid", "a_index", F.inline("genotypes")).where("sampleId IS NOT NULL")
    return cells.select(
        "sid",
        F.col("a_index").cast("bigint").alias("a_index"),
        "sampleId",
        F.array_join("calls", ",").alias("calls"),
        F.array_join(F.col("PL").cast("array<string>"), ",").alias("likelihoods"),
        F.col("conditionalQuality").cast("bigint").alias("quality"),
    )


@query
def pipe_sites(spark, sf_dir):
    """Sorted rows through one external process per partition; the command marks every data line."""
    lines = annotation.pipe_sites(_body(spark, sf_dir), r"sed -e '/^#/d' -e 's/$/\tseen/'")
    return lines.select(F.col("text").alias("line"))
