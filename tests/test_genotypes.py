"""Hand-made genotype rows, one per branch."""

import math
from itertools import product

import pytest
from pyspark.sql import functions as F

from siteloom.operators import genotypes, multiallelic, site_qc, sites

GENOTYPE = (
    "array<struct<calls:array<int>,sampleId:string,phased:boolean,depth:int,conditionalQuality:int,"
    "alleleDepths:array<int>>>"
)
SCHEMA = (
    "contigName string, start bigint, end bigint, referenceAllele string, alternateAlleles array<string>,"
    f" filters array<string>, qual double, attributes map<string,string>, genotypes {GENOTYPE}"
)


def site(spark, calls, alts=("C",), depths=None, contig="chr1"):
    depths = depths or [(10, [5, 5])] * len(calls)
    gts = [(c, f"s{i}", False, d, 30, ad) for i, (c, (d, ad)) in enumerate(zip(calls, depths))]
    return spark.createDataFrame([(contig, 9, 10, "A", list(alts), ["PASS"], 1.0, {"k": "v"}, gts)], SCHEMA)


def calls_of(df):
    return [[list(g.calls) for g in r.genotypes] for r in df.collect()]


def test_process_strips_prefix_blanks_half_calls_and_drops_attributes(spark):
    out = genotypes.process_genotypes(site(spark, [[0, 1], [1, -1], [-1, -1]]))
    row = out.first()
    assert row.contigName == "1" and "attributes" not in out.columns
    assert [list(g.calls) for g in row.genotypes] == [[0, 1], [-1, -1], [-1, -1]]
    assert row.called == [True, False, False]


def test_extra_fields_are_kept(spark):
    extra = site(spark, [[0, 1]]).withColumn(
        "genotypes", F.transform("genotypes", lambda g: g.withField("ploidy", F.lit(2)))
    )
    assert genotypes.process_genotypes(extra, ["ploidy"]).first().genotypes[0].ploidy == 2
    assert "ploidy" not in genotypes.process_genotypes(extra).first().genotypes[0]


@pytest.mark.parametrize("contig", ["1", "chr1", "CHR1", "Chr1"])
def test_contig_prefixes(spark, contig):
    assert sites.strip_contig(site(spark, [[0, 0]], contig=contig)).first().contigName == "1"


def test_split_then_correct_gives_masked_alleles_back(spark):
    raw = site(spark, [[0, 0], [0, 1], [0, 2], [1, 2], [2, 2], [1, -1], [2, 1]], alts=("C", "G"))
    split = genotypes.process_genotypes(raw).transform(multiallelic.split_multiallelics).orderBy("a_index")
    assert calls_of(split)[0] == [[0, 0], [0, 1], [0, -1], [1, -1], [-1, -1], [-1, -1], [-1, 1]]
    fixed = calls_of(multiallelic.correct_multiallelics(split))
    assert fixed[0] == [[0, 0], [0, 1], [0, 0], [0, 1], [-1, -1], [-1, -1], [0, 1]]
    assert fixed[1] == [[0, 0], [0, 0], [0, 1], [0, 1], [1, 1], [-1, -1], [0, 1]]
    labels = [r.INFO_OLD_MULTIALLELIC for r in split.collect()]
    assert labels == ["1:10:A/C/G"] * 2


def test_downcode_mode_counts_other_alternates_as_reference(spark):
    depths = [(10, [1, 2, 7])] * 2
    raw = site(spark, [[2, 2], [1, 2]], alts=("C", "G"), depths=depths).transform(genotypes.mark_called)
    split = multiallelic.split_multiallelics(raw, "downcode").orderBy("a_index")
    fixed = multiallelic.correct_multiallelics(split, "downcode").collect()
    assert [[list(g.calls) for g in r.genotypes] for r in fixed] == [[[0, 0], [1, 0]], [[1, 1], [0, 1]]]
    assert [list(r.genotypes[0].alleleDepths) for r in fixed] == [[8, 2], [3, 7]]


def test_biallelic_rows_pass_through(spark):
    raw = genotypes.process_genotypes(site(spark, [[1, 0], [0, -1]]))
    out = raw.transform(multiallelic.split_multiallelics).transform(multiallelic.correct_multiallelics)
    row = out.first()
    assert calls_of(out) == [[[1, 0], [-1, -1]]]
    assert row.splitFromMultiAllelic is False and row.INFO_OLD_MULTIALLELIC is None


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        multiallelic.split_multiallelics(site(spark, [[0, 0]]), "other")


def test_call_stats_add_up(spark):
    every = [list(c) for c in product([-1, 0, 1, 2], repeat=2)]
    row = genotypes.call_summary_stats(site(spark, every, alts=("C", "G"))).first()
    assert row.nCalled + row.nUncalled == 16 and row.nCalled == 9
    assert row.nHet + sum(row.nHomozygous) == row.nCalled
    assert row.nHomozygous == [1, 1, 1] and row.alleleCounts == [6, 6, 6] and row.nNonRef == 8
    assert sum(row.alleleFrequencies) == pytest.approx(1) and row.callRate == pytest.approx(9 / 16)


def test_empty_genotypes_give_nulls_not_errors(spark):
    empty = site(spark, [])
    row = genotypes.hardy_weinberg(genotypes.call_summary_stats(empty)).first()
    assert row.callRate is None and row.nCalled == 0 and row.alleleFrequencies == [None, None]
    counted = genotypes.call_summary_stats(empty).transform(sites.depth_quartiles)
    assert counted.first().depth_quartiles == [None, None, None]


def exact(rr, het, aa):
    """Probabilities of every heterozygote count, from factorials."""
    n, rare = rr + het + aa, 2 * min(rr, aa) + het
    lf = math.lgamma
    logs = {
        h: h * math.log(2) - lf(h + 1) - lf((rare - h) / 2 + 1) - lf(n - (rare + h) / 2 + 1)
        for h in range(rare % 2, rare + 1, 2)
    }
    top = max(logs.values())
    weights = {h: math.exp(v - top) for h, v in logs.items()}
    total = sum(weights.values())
    return {h: w / total for h, w in weights.items()}


@pytest.mark.parametrize("counts", [(298, 489, 213), (10, 0, 0), (0, 7, 0), (5, 1, 5), (50, 49, 2), (0, 0, 0), (3, 0, 9), (1, 200, 3)])
def test_equilibrium_tests_match_the_distribution(spark, counts):
    rr, het, aa = counts
    df = spark.range(1).select(F.array(F.lit(rr), F.lit(aa)).alias("nHomozygous"), F.lit(het).alias("nHet"))
    row = df.transform(genotypes.hardy_weinberg).transform(genotypes.excess_heterozygosity).first()
    p = exact(rr, het, aa)
    seen = p[het]
    two = sum(v if v < seen * (1 - 1e-9) else 0.5 * v for v in p.values() if v <= seen * (1 + 1e-9))
    assert row.pValueHwe == pytest.approx(two, rel=1e-8)
    assert row.pValueExcessHet == pytest.approx(sum(v for h, v in p.items() if h > het) + 0.5 * seen, rel=1e-8)
    assert sum(p.values()) == pytest.approx(1)


def test_equilibrium_published_value(spark):
    df = spark.range(1).select(F.array(F.lit(298), F.lit(213)).alias("nHomozygous"), F.lit(489).alias("nHet"))
    assert genotypes.hardy_weinberg(df).first().pValueHwe == pytest.approx(0.633097, abs=1e-6)


@pytest.mark.parametrize("counts", [(100000, 0, 100000), (0, 200000, 0), (90000, 5, 60000)])
def test_equilibrium_far_tails_stay_finite(spark, counts):
    rr, het, aa = counts
    df = spark.range(1).select(F.array(F.lit(rr), F.lit(aa)).alias("nHomozygous"), F.lit(het).alias("nHet"))
    row = df.transform(genotypes.hardy_weinberg).transform(genotypes.excess_heterozygosity).first()
    assert 0 <= row.pValueHwe < 1e-16
    assert row.pValueExcessHet == pytest.approx(1 if het < 10 else 0, abs=1e-9)


def test_depth_and_balance_summaries(spark):
    calls = [[0, 1], [1, 0], [0, 1], [1, 1], [0, 0], [-1, -1]]
    depths = [(8, [6, 2]), (4, [2, 2]), (0, [0, 0]), (9, [0, 9]), (1, [1, 0]), (99, [9, 9])]
    counted = genotypes.call_summary_stats(site(spark, calls, depths=depths)).transform(
        sites.alt_or_default, "nHomozygous", "homAA"
    )
    row = (
        counted.transform(sites.depth_quartiles)
        .transform(sites.het_allele_balance)
        .transform(sites.hom_allele_balance)
        .first()
    )
    assert row.depth_quartiles == [0, 4, 9]
    # the 0/0-depth heterozygote has no ratio and does not count
    assert tuple(row.het_alleleDepth_quartiles) == (0.25, 0.5, 0.5)
    assert tuple(row.hom_alleleDepth_quartiles) == (1.0, 1.0, 1.0)


def test_balance_is_zero_without_members(spark):
    counted = genotypes.call_summary_stats(site(spark, [[0, 0]])).transform(
        sites.alt_or_default, "nHomozygous", "homAA"
    )
    row = counted.transform(sites.het_allele_balance).transform(sites.hom_allele_balance).first()
    assert tuple(row.het_alleleDepth_quartiles) == tuple(row.hom_alleleDepth_quartiles) == (0.0, 0.0, 0.0)


def test_drop_hom_ref_keeps_missing(spark):
    out = genotypes.drop_hom_ref(site(spark, [[0, 0], [0, 1], [-1, -1], [0, -1]]))
    assert calls_of(out) == [[[0, 1], [-1, -1], [0, -1]]]


def test_imputation_and_probabilities(spark):
    df = site(spark, [[0, 0], [0, 1], [1, 1], [-1, 0]])
    row = df.transform(genotypes.mean_impute).transform(genotypes.genotype_probabilities).first()
    assert row.mean_dosage == 1.0 and row.dosages == [0.0, 1.0, 2.0, 1.0]
    assert row.gp == [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], None]


def test_uid_round_trip(spark):
    df = spark.createDataFrame([("X:1:AT:A",), ("12:5000000001:C:G",)], "uid string")
    back = sites.site_to_uid(sites.uid_to_site(df).withColumnRenamed("uid", "before"))
    assert [(r.before, r.end - r.start) for r in back.where("before = uid").orderBy("POS").collect()] == [
        ("X:1:AT:A", 2),
        ("12:5000000001:C:G", 1),
    ]


def test_snp_rule(spark):
    rows = [("A", "C", True), ("A", "A", False), ("AT", "A", False), ("AT", "AC", True), ("AT", "CC", False)]
    df = spark.createDataFrame(rows, "r string, a string, want boolean")
    from siteloom.functions.alleles import is_snp

    assert df.where(is_snp(F.col("r"), F.col("a")) != F.col("want")).count() == 0


def test_filtering_runs_the_statistics_once(spark):
    """The site filters must not push copies of the genotype expressions below the statistics."""
    df = site_qc.filter_sites(genotypes.variant_qc(site(spark, [[0, 1], [0, 0]])))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_likelihoods_follow_the_split_allele(spark):
    from siteloom.operators import multiallelic
    from siteloom.sources import vcf

    meta = ['##FORMAT=<ID=PL,Number=G,Type=Integer>', '##FORMAT=<ID=AB,Number=1,Type=Float>', '##FORMAT=<ID=FT,Number=.,Type=String>', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tp\tq\tr\ts"]
    rows = [
        "chr1\t5\t.\tA\tC,G\t.\t.\t.\tGT:PL:GQ:AB:FT\t1/2:9,8,7,6,0,5:40:0.5:a,b\t0/0:0,3,.,7,2,1:40:x:.\t./.:.:12\t1:4,0,9:33",
        "chr1\t9\t.\tA\tC\t.\t.\t.\tPL:GT\t0,4,9:0/0\t.:./.\t1,2:0/1\t5,0,5:0|1",
    ]
    lines = spark.createDataFrame([(t,) for t in meta + rows], "value string")
    header = vcf.read_header(lines)
    assert header.formats == {"PL": ("G", "Integer"), "AB": ("1", "Float"), "FT": (".", "String")} and header.samples == list("pqrs")
    site = vcf.parse_pvcf(lines, header.samples, header.formats)
    first = site.where("start = 4").first().genotypes
    assert [(g.PL, g.AB, g.FT) for g in first] == [([9, 8, 7, 6, 0, 5], 0.5, ["a", "b"]), ([0, 3, None, 7, 2, 1], None, None), (None, None, None), ([4, 0, 9], None, None)]
    kept = genotypes.project_genotypes(site, extra_fields=["PL"])

    def split(mode):
        made = multiallelic.split_multiallelics(kept, mode).orderBy("start", "a_index").collect()
        return [[(g.PL, g.conditionalQuality) for g in r.genotypes] for r in made]

    # genotypes in order 00 01 11 02 12 22; for the first alternate 01 and 12 hold it once, 11 twice
    assert split("downcode") == [
        [([5, 0, 7], 5), ([0, 2, None], 2), (None, 12), ([4, 0, 9], 4)],
        [([7, 0, 5], 5), ([0, 2, 1], 1), (None, 12), ([4, 0, 9], 4)],
        [([0, 4, 9], None), (None, None), ([1, 2], None), ([5, 0, 5], None)],
    ]
    assert split("masked")[:2] == [[([9, 8, 7], 40), ([0, 3, None], 40), (None, 12), ([4, 0, 9], 33)], [([9, 6, 5], 40), ([0, 7, 1], 40), (None, 12), ([4, 0, 9], 33)]]
