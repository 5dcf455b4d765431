"""Consequence branches on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from siteloom.functions import consequence
from siteloom.operators import csq
from siteloom.sources import annotation


def record(**fields):
    parts = [""] * 25
    for name, value in fields.items():
        parts[consequence.RECORD_FIELDS[name]] = value
    return "|".join(parts)


@pytest.mark.parametrize("term,entry", [*consequence.TERMS.items(), ("made_up", consequence.OTHER)])
def test_every_term(spark, term, entry):
    df = spark.range(1).select(consequence.worst_effect(F.lit(term)).alias("e"))
    assert tuple(df.first().e) == entry


def test_worst_of_several_terms(spark):
    worst = consequence.worst_effect(F.lit("intron_variant&splice_donor_variant&missense_variant"))
    assert tuple(spark.range(1).select(worst.alias("e")).first().e) == (3, "splice_donor", True)


def test_parse_keeps_apostrophes_and_short_records(spark):
    text = ",".join([record(consequence="stop_gained", GeneName="O'G"), "A|missense_variant"])
    rows = csq.parse_csq(spark.createDataFrame([("u", text)], "uid string, csqs string")).collect()
    assert [(r.consequence, r.GeneName, r.mane) for r in rows] == [
        ("stop_gained", "O'G", ""),
        ("missense_variant", None, None),
    ]


FLAG_SCHEMA = (
    "variantEffect string, priority int, POS bigint, strand string, cds_position string, cdsLength bigint,"
    " hgvsc string, isAncestralAllele boolean, want string"
)


def test_lof_flags_every_branch(spark):
    def row(effect, priority, pos=500, strand="+", cds="1", hgvsc=None, ancestral=False, want="NA"):
        return (effect, priority, pos, strand, cds, 100, hgvsc, ancestral, want)

    rows = [
        row("splice_donor", 3),
        row("splice_donor", 3, pos=100, want="5_UTR_splice"),
        row("splice_acceptor", 4, pos=900, want="3_UTR_splice"),
        row("splice_donor", 3, pos=900, strand="-", want="5_UTR_splice"),
        row("splice_acceptor", 4, pos=100, strand="-", want="3_UTR_splice"),
        row("missense", 7, pos=1),
        row("splice_donor", 3, hgvsc="c.5+2C>T", want="GC_2_GT_donor"),
        row("splice_acceptor", 4, hgvsc="c.5+2C>T"),
        row("splice_donor", 3, pos=1, hgvsc="c.5+2C>T", want="5_UTR_splice,GC_2_GT_donor"),
        row("frameshift", 2, cds="95", want="EndTrunc"),
        row("stop_gained", 1, cds="94"),
        row("stop_gained", 1, cds="?"),
        row("stop_gained", 1, cds=""),
        row("missense", 7, cds="99"),
        row("stop_gained", 1, ancestral=True),
        row("splice_acceptor", 4, ancestral=True, want="ancestral_allele"),
        row("splice_acceptor", 4, pos=900, ancestral=True, want="3_UTR_splice,ancestral_allele"),
    ]
    df = spark.createDataFrame(rows, FLAG_SCHEMA).withColumns({"cdsStart": F.lit(100), "cdsEnd": F.lit(900)})
    assert csq.lof_flags(df).where("lofFilters <> want").collect() == []
    relaxed = csq.lof_flags(df, ancestral_rule=F.col("priority") <= 4)
    assert relaxed.where("priority = 1 AND lofFilters = 'ancestral_allele'").count() == 1


def annotated(spark, records, revel="0.5", alt="C"):
    sites = spark.createDataFrame(
        [("1:5:A:C", "1", 5, "A", alt, ",".join(records))],
        "uid string, CHR string, POS bigint, REF string, ALT string, csqs string",
    )
    raw_missense = spark.createDataFrame(
        [("1", 5, "A", "C", "E1", "C", "rs1", "D", "4", ".", revel)],
        "CHR string, POS bigint, REF string, ALT string, EnsemblGeneId string, ancestralAllele string,"
        " rsid_151 string, missensePredictions string, n string, MetaSVM string, Revel string",
    ).withColumnRenamed("n", "")
    raw_transcripts = spark.createDataFrame(
        [(f"T{i}", "G1", "E1", "+", "1", 1, 9, 300) for i in range(4)],
        "Transcript string, GeneName string, EnsemblGeneId string, Strand string, CHR string, Start bigint,"
        " End bigint, CDSLength bigint",
    )
    missense, transcripts = csq.prepare_missense(raw_missense), csq.prepare_transcripts(raw_transcripts)
    return csq.annotate(sites, "csqs", missense, transcripts)


def gene_record(i, term, **more):
    return record(consequence=term, EnsemblGeneId="E1", GeneName="G1", transcript=f"T{i}", **more)


def test_annotation_of_one_gene(spark):
    out = annotated(
        spark,
        [
            gene_record(0, "missense_variant", canonical="YES", hgvsc="T0:c.1A>C", exon="2/7", cds_position="12-13"),
            gene_record(1, "stop_gained", hgvsc="no colon", protein_position="4"),
            gene_record(2, "missense_variant"),
            gene_record(9, "frameshift_variant"),  # not a known transcript
        ],
    )
    row = out.first()
    assert out.count() == 1 and row.rsid == "rs1" and row.isAncestralAllele is True
    assert [(e.priority, e.delMissenseCount) for e in row.allEffects] == [(1, None), (7, "4")]
    worst, canonical = row.mostDeleteriousEffect, row.canonicalEffect
    assert (worst.variantEffect, worst.priority, worst.transcripts, worst.HClof) == ("stop_gained", "1", "T1", "HC")
    assert (worst.hgvsc, worst.aa, worst.affectsCanonical) == ("", "4_100", False)
    assert (canonical.variantEffect, canonical.transcripts, canonical.HClof) == ("missense", "T0", "NA")
    assert (canonical.hgvsc, canonical.exon, canonical.cds, canonical.revel) == ("c.1A>C", "2_7", "12_300", "0.5")
    assert canonical.affectsCanonical is True


def test_confidence_of_lost_start_and_flagged_effects(spark):
    lost = annotated(spark, [gene_record(0, "start_lost")]).first()
    assert lost.mostDeleteriousEffect.HClof == "LC" and lost.canonicalEffect is None
    flagged = annotated(spark, [gene_record(0, "stop_gained", cds_position="299", canonical="YES")], revel=".").first()
    assert flagged.mostDeleteriousEffect.HClof == flagged.canonicalEffect.HClof == "LC"
    assert flagged.canonicalEffect.lofFilters == "EndTrunc" and flagged.canonicalEffect.revel is None


def test_repeated_missense_keys_are_reported(spark):
    one = spark.createDataFrame([("u", "1", 1, "A", "C", "E")], "uid string, CHR string, POS bigint, REF string, ALT string, EnsemblGeneId string")
    assert csq.repeated_missense_keys(one).count() == 0
    assert csq.repeated_missense_keys(one.unionByName(one)).first()["count"] == 2


def test_text_parse_drops_headers_and_bare_lines(spark):
    lines = ["##x", "1\t5\t.\tA\tC\t.\t.\tCSQ=a|b", "1\t6\t.\tA\tC\t.\t.\tAC=1", "1\t7\t.\tA\t<#>\t.\t.\tAC=1;CSQ=c=d;Z=1"]
    out = annotation.parse_annotated_text(spark.createDataFrame([(x,) for x in lines], "text string"))
    assert sorted((r.uid, r.csqs) for r in out.collect()) == [("1:5:A:C", "a|b"), ("1:7:A:<#>", "c=d")]


def test_records_are_shuffled_once(spark):
    """One exchange by the missense keys serves the join and both gatherings."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = annotated(spark, [gene_record(0, "stop_gained")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the records and the missense table
