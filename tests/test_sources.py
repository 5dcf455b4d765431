"""Text and table round trips."""

import gzip

import pytest
from pyspark.sql import functions as F

from siteloom.plans import fixtures, pipelines
from siteloom.sources import annotation, matrix, vcf
from siteloom.streaming import STATELESS

HEADER = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{}\n"
LINES = (
    "1\t10\trs1\tA\tC,G\t9.5\tPASS\tAC=1;DB;AF=0.5\tGT:AD:DP:GQ\t0|1:3,4,.:7:50\t./.:.:.:.\n"
    "chr2\t20\t.\tAT\tA\t.\tq10;s50\tX=1;X=2\tDP:GT\t5:1/1\t.\n"
    "X\t0\t.\tA\tC\t.\tPASS\t.\tGT\t1\t0\n"
    "weird\t5\t.\tA\tC\t.\tPASS\t.\tGT\t0/0\t0/0\n"
    "22\t99999999\t.\tA\tC\t.\tPASS\t.\tGT\t0/0\t0/0\n"
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.vcf").write_text(HEADER.format("p\tq") + LINES)
    return tmp_path


def test_read_population_text(spark, folder):
    rows = {r.contigName: r for r in vcf.read_pvcf(spark, str(folder)).collect()}
    one, two, x = rows["1"], rows["chr2"], rows["X"]
    assert (one.start, one.end, one.alternateAlleles, one.qual, one.filters) == (9, 10, ["C", "G"], 9.5, ["PASS"])
    assert one.attributes == {"AC": "1", "DB": None, "AF": "0.5"}
    p, q = one.genotypes
    assert (p.calls, p.sampleId, p.phased, p.depth, p.conditionalQuality) == ([0, 1], "p", True, 7, 50)
    assert p.alleleDepths == [3, 4, None]
    assert (q.calls, q.sampleId, q.phased, q.depth, q.alleleDepths) == ([-1, -1], "q", False, None, [None])
    assert (two.end, two.qual, two.filters, two.attributes) == (21, None, ["q10", "s50"], {"X": "1"})
    assert two.genotypes[0].calls == [1, 1] and two.genotypes[0].depth == 5
    assert two.genotypes[1].calls == [-1, -1] and two.genotypes[0].alleleDepths is None
    assert x.genotypes[0].calls == [1]


def test_import_recodes_and_skips_invalid_loci(spark, folder):
    assert {r.contigName for r in vcf.import_vcf(spark, str(folder)).collect()} == {"chr1", "chr2"}


def test_import_keeps_the_contigs_of_the_assembly_and_of_the_header(spark, tmp_path):
    names = ["chrUn_JTFH01000001v1_decoy", "chrUn_KN707606v1_decoy", "chr1_KI270706v1_random", "own", "other"]
    top = "##contig=<ID=own,length=30>\n" + HEADER.format("p\tq")
    lines = [f"{name}\t{at}\t.\tA\tC\t.\tPASS\t.\tGT\t0/0\t0/1\n" for name in names for at in (5, 40)]
    (tmp_path / "a.vcf").write_text(top + "".join(lines))
    kept = sorted((r.contigName, r.start) for r in vcf.import_vcf(spark, str(tmp_path)).collect())
    assert kept == sorted([(n, at) for n in names[:3] for at in (4, 39)] + [("own", 4)])
    assert {r.contigName for r in vcf.import_vcf(spark, str(tmp_path), lengths={"other": 9}).collect()} == {*names[:3], "other"}


def test_gzip_input(spark, tmp_path):
    with gzip.open(tmp_path / "a.vcf.gz", "wt") as out:
        out.write(HEADER.format("p\tq") + LINES)
    rows = vcf.import_vcf(spark, str(tmp_path), partitions=3)
    assert rows.count() == 2 and rows.rdd.getNumPartitions() == 3


def test_files_must_agree_on_samples(spark, folder):
    (folder / "b.vcf").write_text(HEADER.format("q\tp") + LINES)
    with pytest.raises(ValueError):
        vcf.read_pvcf(spark, str(folder))
    (folder / "c").mkdir()
    (folder / "c" / "none.vcf").write_text("##x\n")
    with pytest.raises(ValueError):
        vcf.read_pvcf(spark, str(folder / "c"))


def test_sites_only_population_text(spark, tmp_path):
    (tmp_path / "s.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n1\t5\t.\tA\tC\t.\t.\tk=v\n")
    row = vcf.read_pvcf(spark, str(tmp_path)).first()
    assert row.genotypes == [] and row.start == 4


def body(spark, n=500):
    return spark.range(n).selectExpr(
        "CAST(id % 3 + 1 AS STRING) AS CHR", "(id * 7919) % 10007 AS POS", "concat('r', id) AS ID", "'A' AS REF",
        "'C' AS ALT", "'.' AS QUAL", "'.' AS FILTER", "'k=v' AS INFO",
    )


def test_written_sites_are_one_sorted_file(spark, tmp_path):
    path = tmp_path / "out"
    vcf.write_sites(body(spark), str(path))
    text = "".join(p.read_text() for p in sorted(path.glob("part-*"))).splitlines()
    assert text[:2] == vcf.SITES_HEADER and len(text) == 502
    keys = [(line.split("\t")[0], int(line.split("\t")[1])) for line in text[2:]]
    assert keys == sorted(keys)
    back = vcf.read_sites(spark, str(path))
    assert back.exceptAll(body(spark)).count() == 0 and back.count() == 500


def test_pipe_sorts_and_gives_every_process_the_header(spark):
    lines = annotation.pipe_sites(body(spark), "cat", partitions=4)
    rows = lines.withColumn("part", F.spark_partition_id()).collect()
    parts = {}
    for row in rows:
        parts.setdefault(row.part, []).append(row.text)
    assert len(parts) == 4
    for texts in parts.values():
        assert texts[:2] == vcf.SITES_HEADER
        keys = [(t.split("\t")[0], int(t.split("\t")[1])) for t in texts[2:]]
        assert keys == sorted(keys) and all(len(t.split("\t")) == 8 for t in texts[2:])
    assert sum(len(t) - 2 for t in parts.values()) == 500


def test_pipe_quotes_the_command(spark):
    lines = annotation.pipe_sites(body(spark, 3), r"""awk '!/^#/ {print $1 "\\" "'"'"'"}'""", partitions=1)
    assert sorted(r.text for r in lines.collect()) == ["1\\'", "2\\'", "3\\'"]


def test_matrix_round_trip(spark, sf_dir, tmp_path):
    df = pipelines.matrix_qc(fixtures.pvcf(spark, sf_dir)).drop("attributes")
    matrix.write_matrix(df, str(tmp_path), "sid")
    sites, entries = matrix.read_matrix(spark, str(tmp_path))
    assert sites.count() == df.count()
    assert entries.count() == df.select(F.sum(F.size("genotypes"))).first()[0]
    plan = sites.where("contigName = 'chr1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(contigName" in plan
    matrix.export_probabilities(df, str(tmp_path / "gp"), "sid")
    assert spark.read.parquet(str(tmp_path / "gp")).count() == entries.count()


def test_row_local_operators_run_on_a_stream(spark, tmp_path):
    assert len(STATELESS) == len(set(STATELESS))
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    pvcf = fixtures.pvcf(spark, "/root/testdata/sf0.001")
    pvcf.write.parquet(source)
    stream = spark.readStream.schema(pvcf.schema).parquet(source)
    run = pipelines.lookup_table(stream).writeStream.option("checkpointLocation", state).trigger(availableNow=True)
    run.start(sink, format="parquet").awaitTermination(120)
    assert spark.read.parquet(sink).count() == pipelines.lookup_table(pvcf).count()
