"""Results don't depend on chunk size, contig name, label form or the size that a broadcast bound sees."""

import random

import pytest
from pyspark.sql import functions as F

from siteloom.operators import liftover, normalize, site_qc
from siteloom.operators.intervals import index_join, pairs_within, range_join
from siteloom.session import checkpoint_root
from siteloom.sources import matrix, vcf

TEXT = "".join(random.Random(8).choice("ACGT") for _ in range(400))
BODY = "CHR string, POS bigint, ID string, REF string, ALT string, QUAL string, FILTER string, INFO string"


def chunks(spark, size):
    rows = [("1", i // size, TEXT[i : i + size]) for i in range(0, len(TEXT), size)]
    return spark.createDataFrame(rows, "contig string, chunk bigint, seq string")


def body(spark):
    def row(i, pos, ref, alt):
        return ("1", pos, f"r{i}", ref, alt, ".", ".", "X=1")

    def at(pos, n):
        return TEXT[pos - 1 : pos - 1 + n]

    rows = [row(0, 5, at(5, 1), "N"), row(1, 7, at(7, 33), at(7, 1)), row(2, 18, at(18, 90), "T"), row(3, 19, at(19, 2), at(19, 1) + "GGG")]
    rows += [row(4, 50, "N" * 45, at(50, 45)), row(5, 390, at(390, 11), "A"), row(6, 395, "ACGTACGTACGT", "A"), row(7, 900, "A", "C"), row(8, 21, "Q", at(21, 1)), row(9, 60, at(60, 21)[:-1] + "N", "A")]
    return spark.createDataFrame(rows, BODY)


@pytest.mark.parametrize("strand", ["+", "-"])
def test_long_alleles_are_lifted_whatever_the_chunk_size(spark, strand):
    chain = spark.createDataFrame([("1", 0, 400, "1", 0, strand)], "srcContig string, srcStart bigint, srcEnd bigint, dstContig string, dstStart bigint, strand string")
    made = [sorted(map(str, liftover.liftover(body(spark), chain, chunks(spark, size), size).collect())) for size in (7, 20, 10_000)]
    assert made[0] == made[1] == made[2]
    if strand == "+":
        reasons = {r.ID: r.reject_reason for r in liftover.liftover(body(spark), chain, chunks(spark, 20), 20).collect()}
        assert [reasons[f"r{i}"] for i in range(10)] == [None, None, None, None, liftover.MISMATCH, None, liftover.SPLIT_TARGET, liftover.NO_TARGET, None, liftover.MISMATCH]


def test_long_alleles_are_checked_whatever_the_chunk_size(spark):
    made = [sorted(map(str, normalize.fix_reference(body(spark), chunks(spark, size), size).collect())) for size in (7, 20, 10_000)]
    assert made[0] == made[1] == made[2]
    fixed = {r.ID: r for r in normalize.fix_reference(body(spark), chunks(spark, 20), 20).collect()}
    assert [fixed[f"r{i}"].ref_fixed for i in (0, 1, 2, 4, 7, 9)] == ["none", "none", "none", "swap", None, "set"]
    assert fixed["r9"].REF == TEXT[59:80]


def test_all_contigs_of_the_assembly_are_kept(spark):
    places = [("M", 5), ("MT", 16568), ("chrM", 16569), ("chr1_KI270706v1_random", 7), ("chrUn_KI270302v1", 3), ("HLA-A*01:01", 1), ("chrX", -1), ("chrUn_1", 4), ("own", 9), ("own", 10), ("22", 50818467), ("22", 50818468)]
    rows = spark.createDataFrame(places, "contigName string, start bigint")
    kept = [(r.contigName, r.start) for r in vcf.valid_loci(rows, {"own": 10}).collect()]
    assert kept == [("chrM", 5), ("chrM", 16568), ("chr1_KI270706v1_random", 7), ("chrUn_KI270302v1", 3), ("HLA-A*01:01", 1), ("own", 9), ("chr22", 50818467)]
    lines = spark.createDataFrame([("##contig=<ID=own,length=10>",), ("##contig=<assembly=x,length=7,ID=b>",), ("##contig=<ID=none>",), ("#CHROM",)], "value string")
    assert vcf.read_header(lines).contigs == {"own": 10, "b": 7}


def test_sex_contigs_by_either_label(spark):
    rows = spark.createDataFrame([("X",), ("chrY",), ("chr1",), ("22",)], "contigName string")
    assert [r.contigName for r in rows.where(site_qc.site_filters()["autosome"]).collect()] == ["chr1", "22"]


def test_matrix_keeps_contig_labels_as_text(spark, tmp_path):
    rows = spark.createDataFrame([("1", 5, "a"), ("22", 6, "b")], "contigName string, start bigint, uid string")
    matrix.write_table(rows, str(tmp_path / "sites"))
    back = matrix.read_table(spark, str(tmp_path / "sites"))
    assert dict(back.dtypes)["contigName"] == "string"
    assert sorted((r.contigName, r.start, r.uid) for r in back.collect()) == [("1", 5, "a"), ("22", 6, "b")]


def test_broadcast_bound_counts_exploded_rows(spark):
    wide = spark.range(10).selectExpr("'1' AS contig", "0L AS lo", "200000000L AS hi", "id AS n")
    points = spark.range(100).selectExpr("'1' AS contig", "id * 1000000 AS at")
    joined = range_join(points, wide, contig="contig", pos="at", start="lo", end="hi", max_broadcast_rows=10)
    assert "_salt" in joined._jdf.queryExecution().analyzed().toString()
    assert joined.count() == 1000
    few = range_join(points, wide, contig="contig", pos="at", start="lo", end="hi", max_broadcast_rows=5000)
    assert "_salt" not in few._jdf.queryExecution().analyzed().toString() and few.count() == 1000


def test_crowded_bin_gives_each_pair_once(spark):
    sites = spark.range(600).selectExpr("'chr1' AS contig", "id AS k", "id DIV 50 AS pos")
    plain, salted = (pairs_within(sites, contig="contig", pos="pos", key="k", window=3, crowd=c).select("a_k", "b_k") for c in (None, 16))
    assert salted.count() == plain.count() and salted.exceptAll(plain).isEmpty()


class Cluster:
    def __init__(self, master):
        self.sparkContext, self.conf, self.master = self, self, master

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        self.set_to = path


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Cluster(master))


def test_a_local_session_may_use_a_temporary_folder():
    assert checkpoint_root(Cluster("local[4]"))


def test_reference_text_never_goes_through_the_driver(spark, sf_dir):
    """Planned sizes go by columns, so a reference of any length looks small enough to broadcast."""
    from siteloom.operators.normalize import _with_left_context
    from siteloom.plans import fixtures

    rows = spark.createDataFrame([("1", 9_999, "ACGT", "A"), ("2", 20_001, "C", "CG")], "CHR string, POS bigint, REF string, ALT string")
    reference = fixtures.reference(spark, sf_dir)
    found = liftover.reference_bases(rows, reference, F.length("REF"))
    context = _with_left_context(rows, reference, liftover.CHUNK, 64)
    for df in (found, context):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        df.collect()
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_chain_index_is_broadcast_by_its_entries_not_its_bins(spark):
    """Few bins may hold many blocks, and a broadcast is gathered on the driver."""
    chain = spark.range(40).selectExpr("'1' AS srcContig", "id AS srcStart", "id + 100 AS srcEnd", "'2' AS dstContig", "id AS dstStart", "'+' AS strand")
    points = spark.createDataFrame([("1", 50), ("1", 500), ("3", 1), (None, 2)], "CHR string, at bigint")
    join = lambda n: index_join(points, liftover.chain_index(chain), contig="CHR", pos="at", width=liftover.CHAIN_BIN, max_broadcast_rows=n)
    few, many = join(40), join(39)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(str, many.collect()))
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert rows == sorted(map(str, few.collect())) and len(rows) == 4
