"""Plan shape: no cross joins, pruned scans, checked broadcasts, clean text."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from siteloom.operators.intervals import range_join
from siteloom.session import checkpoint_root, fits_broadcast, scratch_path

ROOT = Path(__file__).resolve().parents[1]
NESTED = ["range_join_features", "nearest_genes_salted", "ld_r2", "annotate_full", "site_lookup", "ss_qc"]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NESTED)
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    plan = physical(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = physical(contract.queries()["call_stats"](spark, sf_dir))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("l_orderkey" in s for s in schema)
    assert not any("l_extendedprice" in s or "p_name" in s for s in schema)


def test_row_local_statistics_add_no_shuffle(spark, sf_dir):
    from siteloom.plans import fixtures, pipelines

    rows = fixtures.pvcf(spark, sf_dir)
    count = lambda df: physical(df).count("Exchange hashpartitioning")
    assert count(pipelines.lookup_table(rows)) == count(rows)
    assert count(pipelines.matrix_qc(rows)) == count(rows)


def test_a_variant_line_is_split_once_however_many_samples(spark):
    """Inlined into the lambda over genotypes, the split of the line would run again for each of them."""
    from siteloom.operators import genotypes, multiallelic
    from siteloom.sources import vcf

    lines = spark.createDataFrame([("1\t10\t.\tA\tC,G\t.\tPASS\tAC=1\tGT:PL\t0/1:9,0,9,9,9,9\t1/2:9,9,9,9,0,9",)], "value string")
    rows = vcf.parse_pvcf(lines, ["p", "q"], {"PL": ("G", "Integer")})
    plan = physical(rows.select("contigName", "start", F.inline("genotypes")))
    assert len(re.findall(r"split\(value#\d+", plan)) == 1 and plan.count("array_position(") == 5
    split = multiallelic.split_multiallelics(genotypes.process_genotypes(rows, extra_fields=["PL"]), "downcode")
    cells = split.select("a_index", F.inline("genotypes"))
    assert physical(cells).count("flatten(") == 1
    assert sorted((r.a_index, r.sampleId, r.PL) for r in cells.collect()) == [
        (1, "p", [9, 0, 9]), (1, "q", [9, 0, 9]), (2, "p", [0, 9, 9]), (2, "q", [9, 0, 9])
    ]


def test_nearest_partial_limit_before_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in physical(contract.queries()["nearest_genes_salted"](spark, sf_dir))


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(10)
    assert fits_broadcast(df, 10) and not fits_broadcast(df, 9)
    points = spark.range(5).selectExpr("'1' AS c", "id AS p")
    spans = spark.range(5).selectExpr("'1' AS c", "id AS s", "id AS e")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        join = lambda n: physical(
            range_join(points, spans, contig="c", pos="p", start="s", end="e", max_broadcast_rows=n)
        )
        assert "BroadcastHashJoin" in join(5) and "_salt" not in join(5)
        assert "BroadcastHashJoin" not in join(4) and "_salt" in join(4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class Session:
    """Stands in for a session whose static settings are given."""

    def __init__(self, conf, already=None):
        self.conf, self.sparkContext, self.set_to = conf, self, already

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, path):
        self.set_to = path


@pytest.mark.parametrize(
    "conf,already,want",
    [
        ({"spark.checkpoint.dir": "hdfs://x/shared/"}, None, "hdfs://x/shared/"),
        ({"spark.checkpoint.dir": "hdfs://x/shared/"}, "hdfs://x/shared/run", "hdfs://x/shared/"),
        ({}, "hdfs://x/other", "hdfs://x/other"),
    ],
)
def test_checkpoint_folder_of_the_session_is_used(conf, already, want):
    session = Session(conf, already)
    assert checkpoint_root(session) == want
    assert session.set_to == (already or want)
    assert scratch_path(session, "t").startswith(want.rstrip("/") + "/t-")


def test_no_local_checkpoint_or_python_udf():
    for path in (ROOT / "siteloom").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and "udf(" not in text, path


def _above_scan(plan, mark):
    """The operators between the scan that reads ``mark`` and the next join, from the printed tree."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and mark in line)
    above, depth = [], len(lines[at]) - len(lines[at].lstrip(" :+-"))
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            if "Join" in line:
                return above
            above.append(line.strip(" :+-"))
    return above


def test_stored_tables_are_joined_in_place(spark, sf_dir):
    from siteloom.plans import queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as large tables are
    for name, mark in (("annotate_stored", "missensePredictions"), ("annot_joinback_stored", "genotypes")):
        made = contract.queries()[name](spark, sf_dir)
        above = _above_scan(physical(made), mark)
        assert above and not any("Exchange" in line for line in above), above
        plain = name.removesuffix("_stored").replace("annotate", "annotate_full")
        assert sorted(map(str, made.collect())) == sorted(map(str, queries.registry()[plain](spark, sf_dir).collect()))


def test_bucketed_tables_open_in_another_catalog(spark):
    from siteloom.sources import bucketed

    rows = spark.createDataFrame([(i % 7 if i % 5 else None, str(i)) for i in range(100)], "k bigint, v string")
    path = scratch_path(spark, "bucketed")
    bucketed.write_bucketed(rows, "own_rows", path, ["k"], 4)
    spark.sql("DROP TABLE own_rows")
    back = bucketed.open_bucketed(spark, "own_rows", path, ["k"], 4)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert "Exchange" not in physical(back.groupBy("k").count())
    spark.sql("DROP TABLE own_rows")


def test_funnel_comes_with_the_write(spark, sf_dir):
    from siteloom.plans import fixtures, pipelines

    def jobs(label, work):
        spark.sparkContext.setJobGroup(label, label)
        made = work()
        spark.sparkContext.setJobGroup("rest", "rest")
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(label))

    rows = fixtures.pvcf(spark, sf_dir)
    plain, once = jobs("plain", lambda: pipelines.matrix_qc(rows).write.parquet(scratch_path(spark, "plain")))
    kept, counted = pipelines.matrix_qc_observed(rows)
    _, own = jobs("observed", lambda: kept.write.parquet(scratch_path(spark, "observed")))
    funnel, extra = jobs("funnel", lambda: [r.n_rows for r in counted().collect()])
    assert own == once and funnel[-1] == pipelines.matrix_qc(rows).count() and funnel == sorted(funnel, reverse=True)


def test_genotypes_are_packed_once(spark, sf_dir):
    plan = physical(contract.queries()["ld_r2"](spark, sf_dir))
    assert "lineitem" not in plan and "aggregate(genotypes" not in plan and "ld-packed" in plan
