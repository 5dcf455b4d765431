"""Bin joins against plain range joins, with crowded bins, and the two nearest-feature paths."""

import random

import pytest
from pyspark.sql import functions as F

from siteloom.operators import nearest
from siteloom.operators.intervals import pairs_within, range_join


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of the variants and of the features share one place."""
    rng = random.Random(7)
    spots = [50_000 + i if i % 3 == 0 else rng.randrange(0, 5_000_000) for i in range(600)]
    variants = [(f"v{i}", str(1 + i % 2), "A", "C", p) for i, p in enumerate(spots)]
    starts = [60_000 + i if i % 3 == 0 else rng.randrange(0, 5_000_000) for i in range(240)]
    features = [
        (str(1 + i % 2), s, s + rng.randrange(0, 900_000), f"E{i}", f"G{i}", rng.choice(["protein_coding", "lncRNA"]))
        for i, s in enumerate(starts)
    ]
    return (
        spark.createDataFrame(variants, "uid string, CHR string, REF string, ALT string, POS bigint"),
        spark.createDataFrame(
            features, "CHR string, featureStart bigint, featureEnd bigint, geneId string, GeneName string, biotype string"
        ),
    )


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("limit", [0, 1000])
def test_bin_join_equals_plain_range_join(spark, crowded, limit):
    variants, features = crowded
    binned = range_join(
        variants, features, contig="CHR", pos="POS", start="featureStart", end="featureEnd", pad=500_000,
        max_broadcast_rows=limit,
    )
    plain = variants.join(features, "CHR").where(
        F.col("POS").between(F.col("featureStart") - 500_000, F.col("featureEnd") + 500_000)
    )
    columns = ["uid", "geneId"]
    assert rows(binned.select(*columns)) == rows(plain.select(*columns))


@pytest.mark.parametrize("limit", [0, 1000])
def test_left_join_keeps_points_without_interval(spark, limit):
    points = spark.createDataFrame([("1", 5), ("1", 50), ("2", 5)], "c string, p bigint")
    spans = spark.createDataFrame([("1", 0, 10, "x")], "c string, s bigint, e bigint, name string")
    out = range_join(
        points, spans, contig="c", pos="p", start="s", end="e", width=7, how="left", max_broadcast_rows=limit
    )
    assert rows(out.select("c", "p", F.coalesce("name", F.lit("-")))) == [("1", 5, "x"), ("1", 50, "-"), ("2", 5, "-")]


def test_both_nearest_paths_equal_brute_force(spark, crowded):
    variants, features = crowded
    want = {}
    for v in variants.collect():
        lists = {True: [], False: []}
        for f in {tuple(f) for f in features.collect() if f.CHR == v.CHR}:
            _, s, e, gene, name, kind = f
            d = 0 if s <= v.POS <= e else (e - v.POS if v.POS > e else s - v.POS)
            if abs(d) <= 500_000:
                lists[kind == "protein_coding"].append((abs(d), name, gene, kind, d))
        if lists[True] or lists[False]:
            want[v.uid] = (sorted(lists[True])[:4], sorted(lists[False])[:4])
    for options in ({}, {"max_scan_features": 0}, {"max_broadcast_rows": 0}):
        out = nearest.nearest_genes(variants, features, **options).collect()
        got = {r.uid: ([tuple(x) for x in r[nearest.CODING]], [tuple(x) for x in r[nearest.OTHER]]) for r in out}
        assert got == want


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_ties_and_nested_features(spark, k):
    """Small positions, so that ends, starts and names tie everywhere and features hold one another."""
    rng = random.Random(k)
    variants = spark.createDataFrame([(f"v{i}", "1", "A", "C", i) for i in range(1, 90)], "uid string, CHR string, REF string, ALT string, POS bigint")
    spans = [(s, s + rng.choice([0, 1, 5, 40]), f"E{i}", f"G{i % 5}", rng.choice(["protein_coding", None])) for i, s in enumerate(rng.choices(range(1, 80), k=60))]
    features = spark.createDataFrame(
        [("1", *f) for f in spans], "CHR string, featureStart bigint, featureEnd bigint, geneId string, GeneName string, biotype string"
    )
    paths = ({}, {"max_scan_features": 0}, {"max_broadcast_rows": 0})
    scan, index, join = ({r.uid: r for r in nearest.nearest_genes(variants, features, reach=20, k=k, **options).collect()} for options in paths)
    assert scan == index == join and len(scan) > 80


def test_crowded_features_turned_around_take_the_join(spark, crowded):
    variants, features = crowded
    turned = features.unionByName(
        features.limit(1).selectExpr("CHR", "featureEnd AS featureStart", "featureStart AS featureEnd", "'t' AS geneId", "GeneName", "biotype")
    )
    assert not nearest._crowding(features, 500_000, 10**6)[2] and nearest._crowding(turned, 500_000, 10**6)[2]
    assert rows(nearest.nearest_genes(variants, turned, max_scan_features=0)) == rows(nearest.nearest_genes(variants, turned))


def test_nearest_merges_copies_and_keeps_extra_columns(spark, crowded):
    variants, features = crowded
    doubled = variants.unionByName(variants).withColumn("note", F.lit("n"))
    out = nearest.nearest_genes(doubled, features.unionByName(features), ["note"])
    assert out.count() == nearest.nearest_genes(variants, features).count()
    assert out.where("note = 'n'").count() == out.count()


def test_keep_empty(spark, crowded):
    variants, features = crowded
    alone = spark.createDataFrame([("far", "9", "A", "C", 1)], variants.schema)
    assert nearest.nearest_genes(alone, features).count() == 0
    row = nearest.nearest_genes(alone, features, keep_empty=True).first()
    assert row[nearest.CODING] == [] and row[nearest.OTHER] == []


def test_pairs_within_equals_brute_force(spark):
    rng = random.Random(3)
    spots = [(i, rng.choice("ab"), rng.choice([0, 10, 19, 20, 21, 40, rng.randrange(100)])) for i in range(80)]
    df = spark.createDataFrame(spots, "k int, c string, p bigint")
    got = rows(pairs_within(df, contig="c", pos="p", key="k", window=20).select("a_k", "b_k"))
    want = sorted(
        (a, b)
        for a, ca, pa in spots
        for b, cb, pb in spots
        if ca == cb and (pa, a) < (pb, b) and pb - pa <= 20
    )
    assert got == want
