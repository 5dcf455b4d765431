"""LD sums and pruning against numpy and a sequential pass."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteloom.operators import ld

WINDOW = 50


@pytest.fixture(scope="module")
def cohort():
    """150 samples, 60 sites in families of near copies, with missing and constant genotypes."""
    rng = random.Random(2)
    sites, family = [], None
    for i in range(60):
        if i % 6 == 0:
            family = [rng.choice([0, 0, 1, 2]) for _ in range(150)]
        dosage = [d if rng.random() < 0.85 else rng.choice([0, 1, 2]) for d in family]
        dosage = [None if rng.random() < 0.05 else d for d in dosage]
        if i == 31:
            dosage = [2] * 150
        sites.append((i, "chr1" if i < 40 else "chr2", i * 7 if i % 5 else (i - 1) * 7 if i else 0, dosage))
    return sites


@pytest.fixture(scope="module")
def pvcf(spark, cohort):
    to_calls = {None: [-1, -1], 0: [0, 0], 1: [1, 0], 2: [1, 1]}
    rows = [(i, c, s, ["C"], [(to_calls[d], f"s{j}") for j, d in enumerate(g)]) for i, c, s, g in cohort]
    schema = (
        "sid int, contigName string, start bigint, alternateAlleles array<string>,"
        " genotypes array<struct<calls:array<int>,sampleId:string>>"
    )
    return spark.createDataFrame(rows, schema).repartition(4)


def brute(cohort):
    out = {}
    for i, ci, si, gi in cohort:
        for j, cj, sj, gj in cohort:
            if ci != cj or (si, i) >= (sj, j) or sj - si > WINDOW:
                continue
            x, y = (np.array([np.nan if d is None else d for d in g], float) for g in (gi, gj))
            x, y = (np.where(np.isnan(v), np.nanmean(v), v) for v in (x, y))
            if x.std() and y.std():
                out[i, j] = np.corrcoef(x, y)[0, 1] ** 2
    return out


def test_r2_is_that_of_mean_imputed_dosages(pvcf, cohort):
    got = {(r.a_sid, r.b_sid): r.r2 for r in ld.ld_r2(pvcf, "sid", WINDOW).collect()}
    want = brute(cohort)
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


@pytest.mark.parametrize("max_r2", [0.2, 0.6])
def test_pruning_equals_one_pass_in_rank_order(pvcf, cohort, max_r2):
    pairs = brute(cohort)
    linked = {k for k, v in pairs.items() if v >= max_r2}
    linked |= {(b, a) for a, b in linked}

    def rank(site):
        known = [d for d in site[3] if d is not None]
        f = sum(known) / len(known) / 2
        return (-min(f, 1 - f), site[0])

    kept = []
    for site in sorted(cohort, key=rank):
        if not any((site[0], other) in linked for other in kept):
            kept.append(site[0])
    got = [r.sid for r in ld.ld_prune(pvcf, "sid", max_r2, WINDOW, tie_by_key=True).select("sid").collect()]
    assert sorted(got) == sorted(kept) and len(got) < len(cohort)


def test_default_ties_leave_a_maximal_set_without_linked_pairs(pvcf, cohort):
    linked = {k for k, v in brute(cohort).items() if v >= 0.6}
    kept = {r.sid for r in ld.ld_prune(pvcf, "sid", window=WINDOW).select("sid").collect()}
    assert not any(a in kept and b in kept for a, b in linked)
    for i, *_ in cohort:
        assert i in kept or any(i in pair and (kept & set(pair)) for pair in linked)


def test_frequency_bound_skips_pairs_and_loses_none(spark):
    """Sites of many frequencies, some without a kind of genotype, some mostly uncalled: no linked pair is lost."""
    from siteloom.operators.intervals import pairs_within

    rng, to_calls, rows, sites = random.Random(9), {None: [-1, -1], 0: [0, 0], 1: [1, 0], 2: [1, 1]}, [], []
    base = [rng.random() for _ in range(90)]
    for i in range(80):
        p = rng.choice([0.01, 0.03, 0.1, 0.3, 0.5, 0.8, 0.97])
        own = base if i % 3 else [rng.random() for _ in range(90)]
        kinds = ((0, 2), (0, 1), (1, 2), (0, 1))[i % 4]
        g = [kinds[u < p] if i % 4 < 3 else (u < p) + (u < p * p) for u in own]
        g = [None if rng.random() < (0.6 if i % 7 == 0 else 0.02) else x for x in g]
        sites.append((i, "chr1", i, g))
        rows.append((i, "chr1", i, ["C"], [(to_calls[x], f"s{j}") for j, x in enumerate(g)]))
    schema = "sid int, contigName string, start bigint, alternateAlleles array<string>, genotypes array<struct<calls:array<int>,sampleId:string>>"
    df = spark.createDataFrame(rows, schema)
    every = {(r.a_sid, r.b_sid): r.r2 for r in ld.ld_r2(df, "sid", WINDOW).collect()}
    spread = ld._spreads(ld.pack_words(df, "sid").where("d > 0"))
    for least in (0.05, 0.2, 0.6, 0.9):
        found = {(r.a_sid, r.b_sid) for r in ld.ld_r2(df, "sid", WINDOW, min_r2=least).collect()}
        assert found == {k for k, v in every.items() if v >= least}
    met = pairs_within(spread, contig="contigName", pos="start", key="sid", window=WINDOW, keep=ld.linkable(0.6)).count()
    assert 0 < met < 0.7 * len(every)


def test_multiallelic_rows_are_refused(pvcf):
    multi = pvcf.withColumn("alternateAlleles", F.array(F.lit("C"), F.lit("G")))
    with pytest.raises(Exception, match="LD needs split rows"):
        ld.ld_prune(multi, "sid", window=WINDOW).count()


def test_genotypes_are_neither_exploded_nor_shuffled_by_word(pvcf):
    plan = ld.ld_r2(pvcf, "sid", WINDOW)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "word#" not in plan


def test_words_follow_the_genotypes_of_a_site_not_the_sample_numbers(spark):
    """Two sites hold different samples with numbers far apart; the pair is that of the samples they share."""
    number = lambda g: g["sampleId"].cast("bigint")
    left, right = {3: 0, 70: 1, 9_000: 2, 5_000_000: 1, 64: 2}, {70: 2, 9_000: 1, 5_000_001: 0, 5_000_000: 0, 64: 1, 12: 1}
    calls = {0: [0, 0], 1: [0, 1], 2: [1, 1]}
    rows = [(i, "1", i, ["C"], [(calls[x], str(n)) for n, x in g.items()]) for i, g in enumerate([left, right])]
    df = spark.createDataFrame(rows, "sid int, contigName string, start bigint, alternateAlleles array<string>, genotypes array<struct<calls:array<int>,sampleId:string>>")
    packed = ld.pack_words(df, "sid", number).select("sid", F.col("words.w").alias("w")).collect()
    assert {r.sid: r.w for r in packed} == {0: [0, 1, 140, 78125], 1: [0, 1, 140, 78125]}
    alone = ld.pack_words(df, "sid", number).agg(F.max(F.size("words"))).first()[0]
    assert alone == 4
    for cut, shared in ((0, [70, 9_000, 5_000_000, 64]), (1_000, [9_000, 5_000_000])):
        kept = df.withColumn("genotypes", F.filter("genotypes", lambda g: (number(g) > cut) | (F.col("sid") == 0)))
        own = {n: x for n, x in right.items() if n > cut}
        x = np.array([left.get(n, np.mean(list(left.values()))) for n in sorted({*left, *own})])
        y = np.array([own.get(n, np.mean(list(own.values()))) for n in sorted({*left, *own})])
        covariance = sum((left[n] - np.mean(list(left.values()))) * (own[n] - np.mean(list(own.values()))) for n in shared)
        expected = covariance**2 / (x.var() * len(x) * y.var() * len(y))
        row = ld.ld_r2(kept, "sid", WINDOW, number).collect()
        assert [(r.a_sid, r.b_sid, r.n_both) for r in row] == [(0, 1, len(shared))]
        assert abs(row[0].r2 - expected) < 1e-12


def test_crowded_bin_is_salted(spark):
    """5,000 sites in one bin: every pair once, whatever the salts."""
    from siteloom.operators.intervals import pairs_within

    sites = spark.range(5000).selectExpr("'chr1' AS contig", "id AS k", "id DIV 50 AS pos")
    pairs = pairs_within(sites, contig="contig", pos="pos", key="k", window=3, crowd=16)
    assert pairs.count() == pairs.distinct().count() == 100 * 50 * 49 // 2 + sum((100 - g) * 2500 for g in (1, 2, 3))


def test_pruned_probabilities(spark, sf_dir):
    from siteloom.plans import fixtures, pipelines
    from siteloom.sources import matrix

    rows = pipelines.pruned_probabilities(fixtures.pvcf(spark, sf_dir), lambda g: g["sampleId"].cast("bigint"))
    assert 0 < rows.count() <= pipelines.matrix_qc(fixtures.pvcf(spark, sf_dir)).count()
    assert rows.select("uid").distinct().count() == rows.count()
    long = matrix.probability_rows(rows.drop("gp", "dosages", "mean_dosage"), "uid")
    assert long.where(F.size("gp") != 3).count() == 0
