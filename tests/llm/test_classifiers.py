"""Quality and toxicity: held-out accuracy, and defined results on odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteloom.llm import queries, quality, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def judged(spark):
    """Rows of the two queries on labelled, held-out documents of the larger table."""
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = {}
    for name, label in (("op3_ftrl_quality", "quality"), ("op9_boosted_toxicity", "toxic")):
        made = queries.QUERIES[name](spark, sf_dir)
        out[label] = made.join(labels, "doc_id").where("held_out").select("score", "predicted", label).toPandas()
        assert made.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    return out


def area(score, label):
    good, bad = score[label == 1], score[label == 0]
    return (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()


def test_quality_held_out(judged):
    rows = judged["quality"]
    assert area(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.95
    assert (rows.predicted == rows.quality).mean() > 0.9


def test_toxicity_held_out(judged):
    rows = judged["toxic"]
    assert area(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.75
    assert rows[rows.toxic == 0].predicted.mean() < 0.03


def test_no_labels_and_odd_rows(spark, documents, words):
    rows = [(1, None), (2, ""), (3, words(1, 40000)), (3, words(1, 40000)), (None, "!!! ###"), (5, "\x00 ퟿")]
    docs = documents(rows)
    none = spark.createDataFrame([], LABELS)
    model = quality.train(docs, none)
    assert [r.score for r in quality.score(docs, model).collect()] == [0.5] * len(rows)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.keep_good(docs, model).count() == len(rows)
    toxic = toxicity.train(docs, none)
    assert [r.score for r in toxicity.score(docs, toxic).collect()] == [0.0] * len(rows)
    assert toxicity.keep_clean(docs, toxic).columns == docs.columns
    one_class = spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 0, 1), (77, 0, 1)], LABELS)
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, one_class)).collect()} == {0.0}
    assert quality.score(docs, quality.train(docs, one_class)).where(F.col("score") > 0.5).count() > 0
    empty = documents([])
    assert quality.score(empty, quality.train(empty, one_class)).count() == 0
    assert toxicity.score(empty, toxicity.train(empty, one_class)).count() == 0


def test_stages_keep_all_columns(spark, documents, words):
    bad = ["### " + w + "!!" for w in words(3, 60).split()]
    rows = [(i, words(i, 80)) for i in range(80)] + [(100 + i, " ".join(bad[i:] + bad[:i])) for i in range(40)]
    rows += [(200 + i, words(i, 40) + " you idiot scum " + words(i + 1, 30)) for i in range(40)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, int(not 100 <= i < 140), int(i >= 200)) for i, _ in rows], LABELS)
    kept = quality.keep_good(docs, quality.train(docs, labels))
    assert kept.schema.names == docs.schema.names
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, _ in rows if not 100 <= i < 140}
    clean = toxicity.keep_clean(docs, toxicity.train(docs, labels))
    assert clean.schema.names == docs.schema.names
    left = {r.doc_id for r in clean.select("doc_id").collect()}
    assert not [i for i in left if i >= 200] and {i for i, _ in rows if i < 200} <= left


def test_word_order_counts():
    """The same ordinary words in another order have other features, beside the single ones."""
    first, second = (set(quality.slots(t)) for t in ("one sunny day they went home", "they one home went sunny day"))
    assert len(first & second) >= 6 and len(first - second) >= 6


def test_repeated_keys_do_not_exceed_the_sample(spark, documents):
    docs = documents([(1, f"text {i % 7}") for i in range(500)] + [(2, None), (2, None)])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0)], LABELS)
    rows, _ = quality.sample(docs, labels, key="doc_id", label="quality", bound=100)
    picked = {r.doc_id: (r.text, r._label) for r in rows.collect()}
    assert len(picked) == rows.count() == 2 and picked[1][1] == 1 and picked[1][0].startswith("text") and picked[2] == (None, 0)


def test_a_plain_follow_the_leader_gives_the_same_weights():
    """One coordinate at a time, as the published algorithm is written."""
    rng = np.random.default_rng(2)
    rows = [(np.append(np.unique(rng.integers(0, 50, 6)), quality.DIMENSIONS), None, int(rng.integers(0, 2))) for _ in range(60)]
    rows = [(at, rng.random(len(at)), y) for at, _, y in rows]
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.1
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for epoch in range(quality.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, values, y = rows[k]
            own = {i: weight(i) for i in at}
            p = 1 / (1 + np.exp(-sum(own[i] * x for i, x in zip(at, values))))
            for i, x in zip(at, values):
                g = (p - y) * x
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * own[i]
                n[i] = n.get(i, 0.0) + g * g
    found = quality.leader(rows)
    assert np.allclose([found[i] for i in z], [weight(i) for i in z], atol=1e-9)


def test_leader_separates():
    rows = [(np.array([k % 2, quality.DIMENSIONS]), np.array([1.0, 1.0]), k % 2) for k in range(200)]
    w = quality.leader(rows)
    assert w[1] > 0.5 > -0.5 > w[0]


def test_obfuscated_and_second_person():
    assert toxicity.plain("1d10t!") == ("idiot", True)
    assert toxicity.plain("don't,") == ("dont", False)
    chunks = toxicity.Chunks(toxicity.Lexicon({}).describe, 8)
    near = dict(zip(toxicity.COLUMNS, toxicity.features("are you an id1ot or what", chunks)))
    far = dict(zip(toxicity.COLUMNS, toxicity.features("you " + "word " * 9 + "idiot", chunks)))
    assert near["near_second_person"] > 0 == far["near_second_person"] and near["obfuscated_hits"] > 0
