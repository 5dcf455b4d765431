"""Near-duplicates, embedding links and components against brute force."""

import numpy as np
import pytest

from siteloom.llm import components, neardup, vectors


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 50), (7, 7)], [(9, 3), (3, 12), (12, 1), (20, 21)], []])
def test_components(spark, edges):
    table = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in components.components(table).collect()}
    nodes = {n for u, v in edges if u != v for n in (u, v)}
    assert got == roots(nodes, [e for e in edges if e[0] != e[1]])


def test_darts_estimate_weighted_similarity():
    r = np.random.default_rng(0)
    keys = np.unique(r.integers(0, 2**63, 3000).astype(np.uint64))[:2000]
    a, b = r.integers(1, 4, 2000), r.integers(0, 4, 2000)
    agree = []
    for salt in range(12):
        moved = keys + np.uint64(salt)
        mine = neardup.darts(moved, a.astype(float), 128)
        theirs = neardup.darts(moved[b > 0], b[b > 0].astype(float), 128)
        agree.append((mine == theirs).mean())
    assert abs(np.mean(agree) - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04
    half = [(neardup.darts(keys[:50] + np.uint64(s), np.full(50, 0.5), 64) == neardup.darts(keys[:50] + np.uint64(s), np.ones(50), 64)).mean() for s in range(12)]
    assert abs(np.mean(half) - 0.5) < 0.06


def edited(text, seed, share):
    r = np.random.default_rng(seed)
    parts = text.split()
    for at in r.choice(len(parts), max(1, int(share * len(parts))), replace=False):
        parts[at] = f"new{seed}x{at}"
    return " ".join(parts)


def brute_classes(rows):
    """Every pair of texts, compared exactly."""
    sets = [neardup.shingles(t or "") for _, t in rows]
    edges = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (rows[i][1] or "") == (rows[j][1] or "") or neardup.similarity(sets[i], sets[j]) >= neardup.SIMILARITY
    ]
    part = roots(range(len(rows)), edges)
    least = {}
    for i, p in part.items():
        keys = [rows[k][0] for k in part if part[k] == p and rows[k][0] is not None]
        least[i] = min(keys) if keys else None
    return sorted((str(rows[i][0]), str(least[i])) for i in part)


@pytest.fixture(scope="module")
def copies(words):
    base = [words(s, 150) for s in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + s, edited(base[0], s, 0.01)) for s in range(40)]  # a large group of near copies
    rows += [(200 + s, edited(base[1], s, 0.035)) for s in range(25)]  # close to the threshold
    rows += [(300 + s, base[2]) for s in range(20)]
    rows += [(400 + s, base[3][: 300 + 20 * s]) for s in range(25)]  # a chain: each is near the next one
    rows += [(500, None), (501, ""), (502, " "), (503, "one two"), (504, "One, two!"), (505, "one"), (500, None), (None, base[4]), (None, "lonely words"), (506, "... ---"), (507, words(77, 30000))]
    return rows


def test_near_duplicates_equal_brute_force(documents, copies):
    out = neardup.near_duplicates(documents(copies)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in out) == brute_classes(copies)
    assert all(r.kept == (r.doc_id == r.class_id) for r in out)


def test_mixed_buckets_are_compared_to_the_end(documents, words, monkeypatch):
    """One row a band makes crowded buckets of unlike texts; every pair in them still counts."""
    shared = words(1, 60)
    rows = [(i, shared + " " + words(50 + i // 2, 60) + ("" if i % 2 else " end")) for i in range(40)]
    out = neardup.near_duplicates(documents(rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in out) == brute_classes(rows)


def test_keep_first(documents, copies):
    docs = documents(copies)
    kept = neardup.keep_first(docs)
    assert kept.schema.names == docs.schema.names
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(500) == 1 and 100 not in ids and 300 not in ids
    want = {c for _, c in brute_classes(copies) if c != "None"}
    assert {str(i) for i in ids if i is not None} == want
    assert neardup.near_duplicates(documents([])).count() == 0
    assert neardup.near_duplicates(documents([(1, None), (2, "a b c")])).where("kept").count() == 2


def test_keep_first_decides_by_row(documents, words):
    """Repeated and null keys: every class keeps one row, and no unlike text is lost."""
    a, b, c, d, e = (words(s, 80) for s in range(60, 65))
    rows = [(7, a), (3, b), (7, b), (8, c), (8, d), (8, d), (None, e), (None, edited(e, 1, 0.01)), (None, e), (None, "alone"), (9, "ninth"), (None, "ninth")]
    for some in (rows, rows[:3], rows[3:5], rows[6:], rows[:1] + rows[6:]):
        kept = [(r.doc_id, r.text) for r in neardup.keep_first(documents(some)).collect()]
        held = [t for t in (a, b, c, d, "alone", "ninth") if t in [x for _, x in some]]
        assert sorted(t for _, t in kept if t in held) == sorted(held)
        assert len(kept) == len(held) + (e in [x for _, x in some])
        assert (7, b) not in kept and (None, "ninth") not in kept


def brute_links(rows, cosine=0.95):
    good = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=float)
    edges = [
        (i, j) for i in good for j in good
        if j < i and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= cosine
    ]
    part = roots(range(len(rows)), edges)
    degree = [sum(i in e for e in edges) for i in range(len(rows))]
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[k][0] for k in part if part[k] == part[i] and rows[k][0] is not None]
        out.append((str(key), degree[i], str(min(keys) if keys else None)))
    return sorted(out)


@pytest.mark.parametrize("cell, block", [(4096, 4096), (20, 7)])
def test_cosine_links_equal_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    r = np.random.default_rng(1)
    centers = r.standard_normal((12, 40))
    rows = [(i, (centers[i % 12] + r.standard_normal(40) * (0.02 if i % 3 else 0.25)).tolist()) for i in range(150)]
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [(600 + i, [3.0 * x for x in rows[4][1]]) for i in range(3)]
    rows += [(700, None), (701, []), (702, [0.0] * 40), (703, [1.0, None] + [0.0] * 38), (704, [float("nan")] * 40), (705, [float("inf")] + [0.0] * 39)]
    rows += [(800, [1.0, 0.0]), (801, [1.0, 0.1]), (802, [0.0, 1.0]), (3, rows[3][1]), (None, rows[5][1])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    exact = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    out = vectors.cosine_links(table).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in out) == brute_links(exact)
    assert all(x.kept == (x.vec_id == x.component_id) for x in out)


def test_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert vectors.cosine_links(spark.createDataFrame([], schema)).count() == 0
    assert vectors.cosine_links(spark.createDataFrame([(1, None, 2)], schema)).first().n_links == 0


def test_dense_block_in_bounded_memory():
    """A block of near but unequal vectors: counts and parts as by brute force, whatever the strips; little memory."""
    import tracemalloc

    import pandas as pd

    r = np.random.default_rng(3)
    base = r.standard_normal((3, 64))
    rows = np.concatenate([base[i] + 0.02 * r.standard_normal((n, 64)) for i, n in enumerate((1500, 700, 1))] + [r.standard_normal((20, 64))])
    rows = rows[r.permutation(len(rows))]
    n = len(rows)
    unit = vectors._unit(rows)
    near = unit @ unit.T >= vectors.COSINE
    both = pd.DataFrame({"resident": [True] * n + [False] * n, "node": [*range(n)] * 2, "copies": 1, "vector": [*rows] * 2})
    tracemalloc.start()
    out = vectors._meet(both, vectors.COSINE)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counts = out[out.other < 0].set_index("node").links.to_dict()
    assert counts == dict(enumerate(near.sum(axis=1)))
    forest = [(int(a), int(b)) for a, b in out[out.other >= 0][["node", "other"]].to_numpy()]
    assert len(forest) < n
    assert roots(range(n), forest) == roots(range(n), list(zip(*np.nonzero(near))))
    assert peak < 250e6


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("size, cosine", [(64, 0.95), (50, 0.3), (5, 0.9), (3, -0.4), (1, 0.95)])
def test_cosine_links_in_many_rounds(spark, monkeypatch, kind, size, cosine):
    """Few residents a round and a visit, crowded cells and copies: the same links as by brute force."""
    monkeypatch.setattr(vectors, "CELL", 6)
    monkeypatch.setattr(vectors, "BLOCK", 4)
    monkeypatch.setattr(vectors, "STRIP", 9)
    monkeypatch.setattr(vectors, "PAIR_VALUES", 200)
    monkeypatch.setattr(vectors, "RESIDENT_BYTES", 60 * (size * 8 + 160))
    monkeypatch.setattr(vectors, "VISITOR_BYTES", 25 * (size * 20 + 300))
    r = np.random.default_rng(size)
    centers = 3 * r.standard_normal((4, size))
    rows = [(i, (centers[i % 4] + r.standard_normal(size) * (0.03 if i % 3 else 3)).tolist()) for i in range(220)]
    rows += [(300 + i, rows[1][1]) for i in range(40)] + [(400 + i, (-np.array(rows[i][1])).tolist()) for i in range(5)]
    rows += [(500, None), (501, [0.0] * size), (502, [-0.0] * (size - 1) + [2.0]), (503, [0.0] * (size - 1) + [2.0]), (None, rows[2][1])]
    table = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    exact = rows if kind == "double" else [(k, v and [float(np.float32(x)) for x in v]) for k, v in rows]
    out = vectors.cosine_links(table, cosine=cosine).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in out) == brute_links(exact, cosine)


def test_cosine_links_disk_follows_the_rows(spark, monkeypatch, tmp_path):
    """Vectors without clusters, whatever the number of cells: none is copied into the cells that it may have partners in."""
    import pathlib
    import threading

    monkeypatch.setattr(vectors, "CELL", 32)
    vecs = np.random.default_rng(8).standard_normal((3000, 64)).astype(np.float32)
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "in"))
    places = [str(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    before, sizes, over = {x for d in places for x in pathlib.Path(d).rglob("shuffle_*.data")}, {}, threading.Event()

    def watch():
        while not over.wait(0.1):
            for x in (x for d in places for x in pathlib.Path(d).rglob("shuffle_*.data") if x not in before):
                try:
                    sizes[x] = x.stat().st_size
                except OSError:  # a file may go meanwhile
                    pass

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        out = vectors.cosine_links(spark.read.parquet(str(tmp_path / "in")))
        assert out.where("n_links = 0 and kept").count() == 3000
    finally:
        over.set()
        watcher.join()
    assert 0 < sum(sizes.values()) < 6 * vecs.nbytes


def test_cosine_links_numbers_that_meet(spark, monkeypatch):
    """Two digests with one number: other numbers are taken."""
    given, salts = vectors._node, []
    monkeypatch.setattr(vectors, "_node", lambda salt: salts.append(salt) or (given(salt) if salt else given(salt) % 3))
    rows = [(i, [float(i % 7), 1.0, float(i % 2)]) for i in range(40)]
    out = vectors.cosine_links(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in out) == brute_links(rows)
    assert salts[:2] == [0, 1]


def test_cells_reach_every_partner():
    """The angle rule drops no linked pair, and each pair comes once; a cell's nearest vector may lie on its direction."""
    r = np.random.default_rng(12)
    rows = r.standard_normal((40, 64))[r.integers(0, 40, 900)] + 0.18 * r.standard_normal((900, 64))
    rows[:40] = np.repeat(vectors._unit(rows[:40])[::4], 4, axis=0) * np.arange(1, 41)[:, None]
    unit = vectors._unit(rows)
    directions = vectors._directions(unit[:12])
    evens, odds = (unit[:, k::2] @ x.T / vectors.GRAIN for k, x in enumerate(directions))
    cell, near = evens.argmax(axis=1) * 12 + odds.argmax(axis=1), (evens.max(axis=1) + odds.max(axis=1)) / 2**0.5
    order = np.lexsort((-near, cell))
    node, copies = np.arange(900), np.ones(900, dtype=np.int64)
    own = vectors._Residents(order, copies, cell[order], near[order], rows[order], 0.95, 12)
    tables = lambda u, *ats: (*((x[at] @ u[:, k::2].T / vectors.GRAIN).astype("f4") for k, (x, at) in enumerate(zip(directions, ats, strict=True))), 2**0.5)
    links, one = own.visited(node, copies, near, rows, tables)
    links[order] += own.links
    near_ones = unit @ unit.T >= 0.95
    assert (links == near_ones.sum(axis=1) - 1).all()
    forest = [(int(a), int(order[b])) for a, b in zip(node, one, strict=True) if b >= 0] + [tuple(map(int, x)) for x in own.forest()]
    assert roots(range(900), forest) == roots(range(900), list(zip(*np.nonzero(near_ones), strict=True)))
