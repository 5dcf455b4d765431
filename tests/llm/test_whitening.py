"""The qd solver and the whitening of whole tables against numpy and exact integers."""

import duckdb
import numpy as np
import pytest

from siteloom.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, component string, label int"


def same_up_to_sign(z, v):
    return np.abs(np.abs((z * v).sum(axis=0)) - 1).max()


@pytest.mark.parametrize("seed, size", [(0, 1), (1, 2), (2, 7), (3, 64), (4, 150)])
def test_solver_equals_numpy(seed, size):
    rng = np.random.default_rng(seed)
    y = rng.standard_normal((3 * size + 5, size)) * rng.uniform(0.05, 5, size)
    r = np.linalg.qr(y, mode="r")
    values, z = whitening.directions(r, size)
    e, v = np.linalg.eigh(y.T @ y)
    assert np.allclose(values**2, e[::-1], rtol=1e-11) and same_up_to_sign(z, v[:, ::-1]) < 1e-11
    assert np.abs(z.T @ z - np.eye(size)).max() < 1e-10


def test_small_values_keep_their_relative_accuracy():
    q, e = np.logspace(0, -60, 13) ** 2, np.full(12, 1e-140)
    assert np.allclose(whitening.dqds(q, e), q, rtol=1e-12)
    a, b = np.array([1.0, 1e-20, 1.0]), np.array([1.0, 1.0])
    assert np.isclose(whitening.dqds(a * a, b * b)[-1] ** 0.5 * np.prod(whitening.dqds(a * a, b * b)[:2] ** 0.5), 1e-20, rtol=1e-12)


def test_ties_and_missing_dimensions():
    turn = np.linalg.qr(np.random.default_rng(0).standard_normal((8, 8)))[0]
    for r in (np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]), np.linalg.qr(np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]) @ turn, mode="r")):
        values, z = whitening.directions(r, 8)
        assert np.allclose(values, [3, 3, 3, 2, 2, 1])
        assert np.abs(z.T @ z - np.eye(6)).max() < 1e-12 and np.allclose(np.linalg.norm(r @ z, axis=0), values)
    assert whitening.directions(np.zeros((3, 3)), 3)[0].size == 0


def checked(rows, width, out):
    """Recompute everything from the whole table by the covariance matrix."""
    x = np.array([np.floor(64 * np.array(v, dtype=float)) + 1_000_000 for _, v in rows])
    n, total = len(x), x.sum(axis=0)
    y = (n * x - total) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1][:width], v[:, ::-1][:, :width]
    whole = np.array([r.whitened for r in out]).reshape(n, width)
    assert [r.component for r in out] == list(range(1, width + 1)) * n and {r.n for r in out} == {n}
    assert np.allclose(np.abs(whole), np.abs(y @ (v / np.sqrt(e))), atol=1e-7)
    assert np.abs(whole.T @ whole / n - np.eye(width)).max() < 1e-9 and max(r.identity_error for r in out) < 1e-9
    assert np.allclose([r.explained for r in out[:width]], e / np.trace(y.T @ y / n), rtol=1e-9)
    exact = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, total)) for row in x]
    assert [r.deviation for r in out] == np.repeat(exact, width).tolist()


def test_whitening_query(spark, sf_dir):
    rows = duckdb.sql(f"select vec_id, embedding from '{sf_dir}/embeddings.parquet' order by vec_id").fetchall()
    out = queries.QUERIES["op13_qd_whitening"](spark, sf_dir).orderBy("vec_id", "component").collect()
    assert out[0].__fields__ == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    checked(rows, 32, out)


def test_odd_rows_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 300)
    rng = np.random.default_rng(5)
    good = [(i, rng.standard_normal(6).astype("f4").tolist()) for i in range(400)] + [(7, [1.0] * 6), (7, [1.0] * 6)]
    bad = [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [0.0] * 5 + [float("-inf")]), (504, []), (505, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "clash", None) for i, v in good + bad], SCHEMA).repartition(130)
    out = sorted(whitening.whiten(df).collect(), key=lambda r: (r.vec_id, r.deviation, r.component))
    assert len(out) == 402 * 6
    order = {}
    for r in out:
        order.setdefault((r.vec_id, r.deviation), []).append(r)
    checked_rows, flat = [], []
    x = np.array([np.floor(64 * np.array(v, dtype=float)) + 1_000_000 for _, v in good])
    deviations = [sum((len(x) * int(c) - int(t)) ** 2 for c, t in zip(row, x.sum(axis=0))) for row in x]
    for (i, v), d in zip(good, deviations):
        checked_rows.append((i, v))
        flat += sorted(order[(i, d)], key=lambda r: r.component)[:: 2 if i == 7 and v == [1.0] * 6 else 1]
    checked(checked_rows, 6, flat)


def test_degenerate_tables(spark):
    def made(rows):
        return whitening.whiten(spark.createDataFrame([(i, v, "c", 1) for i, v in rows], SCHEMA)).collect()

    assert made([]) == [] and made([(1, None)]) == [] and made([(1, [1.0, 2.0])]) == [] and made([(i, [0.5, 0.5]) for i in range(5)]) == []
    flat = made([(i, [0.25, i / 10]) for i in range(8)] + [(None, [0.25, 0.0])])
    assert len(flat) == 9 and {r.component for r in flat} == {1} and all(abs(r.explained - 1) < 1e-12 for r in flat)
