"""Whitening of embeddings by a bidiagonal qd solver.

Vectors become integers, so their number and sums are exact. Each partition folds its centred rows into a triangular
factor R by blockwise QR; factors meet in a tree, and one R of dimension x dimension reaches the driver. There, Householder
reflections make R bidiagonal, dqds transforms give its singular values to high relative accuracy, and a twisted
factorisation of the shifted tridiagonal B'B gives each direction; directions of values that are too close to tell apart
are iterated together and kept orthogonal. The directions go back to the executors, which project every row.

The dimension must be small enough for a task to hold a few square matrices of it (4,096: 134 MB each).

Sources: Fernando, Parlett, "Accurate singular values and differential qd algorithms" (1994); Dhillon, Parlett,
"Multiple representations to compute orthogonal eigenvectors" (2004); Demmel et al., "Communication-optimal QR" (2012).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = float(np.finfo(np.float64).eps)
COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
FAN_IN = 64
# Values nearer than this, relative to their size, are solved together.
CLUSTER = 1e-5
BLOCK_BYTES = 8_000_000


# --- rows -----------------------------------------------------------------------------------------------------------


def _integers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and floor(SCALE * c) + SHIFT of their entries."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    fits = lengths == size
    flat = pc.list_flatten(column.filter(pa.array(fits))).cast(pa.float64()).to_numpy(zero_copy_only=False)
    values = flat.reshape(-1, size) if size else np.zeros((0, 0))
    finite = np.isfinite(values).all(axis=1)  # a null entry reads as NaN
    fits[fits] = finite
    return fits, np.floor(SCALE * values[finite]).astype(np.int64) + SHIFT


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    step = max(size, BLOCK_BYTES // (8 * max(1, size)))
    for begin in range(0, batch.num_rows, step):
        part = batch.slice(begin, step)
        fits, x = _integers(part.column(part.num_columns - 1), size)
        if len(x):
            yield part, fits, x


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length of usable vectors, the larger of equally frequent ones; 0 if there are none."""
    usable = F.col(f"`{vector}`").isNotNull() & ~F.exists(f"`{vector}`", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    best = df.where(usable).groupBy(F.size(f"`{vector}`").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return best["d"] if best else 0


def sums(df: DataFrame, vector: str, size: int) -> tuple[int, np.ndarray]:
    """The number of usable vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, dtype=np.int64)
        for batch in batches:
            for _, _, x in _blocks(batch, size):
                n += len(x)
                total += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(total)], names=["at", "n", "total"])

    rows = df.select(vector).mapInArrow(run, "at int, n bigint, total bigint").groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = sorted(rows.collect())
    return (found[0]["n"], np.array([r["total"] for r in found], dtype=np.int64)) if found else (0, np.zeros(size, dtype=np.int64))


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return (n * x - total) / n


def _tree(df: DataFrame, state: Callable[[Iterator[pa.RecordBatch]], bytes | None], join: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One state of each partition, joined ``FAN_IN`` at a time until one is left for the driver."""

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = state(batches)
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([made], pa.binary())], names=["part", "state"])

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "state": [join(group.sort_values("part")["state"].tolist())]})

    level = df.mapInArrow(leaf, "part int, state binary")
    for _ in range(2):
        level = level.groupBy(F.floor(F.col("part") / FAN_IN).cast("int").alias("_part")).applyInPandas(meet, "part int, state binary")
    last = level.groupBy(F.lit(0).alias("_part")).applyInPandas(meet, "part int, state binary").collect()
    return bytes(last[0]["state"]) if last else None


def triangular(df: DataFrame, vector: str, size: int, n: int, total: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""

    def state(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        r = None
        for batch in batches:
            for _, _, x in _blocks(batch, size):
                y = _centred(x, n, total)
                r = np.linalg.qr(y if r is None else np.vstack([r, y]), mode="r")
        return None if r is None else r.tobytes()

    def join(states: list[bytes]) -> bytes:
        r = np.frombuffer(states[0]).reshape(-1, size)
        for other in states[1:]:
            r = np.linalg.qr(np.vstack([r, np.frombuffer(other).reshape(-1, size)]), mode="r")
        return r.tobytes()

    made = np.frombuffer(_tree(df.select(vector), state, join)).reshape(-1, size)
    return np.vstack([made, np.zeros((size - len(made), size))])


# --- the solver ---------------------------------------------------------------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta so that (I - beta v v') x has only a first entry."""
    v, norm = x.copy(), float(np.linalg.norm(x[1:]))
    if norm == 0.0:
        return v, 0.0
    v[0] = x[0] + np.copysign(np.hypot(x[0], norm), x[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal and superdiagonal of B = U'RV, and the reflectors that make up V."""
    a, turns = r.copy(), []
    d = len(a)
    for k in range(d):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            turns.append((k + 1, v, beta))
    return np.diag(a).copy(), np.diag(a, 1).copy(), turns


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds step; None where the shift is above the least value."""
    q2, e2, d = [], [], q[0] - shift
    least = d
    for k in range(len(e)):
        if d < 0.0 or d + e[k] == 0.0:
            return None
        top = d + e[k]
        ratio = q[k + 1] / top
        q2.append(top)
        e2.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0.0 or d != d:
        return None
    q2.append(d)
    return q2, e2, least


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal matrix with squared diagonal q and squared superdiagonal e, falling."""
    found, work = [], [(list(map(float, q)), list(map(float, e)), 0.0)]
    while work:
        q, e, moved = work.pop()
        if len(q) == 1:
            found.append(q[0] + moved)
            continue
        guess, cut, rounds = 0.0, None, 0
        while cut is None:
            top = max(q) + moved
            small = [k for k, value in enumerate(e) if value <= EPS * EPS * (moved + min(q[k], q[k + 1])) or value <= EPS * EPS * EPS * top]
            if small:
                cut = small[-1]
                break
            rounds += 1
            # the trailing 2 x 2 block names a shift a little below the least value
            a, b, c = q[-2] + e[-2] if len(e) > 1 else q[-2], q[-1] + e[-1], q[-2] * e[-1]
            corner = (a + b) / 2 - np.hypot((a - b) / 2, np.sqrt(c))
            shift = max(0.0, min(corner, guess if guess > 0 else corner) * (1 - 4 * EPS))
            step = _transform(q, e, shift)
            while step is None:
                shift = shift / 4 if shift > EPS * EPS * top else 0.0
                step = _transform(q, e, shift)
                if step is None and shift == 0.0:  # only a zero row and column give no step
                    step = ([v + EPS**3 * top for v in q], e, 0.0)
            q, e, guess = step
            moved += shift
            if rounds > 60 * len(q) + 200:
                raise ArithmeticError("dqds did not converge")
        work.append((q[: cut + 1], e[:cut], moved))
        work.append((q[cut + 1 :], e[cut + 1 :], moved))
    return np.sort(np.maximum(found, 0.0))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit vector that a twisted factorisation of B'B - value finds where its pivot is smallest."""
    n, tiny = len(a), EPS * EPS * float(np.max(a * a) + value)
    d, low = a * a, np.divide(b, a[:-1])
    plus, minus, s, p = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        pivot = d[k] + s[k]
        pivot = pivot if abs(pivot) > tiny else -tiny
        plus[k] = low[k] * d[k] / pivot
        s[k + 1] = plus[k] * low[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] * low[k] + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        ratio = d[k] / pivot
        minus[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - value
    at = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -plus[k] * z[k + 1]
    for k in range(at, n - 1):
        z[k + 1] = -minus[k] * z[k]
    return z / np.linalg.norm(z)


def _together(a: np.ndarray, b: np.ndarray, values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Orthonormal directions of values too close to tell apart: inverse iteration on the whole group, then Ritz."""
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    z = np.random.default_rng(len(values)).standard_normal((len(a), len(values)))
    shifted = t - (values.mean() + EPS * max(abs(t).max(), EPS)) * np.eye(len(a))
    for _ in range(4):
        z = np.linalg.solve(shifted, z)
        z, _ = np.linalg.qr(z - known @ (known.T @ z))
    _, turn = np.linalg.eigh(z.T @ t @ z)
    return z @ turn[:, ::-1]


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of R, falling, and their right directions as columns.

    Values that rounding cannot tell from zero are left out. The entry of largest size in a direction is positive.
    """
    size = float(np.abs(r).max()) if r.size else 0.0
    if size == 0.0:
        return np.zeros(0), np.zeros((len(r), 0))
    a, b, turns = bidiagonal(r / size)
    a = np.where(np.abs(a) < EPS * EPS, EPS * EPS, a)
    squares = dqds(a * a, b * b)
    kept = int((squares > (4 * len(a) * EPS) ** 2 * squares[0]).sum())
    count = min(count, kept)
    z, at = np.zeros((len(a), 0)), 0
    while z.shape[1] < count:
        end = at + 1
        while end < len(squares) and squares[end - 1] - squares[end] < CLUSTER * squares[end - 1]:
            end += 1
        made = twisted(a, b, squares[at])[:, None] if end == at + 1 else _together(a, b, squares[at:end], z)
        z, at = np.hstack([z, made]), end
    z = z[:, :count]
    for begin, v, beta in reversed(turns):
        z[begin:] -= beta * np.outer(v, v @ z[begin:])
    z *= np.sign(z[np.abs(z).argmax(axis=0), np.arange(count)])
    return np.sqrt(squares[:count]) * size, z


# --- the operator -------------------------------------------------------------------------------------------------------


def _spread(df: DataFrame, vector: str, size: int, project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The covariance of the projected rows, centred in each block and combined by block means."""

    def pack(n: int, mean: np.ndarray, square: np.ndarray) -> bytes:
        return np.concatenate([[n], mean, square.ravel()]).tobytes()

    def join(states: list[bytes]) -> bytes:
        n, mean, square = 0.0, np.zeros(width), np.zeros((width, width))
        for raw in map(np.frombuffer, states):
            n2, mean2, square2 = raw[0], raw[1 : width + 1], raw[width + 1 :].reshape(width, width)
            gap = mean2 - mean
            square = square + square2 + np.outer(gap, gap) * (n * n2 / (n + n2))
            mean, n = mean + gap * (n2 / (n + n2)), n + n2
        return pack(n, mean, square)

    def state(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        made = None
        for batch in batches:
            for _, _, x in _blocks(batch, size):
                w = project(x)
                mean = w.mean(axis=0)
                own = pack(len(w), mean, (w - mean).T @ (w - mean))
                made = own if made is None else join([made, own])
        return made

    raw = np.frombuffer(_tree(df.select(vector), state, join))
    return raw[width + 1 :].reshape(width, width) / raw[0]


def whiten(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for every usable row and component.

    A vector is usable if it is not null, holds no null or non-finite entry and has the table's most frequent length.
    Fewer components come out where the rows span fewer dimensions, none where they are all equal. A deviation that
    fits no long is null. Repeated rows count as often as they occur; null keys stay; other columns are not read. An
    empty table gives an empty result.
    """
    kind = dict(df.dtypes)[key]
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    size = dimension(df, vector)
    n, total = sums(df, vector, size) if size else (0, np.zeros(0, dtype=np.int64))
    values, axes = np.zeros(0), np.zeros((size, 0))
    if n:
        r = triangular(df, vector, size, n, total)
        values, axes = directions(r, components)
    if not len(values):
        return df.sparkSession.createDataFrame([], schema)
    variances, trace = values**2 / n, float((r * r).sum()) / n
    shares, width, scaled = variances / trace, len(values), axes / np.sqrt(variances)

    def project(x: np.ndarray) -> np.ndarray:
        return _centred(x, n, total) @ scaled

    error = float(np.abs(_spread(df, vector, size, project, width) - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, fits, x in _blocks(batch, size):
                rows = len(x)
                gap = n * x - total
                rough = (gap.astype(np.float64) ** 2).sum(axis=1)
                deviation = (gap * gap).sum(axis=1)
                exact = pa.array(deviation, mask=rough > 9.2e18)
                if (rough > 9.2e18).any():
                    whole = [sum(int(v) ** 2 for v in row) for row in gap]
                    exact = pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())
                each = pa.array(np.repeat(np.arange(rows), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).filter(pa.array(fits)).take(each), pa.array(np.tile(np.arange(1, width + 1), rows), pa.int32()),
                        pa.array(np.full(rows * width, n)), exact.take(each), pa.array(project(x).ravel()),
                        pa.array(np.tile(shares, rows)), pa.array(np.full(rows * width, error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return df.select(key, vector).mapInArrow(run, schema)
