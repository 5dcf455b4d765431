"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Words are the chunks between white space, in two readings: the lower-cased letters, and an outline that keeps
case, digits and signs but not the letters ("reerwh$$$" is "a$$$"). A chunk that repeats one of the two chunks
before it has the outline of a repeat. Features are n-grams of one to three words and of one to three outlines, hashed to
``DIMENSIONS``; a document's vector holds their shares, so its length doesn't matter. The score is the logistic
function of one sparse dot product.

Training takes at most about ``SAMPLE_ROWS`` labelled rows, picked by a hash of their key: a bound on the
training cost, documented here. They are dealt to up to ``LEARNERS`` tasks; each runs per-coordinate FTRL over its rows
and the weights are averaged. Scoring covers every row and every whole text.

Sources: McMahan et al., "Ad click prediction: a view from the trenches" (2013); Zinkevich et al., "Parallelized
stochastic gradient descent" (2010) for the averaging.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm.shared import held, keep_texts, map_texts
from siteloom.llm.textual import MIX, Chunks, code, spread

DIMENSIONS = 1 << 18
SAMPLE_ROWS = 12_000
LEARNERS = 6
# few rows go to fewer learners, so that each sees enough of them
ROWS_PER_LEARNER = 1_000
EPOCHS = 4
THRESHOLD = 0.3
# shares are small numbers; scaled, a step of the learner moves the score visibly
SCALE = 8.0

_UPPER, _LOWER = regex.compile(r"\p{Lu}+").sub, regex.compile(r"[\p{L}--\p{Lu}]+", regex.V1).sub
_DIGITS, _LONG = regex.compile(r"\p{N}+").sub, regex.compile(r"(.)\1{3,}").sub
_LETTERS = regex.compile(r"[^\p{L}]+").sub


def outline(chunk: str) -> str:
    return _LONG(r"\1\1\1", _DIGITS("0", _LOWER("a", _UPPER("A", chunk))))


def _describe(chunk: str) -> tuple[int, int, int]:
    return code(_LETTERS("", chunk.lower())), code(outline(chunk), 1), code(chunk, 2)


def slots(text: str) -> np.ndarray:
    """The hashed features of a whole text, one entry for each occurrence."""
    chunks = held(("quality",), lambda: Chunks(_describe, 3))(text)
    if not len(chunks):
        return np.zeros(0, dtype=np.int64)
    word, shape, own = chunks[:, 0], chunks[:, 1].copy(), chunks[:, 2]
    shape[2:][own[2:] == own[:-2]] = 2
    shape[1:][own[1:] == own[:-1]] = 1
    grams = []
    for units, mark in ((word, 11), (shape, 37)):
        first, second, third = (units * m for m in MIX)
        grams += [first + np.uint64(mark), first[:-1] + second[1:] + np.uint64(mark + 6), first[:-2] + second[1:-1] + third[2:] + np.uint64(mark + 12)]
    return (spread(np.concatenate(grams)) >> np.uint64(46)).astype(np.int64)


def _logistic(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def leader(rows: list[tuple[np.ndarray, np.ndarray, int]], alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL over (slots, values, label) rows; the last weight is the bias."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at):
        own = z[at]
        return np.where(np.abs(own) <= l1, 0.0, -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, values, label = rows[k]
            w = weights(at)
            gradient = (_logistic(w @ values) - label) * values
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / alpha * w
            n[at] += squared
    return weights(np.arange(DIMENSIONS + 1))


def _row(text: str, label: int) -> tuple[np.ndarray, np.ndarray, int]:
    found = slots(text)
    at, counts = np.unique(found, return_counts=True)
    return np.append(at, DIMENSIONS), np.append(counts * (SCALE / max(1, len(found))), 1.0), label


def sample(docs: DataFrame, labels: DataFrame, *, key: str, label: str, bound: int, seed: int = 7) -> tuple[DataFrame, int]:
    """``text`` and ``_label`` of at most about ``bound`` labelled rows, the same ones on every run; and about how many.

    Rows without key or label are no examples. A key labelled twice counts with its largest label, and one with several
    rows in ``docs`` gives one of their texts, so repeated keys cannot exceed the bound.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("_label"))
    total = max(1, known.count())
    share = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    picked = known.where(share < bound / total)
    met = docs.select(key, "text").join(F.broadcast(picked), key).withColumn("_order", F.xxhash64("text"))
    one = met.groupBy(key).agg(F.min_by("text", "_order").alias("text"), F.first("_label").alias("_label"))
    return one, min(bound, total)


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", bound: int = SAMPLE_ROWS) -> np.ndarray:
    """The model: ``DIMENSIONS`` weights and a bias, 32-bit, about 1 MB. Without labelled rows all are zero."""
    rows, about = sample(docs, labels, key=key, label=label, bound=bound)
    learners = max(1, min(LEARNERS, about // ROWS_PER_LEARNER))
    order = F.xxhash64(F.col(key), F.lit(1))
    dealt = rows.select(F.pmod(order, F.lit(learners)).alias("learner"), order.alias("order"), "text", "_label")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("order", kind="stable")
        examples = [_row(t or "", int(y)) for t, y in zip(group["text"], group["_label"])]
        return pd.DataFrame({"weights": [leader(examples).astype("<f4").tobytes()]})

    learned = dealt.groupBy("learner").applyInPandas(learn, "weights binary").collect()
    if not learned:
        return np.zeros(DIMENSIONS + 1, dtype=np.float32)
    return np.mean([np.frombuffer(r["weights"], dtype="<f4") for r in learned], axis=0).astype(np.float32)


def scores(texts: list[str], model: np.ndarray) -> np.ndarray:
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        found = slots(text)
        out[i] = model[DIMENSIONS] + (model[found].sum(dtype=np.float64) * SCALE / len(found) if len(found) else 0.0)
    return _logistic(out)


def score(df: DataFrame, model: np.ndarray, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score double`` for every row; a null or empty text gets the bias alone."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return map_texts(df, list(keep), text, "score double", lambda texts: {"score": pa.array(scores(texts, shared.value))})


def keep_good(df: DataFrame, model: np.ndarray, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score at least ``threshold``, all their columns unchanged."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return keep_texts(df, text, lambda texts: scores(texts, shared.value) >= threshold)
