"""Toxicity: gradient-boosted trees over dense features of the text, with isotonic calibration.

Features of a document: densities of lexicon words (built-in and learned), how near they stand to a second-person
word, shares of capitals, punctuation and obfuscated words, and the length. The learned lexicon holds word stems
(whole words and prefixes of 3 to 8 letters) that stand in toxic training rows far more often than chance lets
them. All is read from the whole text.

Training takes at most about ``SAMPLE_ROWS`` labelled rows, picked by a hash of their key. Eight tenths of them
give the lexicon and the trees, two tenths the calibration, so the calibration sees neither. The lexicon holds at
most ``LEXICON_ENTRIES`` stems, the strongest first. Scoring covers every row and every whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm.quality import sample
from siteloom.llm.shared import held, map_texts, written
from siteloom.llm.textual import Chunks, code

SAMPLE_ROWS = 12_000
LEXICON_ENTRIES = 4_000
# least log-likelihood ratio of a learned stem: five rows, all toxic, where one in nine is
LEAST_EVIDENCE = 9.5
THRESHOLD = 0.7
NEAR = 5
STEMS = (3, 4, 5, 6, 7, 8)

# Insults that need no learning, and second-person words of four languages.
INSULTS = frozenset(
    "idiot idiots stupid moron morons loser losers pathetic worthless disgusting scum trash clown dumb imbecile jerk "
    "bastard bitch asshole retard filth vermin".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "usted ustedes tus ti vosotros".split()
)
# Signs that stand in for letters.
DISGUISE = str.maketrans("013457@$!|", "oieastasil")

_CORE = regex.compile(r"^[^\p{L}\p{N}@$]+|[^\p{L}\p{N}@$]+$").sub
_LETTERS = regex.compile(r"[^\p{L}]+").sub
_INNER = regex.compile(r"\p{L}[^\p{L}\s'’-]+\p{L}").search
_SIGNS = regex.compile(r"[^\p{L}\p{N}\s]").findall

COLUMNS = (
    "hit_share", "hits", "distinct_hits", "weight_share", "largest_weight", "insult_share", "near_second_person",
    "second_person_share", "capitals_share", "shout_share", "sign_share", "obfuscated_share", "obfuscated_hits", "words",
)


def plain(chunk: str) -> tuple[str, bool]:
    """The letters of a chunk, lower-cased, with stand-ins put back; and whether it was obfuscated."""
    core = _CORE("", chunk.lower())
    hidden = bool(_INNER(core))
    return _LETTERS("", core.translate(DISGUISE) if hidden else core), hidden


def stems(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


@dataclass
class Lexicon:
    """Weights of stems, in natural logarithms of the odds."""

    weights: dict[str, float]

    def describe(self, chunk: str) -> tuple[int, ...]:
        word, hidden = plain(chunk)
        insult = word in INSULTS
        weight = max([self.weights.get(s, 0.0) for s in stems(word)], default=0.0)
        letters = [c for c in chunk if c.isalpha()]
        capitals = len(letters) > 1 and all(c.isupper() for c in letters)
        return (
            code(word) + 1 if insult or weight > 0 else 0,
            int(1000 * max(weight, 3.0 if insult else 0.0)),
            insult,
            word in SECOND_PERSON,
            capitals,
            hidden,
            len(_SIGNS(chunk)),
            chunk.count("!"),
        )


def features(text: str, chunks: Chunks) -> list[float]:
    """One value for each of ``COLUMNS``; an empty text has all at zero."""
    rows = chunks(text)
    n = len(rows)
    if not n:
        return [0.0] * len(COLUMNS)
    hit, weight, insult, second, capitals, hidden, signs, shouts = rows.T.astype(np.float64)
    at, you = np.flatnonzero(hit), np.flatnonzero(second)
    near = 0
    if len(at) and len(you):
        place = np.searchsorted(you, at)
        gap = np.minimum(np.abs(you[np.minimum(place, len(you) - 1)] - at), np.abs(at - you[np.maximum(place - 1, 0)]))
        near = int((gap <= NEAR).sum())
    return [
        len(at) / n,
        math.log1p(len(at)),
        math.log1p(len(np.unique(rows[at, 0]))),
        weight.sum() / 1000 / n,
        weight.max() / 1000,
        insult.sum() / n,
        near / n,
        len(you) / n,
        capitals.sum() / n,
        shouts.sum() / n,
        signs.sum() / n,
        hidden.sum() / n,
        math.log1p(float((hidden * (hit > 0)).sum())),
        math.log1p(n),
    ]


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Stems of ``rows(text, _label)`` whose share of toxic rows differs from the overall one beyond chance."""
    total, toxic = rows.agg(F.count("*"), F.sum("_label")).first()
    if not toxic or toxic == total:
        return Lexicon({})

    def found(texts: list[str]) -> dict[str, pa.Array]:
        own = [sorted({s for chunk in set(t.split()) for s in stems(plain(chunk)[0]) if len(s) > 2}) for t in texts]
        return {"stems": pa.array(own, pa.list_(pa.string()))}

    share = toxic / total
    each = map_texts(rows, ["_label"], "text", "stems array<string>", found).select("_label", F.explode("stems").alias("stem"))
    counted = each.groupBy("stem").agg(F.count("*").alias("n"), F.sum("_label").alias("k"))
    p = F.col("k") / F.col("n")
    rest = F.when(F.col("n") > F.col("k"), (F.col("n") - F.col("k")) * F.log((1 - p) / (1 - share))).otherwise(0.0)
    tested = counted.where(p > share).withColumn("evidence", F.col("k") * F.log(p / share) + rest)
    odds = F.log((F.col("k") + 0.5) / (F.col("n") - F.col("k") + 0.5)) - math.log(share / (1 - share))
    strong = tested.where((F.col("evidence") >= LEAST_EVIDENCE) & (p >= 0.6)).select("stem", odds.alias("weight"), "evidence")
    best = strong.orderBy(F.desc("evidence"), "stem").limit(LEXICON_ENTRIES).collect()
    return Lexicon({r["stem"]: float(r["weight"]) for r in best})


def measured(df: DataFrame, lexicon: Lexicon, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``features array<double>`` of every row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    mark = hash(frozenset(lexicon.weights.items()))

    def rows(texts: list[str]) -> dict[str, pa.Array]:
        chunks = held(("toxicity", mark), lambda: Chunks(shared.value.describe, 8))
        return {"features": pa.array([features(t, chunks) for t in texts], pa.list_(pa.float64()))}

    return map_texts(df, list(keep), text, "features array<double>", rows)


@dataclass
class Model:
    """What scoring needs; ``trees`` is None where the labels hold one class or none, and then ``share`` is the score."""

    lexicon: Lexicon
    trees: object
    curve: object
    share: float


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "toxic", bound: int = SAMPLE_ROWS) -> Model:
    picked, _ = sample(docs, labels, key=key, label=label, bound=bound, seed=9)
    rows = written(picked.select("text", "_label", F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(10)).alias("_fold")), "toxic-rows")
    fit, check = rows.where("_fold < 8"), rows.where("_fold >= 8")
    counts = rows.agg(
        F.count("*").alias("n"), F.sum("_label").alias("k"), F.sum(F.expr("if(_fold < 8, _label, 0)")).alias("k_fit"),
        F.sum(F.expr("if(_fold < 8, 1, 0)")).alias("n_fit"),
    ).first()
    share = float((counts["k"] or 0) / max(1, counts["n"]))
    if not counts["k_fit"] or counts["k_fit"] == counts["n_fit"]:
        return Model(Lexicon({}), None, None, share)
    lexicon = learn_lexicon(fit)
    known = written(
        measured(rows, lexicon, keep=("_label", "_fold")).withColumn("features", array_to_vector("features")), "toxic-features"
    )
    trees = GBTClassifier(featuresCol="features", labelCol="_label", maxIter=16, maxDepth=3, stepSize=0.2, seed=1)
    trees = trees.fit(known.where("_fold < 8").withColumn("_label", F.col("_label").cast("double")))
    judged = _raw(trees, known.where("_fold >= 8")).select(F.col("_label").cast("double").alias("label"), "raw")
    curve = None
    if check.select("_label").distinct().count() == 2:
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(judged)
    return Model(lexicon, trees, curve, share)


def _raw(trees, df: DataFrame) -> DataFrame:
    return trees.transform(df).withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def score(df: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score double`` between 0 and 1 for every row; a null or empty text is scored by its zero features."""
    if model.trees is None:
        return df.select(*keep, F.lit(model.share).alias("score"))
    found = measured(df, model.lexicon, text=text, keep=keep).withColumn("features", array_to_vector("features"))
    judged = _raw(model.trees, found)
    if model.curve is None:
        return judged.select(*keep, F.col("raw").alias("score"))
    judged = model.curve.transform(judged)
    return judged.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score"))).alias("score"))


def keep_clean(df: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score below ``threshold``, all their columns unchanged."""
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{text}`").alias("_text_in"))
    scored = score(inner, model, text="_text_in", keep=("_row",))
    return scored.where(F.col("score") < threshold).select("_row.*")
