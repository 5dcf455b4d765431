"""Near-duplicate documents by weighted MinHash signatures (DartMinHash) and a banded join.

A document is a multiset of five-word shingles over its lower-cased words (letters and digits of the chunks between
white space; a text of fewer words is one shingle). Equal texts are one class from the start, and everything below
runs on one member of each class.

Signature: every shingle owns a region of the plane, its weight wide and endless along the time axis. Hashed darts
fall on it as a Poisson process of unit rate: those of one unit of weight come at times that are sums of hashed
exponential gaps, and a hash deals each dart to one of ``COORDINATES``. A coordinate keeps its earliest dart. Only
darts before a time limit are thrown, about ``k log k`` a document whatever its length; the limit is doubled until
every coordinate is hit. Two documents agree on a coordinate with a probability equal to their weighted Jaccard
similarity.

Join: ``BANDS`` bands of ``ROWS`` coordinates are hashed to buckets. First, the members of a bucket meet one pivot, not
each other, and are linked to it if their exact weighted Jaccard similarity is at least ``SIMILARITY``. Copies of
one text are connected then. A bucket that still holds several components is compared to the end: its members
outside its largest component meet all its members, in blocks of bounded size, and a block gives only links that connect. So
every pair that shares a bucket is either compared exactly or already connected through others. At 0.8, 20 bands
of 4 miss one pair in 40,000.

Source: Christiani, "DartMinHash: fast sketching for weighted sets" (2020).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.llm.components import components
from siteloom.llm.shared import Recent, held, map_texts, narrow, written
from siteloom.llm.textual import MIX, Chunks, spread

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
COORDINATES = BANDS * ROWS
# Members on either side of a block that one call compares.
BLOCK = 256
# Texts are equal if two hashes and the length are.
SAME = ["_h1", "_h2", "_n"]

_WORD = regex.compile(r"[^\p{L}\p{M}\p{N}]+").sub


def _describe(chunk: str) -> tuple[int]:
    word = chunk.lower()
    if not word.isalnum():
        word = _WORD("", word)
    return (int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") if word else 0,)


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a whole text, hashed and sorted, and how often each occurs."""
    own = held(("words",), lambda: Chunks(_describe, 1))(text)[:, 0]
    own = own[own != 0]
    if not len(own):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    width = min(words, len(own))
    made = np.full(len(own) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        made = (made + own[i : len(own) - width + 1 + i]) * MIX[i % 3]
        made ^= made >> np.uint64(29)
    return np.unique(spread(made), return_counts=True)


def _unit(values: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((values >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def darts(keys: np.ndarray, weights: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The signature of a weighted set: for each coordinate, the hash of its earliest dart.

    ``weights`` may be any positive numbers; a fraction of a unit keeps the darts that fall on it.
    """
    whole = np.ceil(weights).astype(np.int64)
    units = int(whole.sum())
    if units == len(keys):
        seed, width = spread(keys), weights
    else:
        owner = np.repeat(np.arange(len(keys)), whole)
        unit = np.arange(units) - np.repeat(np.cumsum(whole) - whole, whole)
        seed, width = spread(keys[owner] + unit.astype(np.uint64) * MIX[0]), np.minimum(1.0, weights[owner] - unit)
    limit = (coordinates * math.log(coordinates) + 2 * coordinates) / float(weights.sum())
    while True:
        times, thrown, on = [], [], []
        time, source, wide, n = 0.0, seed, width, 0
        while len(source):
            dart = spread(source + np.uint64((2 * n + 1) * int(MIX[1]) % 2**64))
            time = time - np.log(_unit(dart))
            soon = np.flatnonzero(time < limit)
            time, source, wide, dart = time[soon], source[soon], wide[soon], dart[soon]
            times.append(time)
            thrown.append(dart)
            on.append(wide)
            n += 1
        dart, time, wide = np.concatenate(thrown), np.concatenate(times), np.concatenate(on)
        place = spread(dart + MIX[2])
        if units != len(keys) or (width < 1.0).any():
            hit = _unit(spread(place)) <= wide
            dart, time, place = dart[hit], time[hit], place[hit]
        order = np.lexsort((dart, time))
        where, first = np.unique((place[order] % np.uint64(coordinates)), return_index=True)
        if len(where) == coordinates:
            return dart[order[first]]
        limit *= 2


def bands(text: str) -> np.ndarray:
    """One bucket number for each band; none for a text without words."""
    keys, counts = shingles(text)
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    rows = darts(keys, counts.astype(np.float64)).reshape(BANDS, ROWS)
    made = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        made = spread(made * MIX[0] + rows[:, i])
    return made.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two counted sets; of two empty ones, 0."""
    place = np.searchsorted(a[0], b[0])
    place[place == len(a[0])] = 0
    both = a[0][place] == b[0] if len(a[0]) else np.zeros(len(b[0]), dtype=bool)
    shared = int(np.minimum(a[1][place[both]], b[1][both]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def _identity(text: str) -> list[Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("_h1"), F.hash(whole).alias("_h2"), F.length(whole).alias("_n")]


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All rows with the node of their text, and one row a node with its buckets.

    Nodes are numbered once, in the written table. Texts are equal if two hashes and the length are.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = docs.select(F.col(key).alias("_key"), whole.alias("_text"), *_identity(text))

    def rows(texts: list[str]) -> dict[str, pa.Array]:
        return {"buckets": pa.array([bands(t) for t in texts], pa.list_(pa.int64()))}

    seen = written(map_texts(marked, ["_key", *SAME], "_text", "buckets array<bigint>", rows), "signatures")
    nodes = seen.groupBy(*SAME).agg(F.min("_key").alias("first_key"), F.first("buckets").alias("buckets"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "classes")
    return seen.select("_key", *SAME).join(nodes.select(*SAME, "node"), SAME), nodes


def _texts(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``node, text`` of the wanted classes, from the one row that stands for each."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), whole.alias("text"), F.xxhash64(whole).alias("_h1"))
    one = narrow(wanted.select("node", "_h1", "first_key"))
    return rows.join(one, (rows["_h1"] == one["_h1"]) & rows["_key"].eqNullSafe(one["first_key"])).select("node", "text")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity reaches the threshold."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = Recent(lambda pair: shingles(pair[1]), weigh=lambda pair, made: 4 * len(pair[1]) + 16 * len(made[0]))
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i) for i in range(4))
            good = [
                similarity(known[(a[i].as_py(), text_a[i].as_py())], known[(b[i].as_py(), text_b[i].as_py())]) >= SIMILARITY
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, class_id, kept`` for every row: the class is the least key of its near-duplicate component.

    Null texts count as empty; texts without words link only to equal texts. A null key takes part, and its class
    is null only if the whole component has no key. Rows that repeat are repeated in the result. ``kept`` marks
    the rows whose key is the class's.
    """
    part = _parts(docs, key, text).select("_key", "part")
    least = part.groupBy("part").agg(F.min("_key").alias("class_id"))
    out = part.join(least, "part")
    return out.select(F.col("_key").alias(key), "class_id", F.col("_key").eqNullSafe(F.col("class_id")).alias("kept"))


def _parts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key``, the identity of the text, and ``part``, the near-duplicate component, of every row."""
    rows, nodes = _classes(docs, key, text)
    members = nodes.select("node", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = written(members.join(shared.select("bucket"), "bucket"), "members")
    texts = written(_texts(docs, key, text, nodes.join(members.select("node").distinct(), "node", "left_semi")), "texts")

    pivots = members.groupBy("bucket").agg(F.min("node").alias("b"))
    pairs = members.join(pivots, "bucket").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    tested = written(pairs, "pairs")
    links = written(_linked(tested, texts), "links")
    parts = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    more = written(_compared(_open(members, parts), texts), "more")
    parts = components(links.union(more).select(F.col("a").alias("u"), F.col("b").alias("v")))
    part = rows.join(parts.select(F.col("node"), "component"), "node", "left")
    return part.select("_key", *SAME, F.coalesce("component", "node").alias("part"))


def _open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """``bucket, row, column, outer, node``: the blocks still to compare.

    Only buckets of several components are left. ``outer`` nodes stand outside the bucket's largest component; each
    row of blocks holds some of them, each column some of all members.
    """
    placed = members.join(parts, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("part"))
    counted = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    bucket = counted.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("parts"))
    bucket = bucket.where("parts > 1").select(
        "bucket",
        F.col("most.part").alias("main"),
        F.ceil((F.col("n") - F.col("most.n")) / BLOCK).cast("int").alias("rows"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("columns"),
    )
    met = written(placed.join(bucket, "bucket"), "open")
    own = F.xxhash64("node", "bucket")
    outer = met.where("part <> main").select(
        "bucket", F.pmod(own, "rows").alias("row"), F.explode(F.expr("sequence(0, columns - 1)")).alias("column"), F.lit(True).alias("outer"), "node"
    )
    every = met.select(
        "bucket", F.explode(F.expr("sequence(0L, rows - 1L)")).alias("row"), F.pmod(own, "columns").cast("int").alias("column"), F.lit(False), "node"
    )
    return outer.union(every)


def _compared(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect what the exact comparison of all blocks connects."""
    key = ["bucket", "row", "column"]
    met = blocks.join(texts, "node").select(*key, "outer", "node", "text").repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        now, outer, every = None, {}, {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            found: list[tuple[int, int]] = []
            for bucket, row, column, side, node, text in zip(*columns):
                if (bucket, row, column) != now:
                    found += _block_links(outer, every)
                    now, outer, every = (bucket, row, column), {}, {}
                if node not in known:
                    if len(known) >= BLOCK:
                        known.clear()
                    known[node] = shingles(text)
                (outer if side else every)[node] = known[node]
            yield _pairs(found)
        yield _pairs(_block_links(outer, every))

    return met.mapInArrow(run, "a bigint, b bigint")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _block_links(outer: dict[int, tuple], every: dict[int, tuple]) -> list[tuple[int, int]]:
    """Similar pairs of a block; of those between two nodes that are connected already, none."""
    if not outer or not every:
        return []
    nodes = list(every)
    keys = np.concatenate([every[n][0] for n in nodes])
    counts = np.concatenate([every[n][1] for n in nodes])
    owner = np.repeat(np.arange(len(nodes)), [len(every[n][0]) for n in nodes])
    order = np.argsort(keys, kind="stable")
    keys, counts, owner = keys[order], counts[order], owner[order]
    sizes = np.array([int(every[n][1].sum()) for n in nodes])
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.get(x, x) != x:
            x = above[x]
        return x

    links = []
    for node, (own, times) in outer.items():
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        spans = high - low
        at = np.repeat(low - np.cumsum(spans) + spans, spans) + np.arange(int(spans.sum()))
        shared = np.bincount(owner[at], weights=np.minimum(counts[at], np.repeat(times, spans)), minlength=len(nodes))
        total = int(times.sum()) + sizes - shared
        alike = shared / np.maximum(total, 1) >= SIMILARITY
        for other in np.flatnonzero(alike).tolist():
            a, b = root(node), root(nodes[other])
            if a != b:
                above[a] = b
                links.append((node, nodes[other]))
    return links


def keep_first(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate class, all columns unchanged, whatever keys repeat or are null.

    It is a row with the class's least key (without one, of null key); of unlike texts under that key, the one with
    the least hash. Rows that agree in key and text are interchangeable.
    """
    rows = _parts(docs, key, text).groupBy("_key", *SAME, "part").agg(F.count("*").alias("copies"))
    rows = written(rows, "judged")
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", *SAME, "copies")).alias("one")
    chosen = written(rows.groupBy("part").agg(first).select("one.*"), "chosen")
    dropped = written(rows.join(chosen, _same_row(rows, chosen), "left_anti").select("_key", *SAME), "dropped")
    marked = docs.select("*", *_identity(text), F.col(key).alias("_key"))
    kept = marked.join(narrow(dropped), _same_row(marked, dropped), "left_anti")
    if not chosen.where("copies > 1").isEmpty():
        kept = kept.dropDuplicates(SAME)  # a text is kept under one key only
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    met = a["_key"].eqNullSafe(b["_key"])
    for name in SAME:
        met = met & (a[name] == b[name])
    return met
