"""Small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.session import fits_broadcast, scratch_path

# Rows of at most a few dozen bytes that a broadcast may hold: about 20 MB.
NARROW_BROADCAST_ROWS = 400_000
# Bytes of text that one Python call handles at a time; a longer text comes alone.
SLICE_BYTES = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a replayable cut of the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, max_rows: int = NARROW_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a table of a few fixed-width columns only after its rows were counted to be few."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def map_texts(
    df: DataFrame, keep: list[str], text: str, schema: str, rows: Callable[[list[str]], dict[str, pa.Array]]
) -> DataFrame:
    """One output row per input row: the ``keep`` columns beside what ``rows`` makes of the whole texts.

    A null text counts as empty. Batches are cut by bytes, so memory follows the longest text and not the
    number of rows.
    """
    frame = df.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for begin, end in _byte_runs(texts):
                made = rows(texts.slice(begin, end - begin).to_pylist())
                columns = [batch.column(i).slice(begin, end - begin) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, *made.values()], names=[*keep, *made])

    return frame.mapInArrow(run, f"{kept}, {schema}" if kept else schema)


def keep_texts(df: DataFrame, text: str, wanted: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """The rows of ``df`` whose whole text is wanted, with all columns; a null text is judged as an empty one."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in _byte_runs(batch.column(place)):
                part = batch.slice(begin, end - begin)
                mask = wanted([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(mask, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _byte_runs(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    sizes = pc.binary_length(texts).to_pylist()
    begin = size = 0
    for i, n in enumerate(sizes):
        if i > begin and size + (n or 0) > limit:
            yield begin, i
            begin, size = i, 0
        size += n or 0
    if begin < len(sizes):
        yield begin, len(sizes)


# Estimated bytes of keys and values in one generation of a memo, and the longest key that is worth keeping.
MEMO_BYTES = 40_000_000
MEMO_KEY_CHARS = 200
ENTRY_BYTES = 170


class Recent(dict):
    """A bounded memo: ``make(key)`` is called for keys not seen recently, two generations of ``size`` bytes are kept.

    Strings longer than ``MEMO_KEY_CHARS`` are made anew each time, as a chunk without white space may hold megabytes.
    """

    def __init__(self, make: Callable, size: int = MEMO_BYTES, weigh: Callable | None = None):
        super().__init__()
        self._make, self._size, self._used, self._old, self._weigh = make, size, 0, {}, weigh

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        # chunks cost at most four bytes a character in Python, and mostly one
        cost = self._weigh(key, value) if self._weigh else 2 * len(key) + len(value) + ENTRY_BYTES
        if self._used + cost > self._size:
            self._old, self._used = dict(self), 0
            self.clear()
        if cost <= self._size and (self._weigh or len(key) <= MEMO_KEY_CHARS):
            self._used += cost
            self[key] = value
        return value


_held: dict = {}


def held(key: tuple, make: Callable):
    """The one object that a Python worker keeps from task to task: another key frees what the key before left."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]
