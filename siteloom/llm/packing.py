"""Sum-of-squares packing of token documents into windows.

Online rule: a piece goes to the fill level that makes the sum of squared counts of partially filled windows
smallest, a new window among them. The level array ``open_at[h]`` holds how many windows are filled to ``h``; the
change of the sum needs only ``open_at[h]`` and ``open_at[h + size]``, so one vector expression over the array
decides. On equal change the fullest level wins.

Documents longer than a window are cut at multiples of the window, so the pieces don't depend on the packing.
Pieces are dealt by a hash into groups of a bounded number of tokens and pieces, and each group is packed by itself;
what is left open at a group's end is a handful of windows among thousands.

Source: Csirik, Johnson, Kenyon, Orlin, Shor, Weber, "On the sum-of-squares algorithm for bin packing" (2006).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm.bpe import MEMO_BYTES, MergedEncoder
from siteloom.llm.shared import held, map_texts, written

WINDOW = 4096
END_ID = 2
GROUP_WINDOWS = 4096
GROUP_PIECES = 250_000


def sum_of_squares(sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece, taken in order; every size is between 1 and ``window``."""
    open_at = np.zeros(window + 1, dtype=np.int64)
    holders: list[list[int]] = [[] for _ in range(window + 1)]
    numbers = np.zeros(len(sizes), dtype=np.int64)
    offsets = np.zeros(len(sizes), dtype=np.int64)
    full = sizes == window
    made = int(full.sum())
    numbers[full] = np.arange(made)
    never = np.iinfo(np.int64).max
    for i in np.flatnonzero(~full):
        size = int(sizes[i])
        before, after = open_at[: window - size + 1], open_at[size:]
        # the sum changes by 2 (after - before + 1) at a level in use, by 2 after + 1 for a new window, and by
        # 1 - 2 before at the level that becomes full and leaves the array
        change = 2 * (after - before + 1)
        change[-1] = 1 - 2 * before[-1]
        change[before == 0] = never
        change[0] = 2 * after[0] + 1
        level = len(change) - 1 - int(np.argmin(change[::-1]))
        if level == 0:
            number, made = made, made + 1
        else:
            number = holders[level].pop()
            open_at[level] -= 1
        numbers[i], offsets[i] = number, level
        if level + size < window:
            open_at[level + size] += 1
            holders[level + size].append(number)
    return numbers, offsets


def pieces(df: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, full: bool = True, memo: int = MEMO_BYTES) -> DataFrame:
    """The token ids of every whole text and ``end_id``, cut at multiples of ``window``.

    Gives key, start, length, ids_crc32, doc_tokens, and unless ``full=False`` the ``ids`` as little-endian unsigned
    32-bit integers (``id_lists`` makes arrays of them). A null or empty text is the one id ``end_id``. Repeated rows
    stay repeated. ``memo`` bounds, in bytes, each of the two generations of words that a worker remembers.
    """

    def rows(texts: list[str]) -> dict[str, pa.Array]:
        coder = held(("merged", path, memo), lambda: MergedEncoder(path, memo))
        tail = end_id.to_bytes(4, "little")
        parts = []
        for made in coder.encode(texts):
            made += tail
            total = len(made) // 4
            parts.append(
                [
                    (at, min(window, total - at), zlib.crc32(cut := made[4 * at : 4 * (at + window)]), total, cut if full else None)
                    for at in range(0, total, window)
                ]
            )
        flat = [p for own in parts for p in own]
        columns = [pa.array([p[i] for p in flat], pa.int64()) for i in range(4)]
        names = ["start", "length", "ids_crc32", "doc_tokens"]
        if full:
            names.append("ids")
            columns.append(pa.array([p[4] for p in flat], pa.binary()))
        bounds = np.cumsum([0, *map(len, parts)]).astype("int32")
        return {"_piece": pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, names=names))}

    struct = "start: bigint, length: bigint, ids_crc32: bigint, doc_tokens: bigint" + (", ids: binary" if full else "")
    return map_texts(df, [key], text, f"_piece array<struct<{struct}>>", rows).select(key, F.inline("_piece"))


def pack(cut: DataFrame, *, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Give each piece its ``sequence_id`` and ``offset``; other columns stay.

    ``cut`` is read three times (totals, grouping), so pass a written table. Ties in the hash order fall to key,
    start and checksum; fully equal rows are interchangeable. An empty table gives an empty table.
    """
    tokens, count = cut.agg(F.sum("length"), F.count("*")).first()
    groups = max(1, math.ceil((tokens or 0) / (window * GROUP_WINDOWS)), math.ceil(count / GROUP_PIECES))
    spread = F.xxhash64(F.col(key), "start", "ids_crc32", "length")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", key, "start", "ids_crc32"], kind="stable")
        numbers, offsets = sum_of_squares(group["length"].to_numpy(), window)
        base = group["_group"].to_numpy(dtype=np.int64) << 32
        return group.drop(columns=["_group", "_order"]).assign(sequence_id=base + numbers, offset=offsets)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    dealt = cut.withColumn("_order", spread).withColumn("_group", F.pmod("_order", F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(one, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(df: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, full: bool = True, memo: int = MEMO_BYTES) -> DataFrame:
    """Tokenise, cut and pack all rows of ``df``: see ``pieces`` and ``pack``. Only ``key`` and ``text`` are read."""
    made = pieces(df, path, key=key, text=text, window=window, end_id=end_id, full=full, memo=memo)
    cut = written(made.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    placed = pack(cut.drop("ids"), key=key, window=window)
    if full:  # the ids meet their places by a join, so no group holds them in memory
        placed = placed.join(cut.select("_piece", "ids"), "_piece")
    return placed.select(*made.columns, "sequence_id", "offset")


def id_lists(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``ids`` as ``array<int>`` instead of little-endian bytes, for readers that want numbers."""
    kept = [c for c in df.columns if c != ids]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(len(kept)).to_pylist()
            lists = pa.array([None if b is None else np.frombuffer(b, "<u4").astype("int32") for b in raw], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*kept, ids])

    return df.select(*kept, ids).mapInArrow(run, f"{schema}, `{ids}` array<int>")


def digested(df: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with ``ids_crc32`` computed from the ids that ``df`` holds."""
    return df.withColumn("ids_crc32", F.crc32("ids")).select(*keep)
