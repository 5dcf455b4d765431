"""Two-pass external shuffle into shards, in DataFrame expressions only.

First pass: a seeded hash scatters the whole records uniformly into buckets small enough for a task's memory, by their
summed bytes and by their number. Second pass: each bucket is put into a fixed order and numbered, and a Fisher-Yates
shuffle of these numbers says where each record goes. Only numbers are held as one value, never records, and the sort
spills, so a long text doesn't meet Spark's limit of 2 GB. Many small buckets spread evenly over the tasks. The buckets'
sizes, counted beforehand, say where each bucket begins in the whole order, and the order is cut into shards whose row
counts differ by at most one: the law is ``rows``.

A swap copies the bucket's numbers, so a bucket holds about ``BUCKET_ROWS`` rows. Rows that agree in all their keys and
are more than that are counted, and dealt over several buckets at random.

Source: Rao, "Randomized parallel external permutation".
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteloom.llm.shared import narrow

BUCKET_ROWS = 512
BUCKET_BYTES = 32 << 20
SEED = 20_240_117
# Crowded keys that a broadcast may hold, 16 bytes each.
CROWDS = 100_000


def external_shuffle(
    df: DataFrame, keys: list[str], *, shards: int = 8, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows and columns of ``df`` with ``shard int`` and ``slot long``, gapless from 0 in each shard.

    ``keys`` scatter the rows, and null keys are hashed like values. Rows that agree in all columns are interchangeable.
    Names of ``df`` that start with ``_``, ``shard`` and ``slot`` are refused; an empty table gives an empty result.
    """
    taken = [c for c in df.columns if c.startswith("_") or c in ("shard", "slot")]
    if taken:
        raise ValueError(f"columns {taken} have names that the shuffle uses")
    total, buckets = bucket_count(df, bucket_rows, bucket_bytes)
    scattered = _scattered(df, keys, buckets, seed, bucket_rows)
    sizes = scattered.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    own = Window.partitionBy("_bucket")
    fixed = [F.col(f"`{k}`") for k in [*keys, *[c for c in df.columns if c not in keys]]]
    placed = scattered.withColumn("_at", F.row_number().over(own.orderBy(*fixed)) - 1)
    order = fisher_yates(F.col("_rows").cast("int"), F.lit(seed), F.col("_bucket"))
    # a row of sizes is small and its shuffle is long, so these rows are spread by number and not by bytes
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.join(_begins(sizes).repartition(tasks, "_bucket").withColumn("_order", order), "_bucket")
    shard, slot = cut(F.col("_begin") + F.get("_order", F.col("_at")), total, shards)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], shard.alias("shard"), slot.alias("slot"))


def _scattered(df: DataFrame, keys: list[str], buckets: int, seed: int, bucket_rows: int) -> DataFrame:
    """``df`` with ``_bucket``, by a hash of the keys; of keys with more rows than a bucket also by a random number."""
    named = [F.col(f"`{k}`") for k in keys]
    crowd = F.xxhash64(F.lit(seed), *named)
    crowded = df.select(crowd.alias("_crowd")).groupBy("_crowd").agg(F.count("*").alias("_copies")).where(F.col("_copies") > bucket_rows)
    if crowded.isEmpty():
        return df.withColumn("_bucket", F.pmod(F.xxhash64(crowd, F.lit(0).cast("bigint")), F.lit(buckets)).cast("int"))
    met = df.withColumn("_crowd", crowd).join(narrow(crowded, CROWDS), "_crowd", "left")
    turn = F.when(F.col("_copies").isNull(), F.lit(0).cast("bigint")).otherwise(F.floor(F.rand(seed) * buckets))
    return met.withColumn("_bucket", F.pmod(F.xxhash64("_crowd", turn), F.lit(buckets)).cast("int")).drop("_crowd", "_copies")


def fisher_yates(size: Column, *seeds: Column) -> Column:
    """The numbers below ``size`` as an array, shuffled: from the last place down, each swaps with one up to itself."""

    def swapped(made: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*seeds, i), i + 1).cast("int")
        between = F.slice(made, j + 2, F.greatest(i - j - 1, F.lit(0)))
        rest = F.slice(made, i + 2, size)
        exchanged = F.concat(F.slice(made, F.lit(1), j), F.array(F.get(made, i)), between, F.array(F.get(made, j)), rest)
        return F.when(i == j, made).otherwise(exchanged)

    numbers = F.sequence(F.lit(0), size - 1)
    return F.when(size < 2, numbers).otherwise(F.aggregate(F.sequence(size - 1, F.lit(1), F.lit(-1)), numbers, swapped))


def bucket_count(df: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """The number of rows, and of buckets that hold neither more rows nor more bytes than given, on the average."""
    total, size = df.agg(F.count("*"), F.sum(row_bytes(df))).first()
    return total, max(1, math.ceil(total / bucket_rows), math.ceil((size or 0) / bucket_bytes))


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts and binaries by length, nested values by their text, others 8."""

    def one(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = value.cast("string")
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.lit(8)
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8

    return sum((one(f).cast("bigint") for f in df.schema.fields), F.lit(0).cast("bigint"))


def _begins(sizes: DataFrame, span: int = 4096) -> DataFrame:
    """Where each bucket begins: sums inside runs of ``span`` buckets, and one row a run before them."""
    runs = sizes.withColumn("_run", F.floor(F.col("_bucket") / span))
    inside = Window.partitionBy("_run").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = runs.withColumn("_in", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    totals = runs.groupBy("_run").agg(F.sum("_rows").alias("_sum"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_run", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    return within.join(F.broadcast(starts), "_run").select("_bucket", "_rows", (F.col("_base") + F.col("_in")).alias("_begin"))


def cut(number: Column, total: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of the ``number``-th row: the first ``total mod shards`` shards hold one row more."""
    least, longer = divmod(total, shards)
    edge = longer * (least + 1)
    low = number < F.lit(edge)
    long_shard = F.floor(number / (least + 1))
    rest = number - F.lit(edge)
    width = max(1, least)
    shard = F.when(low, long_shard).otherwise(F.floor(rest / width) + longer).cast("int")
    slot = F.when(low, number - long_shard * (least + 1)).otherwise(F.pmod(rest, F.lit(width))).cast("bigint")
    return shard, slot


def write_shards(df: DataFrame, keys: list[str], path: str, *, shards: int = 8, seed: int = SEED) -> None:
    """Write the shuffled records, one folder a shard; a bucket's rows go to at most a few shards, in slot order."""
    made = external_shuffle(df, keys, shards=shards, seed=seed)
    made.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
