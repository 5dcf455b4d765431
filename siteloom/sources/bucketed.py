"""Large tables laid out once by their join keys, so that later joins move only the other side.

A bucketed table is Parquet in which every row stands in the bucket its keys hash to. A join on exactly these keys reads
the table bucket by bucket, without an exchange above its scan; the other side is shuffled into as many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` under ``path`` as table ``name``, one sorted file for each bucket, and open it.

    Rows are shuffled here, once for all joins to come. Null keys have a bucket like any other. Choose ``buckets`` so
    that one holds a few hundred MB, and the same number for tables that are joined with each other.
    """
    placed = df.repartition(buckets, *keys)
    placed.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Open a table that another session wrote: ``name`` is declared with its layout if the catalog lacks it."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
