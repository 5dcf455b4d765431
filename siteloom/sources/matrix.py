"""The QC'd matrix as two Parquet tables, and the genotype-probability export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteloom.operators.genotypes import explode_entries, genotype_probabilities, mean_impute


def write_table(df: DataFrame, path: str, partition_by: str | None = "contigName") -> None:
    """Parquet, partitioned by contig so that a contig filter reads its own files only.

    Rows are dealt by ranges of contig and position first, so a task writes to one contig or two.
    """
    if not partition_by:
        return df.write.mode("overwrite").parquet(path)
    order = [c for c in (partition_by, "start") if c in df.columns]
    df.repartitionByRange(*order).write.mode("overwrite").partitionBy(partition_by).parquet(path)


def write_matrix(df: DataFrame, path: str, key: str, sample_index=None) -> None:
    """``<path>/sites`` holds a row per site without genotypes, ``<path>/entries`` one per (site, sample)."""
    write_table(df.drop("genotypes"), f"{path}/sites")
    write_table(explode_entries(df, "contigName", "start", key, sample_index=sample_index), f"{path}/entries")


def read_table(spark: SparkSession, path: str, partition_by: str = "contigName") -> DataFrame:
    """Read what ``write_table`` wrote; contig labels stay text, whatever they look like."""
    found = spark.read.parquet(path).schema
    kept = [f if f.name != partition_by else T.StructField(f.name, T.StringType()) for f in found.fields]
    return spark.read.schema(T.StructType(kept)).parquet(path)


def read_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, f"{path}/sites"), read_table(spark, f"{path}/entries")


def probability_rows(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, sampleId, gp[3], dosage): gp from the hard call, dosage mean-imputed."""
    both = df.transform(mean_impute).transform(genotype_probabilities)
    rows = both.select(
        *keys,
        F.explode(
            F.zip_with(
                F.arrays_zip(F.col("genotypes")["sampleId"].alias("sampleId"), "gp"),
                "dosages",
                lambda g, d: F.struct(g["sampleId"].alias("sampleId"), g["gp"].alias("gp"), d.alias("dosage")),
            )
        ).alias("_e"),
    )
    return rows.select(*keys, "_e.*")


def export_probabilities(df: DataFrame, path: str, *keys: str) -> None:
    write_table(probability_rows(df, "contigName", *keys), path)
