"""Annotation: external command over site rows, its text output, and the dimension tables."""

from __future__ import annotations

import shlex
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.functions import alleles
from siteloom.operators.csq import MISSENSE_KEYS, prepare_missense, prepare_transcripts
from siteloom.sources.bucketed import write_bucketed
from siteloom.sources.vcf import SITES_HEADER, body_lines


def pipe_sites(
    df: DataFrame, command: str, header: Sequence[str] = SITES_HEADER, partitions: int | None = None
) -> DataFrame:
    """Stream VCF body rows through a shell command, one process per partition: text lines out.

    Rows are range-partitioned and sorted by contig and position (then alleles, so that a crowded position
    spreads over several processes), and every process reads the header first.
    This is Spark's own script transform, so lines never pass through Python.
    """
    order = ["CHR", "POS", "REF", "ALT"]
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    lines = body_lines(spread.sortWithinPartitions(*order))
    printed = " ".join(shlex.quote(line) for line in header)
    script = f"(printf '%s\\n' {printed}; cat) | {command}" if header else command
    quoted = script.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(
        "SELECT TRANSFORM(value) ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\u0001' "
        f"USING '{quoted}' AS (text STRING) ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\u0001' FROM {{lines}}",
        lines=lines,
    )


def parse_annotated_text(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """Annotated VCF lines -> CHR, POS, REF, ALT, INFO, csqs, uid; only lines that carry consequences."""
    part = F.split(text_col, "\t")
    rows = lines.where(~F.col(text_col).startswith("#")).select(
        F.get(part, F.lit(0)).alias("CHR"),
        F.get(part, F.lit(1)).cast("bigint").alias("POS"),
        F.get(part, F.lit(3)).alias("REF"),
        F.get(part, F.lit(4)).alias("ALT"),
        F.get(part, F.lit(7)).alias("INFO"),
    )
    csq = F.regexp_extract("INFO", r"(?:^|;)CSQ=([^;]*)", 1)
    return (
        rows.withColumn("csqs", F.nullif(csq, F.lit("")))
        .where(F.col("csqs").isNotNull())
        .withColumn("uid", alleles.uid(F.col("CHR"), F.col("POS"), F.col("REF"), F.col("ALT")))
    )


def load_missense(spark: SparkSession, path: str) -> DataFrame:
    return prepare_missense(spark.read.parquet(path))


def store_missense(missense: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Lay the prepared missense table out by the keys that annotation joins it on; ``annotate`` then leaves it in place."""
    return write_bucketed(missense, name, path, MISSENSE_KEYS, buckets)


def load_transcripts(spark: SparkSession, path: str) -> DataFrame:
    return prepare_transcripts(spark.read.parquet(path))


def load_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
