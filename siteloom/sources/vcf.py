"""Variant text files (plain or gzip) as DataFrames, and back."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.functions import alleles
from siteloom.functions.once import compute_once

# The leading columns of a variant line, and the header of a sites-only file.
SITE_COLUMNS = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]
SITES_HEADER = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
FIRST_SAMPLE = 9


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One string column ``value``; a gzip file is one task, so spread its lines with repartition."""
    return spark.read.text(path)


def data_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))


@dataclass(frozen=True)
class Header:
    """What the meta lines say: samples in column order, contig lengths, and (number, type) of FORMAT fields."""

    samples: list[str]
    contigs: dict[str, int] = field(default_factory=dict)
    formats: dict[str, tuple[str, str]] = field(default_factory=dict)


def read_header(lines: DataFrame, check_all: bool = True) -> Header:
    """One scan for the #CHROM, ##contig and ##FORMAT lines of all files, equal ones counted once.

    With ``check_all`` all files must agree about their sample columns, so that a genotype's place in the array names
    the same sample in every row. The first of several lengths or types of one name counts, in text order.
    """
    wanted = F.col("value").startswith("#CHROM") | F.col("value").startswith("##contig=") | F.col("value").startswith("##FORMAT=")
    found = sorted(r["value"].rstrip("\r") for r in lines.where(wanted).select("value").distinct().collect())
    columns = [text for text in found if text.startswith("#CHROM")]
    if not columns:
        raise ValueError("no #CHROM header line found")
    if check_all and len(set(columns)) > 1:
        raise ValueError("files disagree about their sample columns")
    contigs, formats = {}, {}
    for text in found:
        name, length = re.search(r"[<,]ID=([^,>]+)", text), re.search(r"[<,]length=(\d+)", text)
        number, kind = re.search(r"[<,]Number=([^,>]+)", text), re.search(r"[<,]Type=([^,>]+)", text)
        if text.startswith("##contig=") and name and length:
            contigs.setdefault(name[1], int(length[1]))
        elif text.startswith("##FORMAT=") and name and number and kind:
            formats.setdefault(name[1], (number[1], kind[1]))
    return Header(columns[0].split("\t")[FIRST_SAMPLE:], contigs, formats)


def sample_names(lines: DataFrame, check_all: bool = True) -> list[str]:
    """Sample names from the #CHROM line: see ``read_header``."""
    return read_header(lines, check_all).samples


# FORMAT fields that a genotype holds under a name of its own, and the declared types.
CORE_FORMAT = ("GT", "DP", "GQ", "AD")
SQL_TYPES = {"Integer": "int", "Float": "double"}


def _typed(text: Column, number: str, kind: str) -> Column:
    """One FORMAT value as declared: a scalar for Number=1, else an array; "." and unreadable values are NULL."""

    def one(value: Column) -> Column:
        return value.try_cast(SQL_TYPES[kind]) if kind in SQL_TYPES else F.nullif(value, F.lit("."))

    return one(text) if number == "1" else F.when(text != ".", F.transform(F.split(text, ","), one))


def _integer(text: Column) -> Column:
    return text.try_cast("int")


def info_map(info: Column) -> Column:
    """INFO text -> map; a flag maps to NULL and the first of a repeated key wins."""
    tokens = F.split(info, ";")
    key = lambda token: F.substring_index(token, "=", 1)

    def entry(k: Column) -> Column:
        token = F.get(F.filter(tokens, lambda t: key(t) == k), F.lit(0))
        text = F.substring(token, F.length(k) + 2, F.length(token))
        return F.struct(k.alias("key"), F.when(token.contains("="), text).alias("value"))

    return F.map_from_entries(F.transform(F.array_distinct(F.transform(tokens, key)), entry))


def parse_sites(lines: DataFrame) -> DataFrame:
    """Data lines -> the eight leading columns; CHR without renaming, 1-based POS."""
    part = F.split("value", "\t")
    names = ["CHR", *SITE_COLUMNS[1:]]
    columns = [F.get(part, F.lit(i)).alias(n) for i, n in enumerate(names)]
    columns[1] = F.get(part, F.lit(1)).try_cast("double").cast("bigint").alias("POS")
    return data_lines(lines).select(*columns)


def parse_pvcf(lines: DataFrame, samples: list[str], formats: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Data lines -> population site rows. INFO stays unflattened as the ``attributes`` map.

    FORMAT keys are looked up per line, so their order may vary; an absent or "." value, also inside an
    allele-depth list, is NULL and a missing allele is -1. Each field of ``formats`` (name -> declared number and
    type, see ``read_header``) beside GT, DP, GQ and AD becomes a field of that name in the genotype.
    """
    extra = {k: v for k, v in (formats or {}).items() if k not in CORE_FORMAT}
    # bound row by row: in a lambda the planner would split the line again for each genotype
    fields = compute_once(data_lines(lines), {"_f": F.split("value", "\t")}).select("_f")
    fields = compute_once(fields, {"_format": F.split(F.get("_f", F.lit(8)), ":")})
    names = F.split(F.lit("\t".join(samples)), "\t")
    place = {f"_at_{k}": (F.array_position("_format", k) - 1).cast("int") for k in (*CORE_FORMAT, *extra)}
    staged = compute_once(fields, place)

    def value(parts: Column, key: str) -> Column:
        return F.get(parts, F.col(f"`_at_{key}`"))

    def genotype(pair: Column) -> Column:
        parts = pair["v"]
        gt = value(parts, "GT")
        calls = F.transform(F.split(gt, r"[/|]"), lambda a: F.coalesce(_integer(a), F.lit(-1)))
        return F.struct(
            F.coalesce(calls, F.array(F.lit(-1), F.lit(-1))).alias("calls"),
            pair["s"].alias("sampleId"),
            F.coalesce(F.contains(gt, F.lit("|")), F.lit(False)).alias("phased"),
            _integer(value(parts, "DP")).alias("depth"),
            _integer(value(parts, "GQ")).alias("conditionalQuality"),
            F.transform(F.split(value(parts, "AD"), ","), _integer).alias("alleleDepths"),
            *[_typed(value(parts, k), *declared).alias(k) for k, declared in extra.items()],
        )

    texts = F.slice("_f", FIRST_SAMPLE + 1, max(len(samples), 1))
    zipped = F.zip_with(texts, names, lambda v, s: F.struct(F.split(v, ":").alias("v"), s.alias("s")))
    genotypes = F.transform(zipped if samples else F.slice(zipped, 1, 0), genotype)
    start = F.get("_f", F.lit(1)).cast("bigint") - 1
    ref = F.get("_f", F.lit(3))
    rows = staged.select(
        F.get("_f", F.lit(0)).alias("contigName"),
        start.alias("start"),
        (start + F.length(ref)).alias("end"),
        ref.alias("referenceAllele"),
        F.split(F.get("_f", F.lit(4)), ",").alias("alternateAlleles"),
        F.split(F.get("_f", F.lit(6)), ";").alias("filters"),
        F.get("_f", F.lit(5)).try_cast("double").alias("qual"),
        info_map(F.get("_f", F.lit(7))).alias("attributes"),
        "_f",
        *[f"`{c}`" for c in place],
    )
    return compute_once(rows, {"genotypes": genotypes}).drop("_f", *place)


def read_pvcf(spark: SparkSession, path: str, check_headers: bool = True, partitions: int | None = None) -> DataFrame:
    """Population variant text under ``path`` -> site rows with nested genotypes; ``partitions`` for gzip input.

    All FORMAT fields that the header declares are kept, typed as declared.
    """
    lines = read_lines(spark, path)
    header = read_header(lines, check_headers)
    return parse_pvcf(lines.repartition(partitions) if partitions else lines, header.samples, header.formats)


# Fixed value: names of the assembly's alternate, decoy, unplaced and patch contigs.
EXTRA_CONTIG = r"^(chr[0-9A-Za-z]+_[A-Z]{2,6}[0-9]+v[0-9]+(_random|_alt|_decoy|_fix)?|chrEBV|HLA-.+)$"


def valid_loci(df: DataFrame, lengths: dict[str, int] | None = None) -> DataFrame:
    """Recode bare contig labels to chr-prefixed ones; keep positions that exist in the assembly.

    ``lengths`` adds contigs (as ``read_header`` reads them). An alternate, decoy or unplaced contig of the
    assembly whose length isn't given is known by its name, and any position from 0 on is kept.
    """
    recoded = df.withColumn("contigName", alleles.add_contig_prefix(F.col("contigName")))
    length = alleles.contig_length(F.col("contigName"), lengths)
    named = length.isNull() & F.col("contigName").rlike(EXTRA_CONTIG)
    return recoded.where((F.col("start") >= 0) & (named | (F.col("start") < length)))


def import_vcf(
    spark: SparkSession, path: str, partitions: int | None = None, lengths: dict[str, int] | None = None
) -> DataFrame:
    """read_pvcf with recoded contigs and invalid loci skipped; give ``partitions`` for gzip input.

    Contigs that the text's own header declares are known too, unless ``lengths`` is given.
    """
    lines = read_lines(spark, path)
    header = read_header(lines)
    rows = parse_pvcf(lines.repartition(partitions) if partitions else lines, header.samples, header.formats)
    return valid_loci(rows, header.contigs if lengths is None else lengths)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """A sites-only variant file: CHR, POS, ID, REF, ALT, QUAL, FILTER, INFO."""
    return parse_sites(read_lines(spark, path))


def body_lines(df: DataFrame, *keep: Column) -> DataFrame:
    """VCF body rows -> one tab-separated ``value`` each, after the ``keep`` columns."""
    text = F.concat_ws("\t", *[F.col(c).cast("string") for c in ["CHR", *SITE_COLUMNS[1:]]])
    return df.select(*keep, text.alias("value"))


def write_sites(df: DataFrame, path: str, header: list[str] | None = None) -> None:
    """Write VCF body rows as text sorted by contig and position.

    The part files, concatenated in name order, are one valid file: the header sorts before every row and
    so opens the first part. The line itself ends the sort key, so a crowded position can be cut into
    several parts.
    """
    top = df.sparkSession.createDataFrame(
        [(None, i, text) for i, text in enumerate(header or SITES_HEADER)], "_c string, _p bigint, value string"
    )
    lines = body_lines(df, F.col("CHR").alias("_c"), F.col("POS").alias("_p"))
    order = [F.asc_nulls_first("_c"), F.asc("_p"), F.asc("value")]
    placed = top.unionByName(lines).repartitionByRange(*order).sortWithinPartitions(*order)
    placed.select("value").write.mode("overwrite").text(path)
