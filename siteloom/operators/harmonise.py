"""Lifted variant rows -> the harmonised summary-statistics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions import alleles

# The output columns in order (uid comes first), and which of them INFO holds as numbers.
HARMONISED = [
    "CHR",
    "POS",
    "ID",
    "REF",
    "ALT",
    "effectAllele",
    "OriginalContig",
    "OriginalStart",
    "SwappedAlleles",
    "effectAllele_pre_swap",
    "beta",
    "SE",
    "pvalue",
    "infoScore",
    "effect_AF",
    "cases_AF",
    "controls_AF",
    "total_N",
    "cases_N",
    "controls_N",
    "snp_N",
    "phenotype",
    "study",
]
FRACTIONS = ["beta", "SE", "pvalue", "infoScore", "effect_AF", "cases_AF", "controls_AF"]
COUNTS = ["OriginalStart", "total_N", "cases_N", "controls_N", "snp_N"]
LABELS = ["effectAllele", "OriginalContig", "phenotype", "study"]
ALLELE_FREQUENCIES = ["effect_AF", "cases_AF", "controls_AF"]
EXACT = "decimal(38,18)"


def drop_alt_contigs(df: DataFrame) -> DataFrame:
    return df.where(~F.col("CHR").contains("_"))


def parse_info(df: DataFrame, exact: bool = False) -> DataFrame:
    """INFO tokens -> columns; an absent key is NULL. Only k=v tokens with one "=" count and the last of a
    repeated key wins. ``SwappedAlleles`` is true where that flag is a token of its own. ``exact`` reads
    effect sizes and frequencies as decimals instead of doubles."""
    staged = (
        df.withColumn("_all", F.split("INFO", ";"))
        .withColumn("_tokens", F.reverse(F.filter("_all", lambda t: F.size(F.split(t, "=")) == 2)))
        .withColumn("_keys", F.transform("_tokens", lambda t: F.substring_index(t, "=", 1)))
        .withColumn("_values", F.transform("_tokens", lambda t: F.substring_index(t, "=", -1)))
    )

    def text(key: str) -> str:
        return f"get(_values, CAST(array_position(_keys, '{key}') - 1 AS INT))"

    number = EXACT if exact else "DOUBLE"
    parsed = {k: F.expr(f"try_cast({text(k)} AS {number})") for k in FRACTIONS}
    parsed |= {k: F.expr(f"CAST(try_cast({text(k)} AS DOUBLE) AS BIGINT)") for k in COUNTS}
    parsed |= {k: F.expr(text(k)) for k in LABELS}
    return (
        staged.withColumns(parsed)
        .withColumn("SwappedAlleles", F.array_contains("_all", "SwappedAlleles"))
        .drop("_all", "_tokens", "_keys", "_values", "INFO")
    )


def swap_fix(df: DataFrame) -> DataFrame:
    """On swapped rows: beta changes sign, frequencies become 1 - f, the effect allele becomes ALT and the
    old one is kept as effectAllele_pre_swap."""
    swapped = F.col("SwappedAlleles")
    flipped = {"beta": 0 - F.col("beta"), "effectAllele": F.col("ALT")}
    flipped |= {c: 1 - F.col(c) for c in ALLELE_FREQUENCIES}
    changed = {c: F.when(swapped, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in flipped.items()}
    return df.withColumn("effectAllele_pre_swap", F.when(swapped, F.col("effectAllele"))).withColumns(changed)


def keep_unmoved_x(df: DataFrame, strict_x: bool = False) -> DataFrame:
    """Drop rows that changed contig and landed on X. A row never lifted has no original contig and is kept,
    unless ``strict_x``."""
    unmoved = F.col("OriginalContig") == F.col("CHR")
    unknown = F.lit(False) if strict_x else F.col("OriginalContig").isNull()
    return df.where((F.col("CHR") != "X") | F.coalesce(unmoved, unknown))


def unique_rows(df: DataFrame, key: str = "uid") -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key goes. ``key="locus"`` compares CHR and POS.

    A counting aggregate, not a window: copies of a crowded key shrink to one row per task before the
    shuffle.
    """
    keys: list[Column | str] = ["CHR", "POS"] if key == "locus" else [key]
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_row"))
        .where(F.col("_n") == 1)
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def format_harmonised(
    df: DataFrame, key: str = "uid", strict_x: bool = False, exact: bool = False
) -> DataFrame:
    """VCF body rows (CHR, POS, ID, REF, ALT, …, INFO) -> uid plus the harmonised columns."""
    chrom = F.get(F.split(F.col("CHR").cast("string"), r"\."), F.lit(0))
    named = (
        df.transform(drop_alt_contigs)
        .transform(parse_info, exact)
        .transform(swap_fix)
        .withColumns({"CHR": chrom, "POS": F.col("POS").cast("double").cast("bigint")})
    )
    with_uid = named.withColumn("uid", alleles.uid(F.col("CHR"), F.col("POS"), F.col("REF"), F.col("ALT")))
    kept = with_uid.select("uid", *HARMONISED).transform(keep_unmoved_x, strict_x)
    return unique_rows(kept, key).select("uid", *HARMONISED)
