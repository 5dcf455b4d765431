"""Association summary statistics: rename, clean and write out as variant rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from siteloom.functions import alleles
from siteloom.functions.funnel import funnel
from siteloom.functions.once import compute_once

# Canonical columns a study may map, per-study constants, and the INFO keys in order.
MAPPED = [
    "CHR",
    "POS",
    "ID",
    "otherAllele",
    "effectAllele",
    "SE",
    "beta",
    "pvalue",
    "infoScore",
    "effect_AF",
    "cases_AF",
    "controls_AF",
    "snp_N",
]
STUDY_COUNTS = ["total_N", "cases_N", "controls_N"]
STUDY_NAMES = ["phenotype", "study"]
INFO_KEYS = MAPPED[4:] + STUDY_COUNTS + STUDY_NAMES
TEXT_COLUMNS = ("CHR", "ID", "otherAllele", "effectAllele")

# Numbers that mark a missing value, and texts the reader takes as missing.
MISSING_NUMBERS = (-99, -999)
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Default thresholds.
MIN_AF, MAX_AF = 0.001, 0.999
MIN_CASE_COUNT = 25
MIN_INFO = 0.3


@dataclass(frozen=True)
class Study:
    """One metadata row: canonical -> source column names, counts, labels and genome build."""

    study: str
    phenotype: str
    build: str | None = None
    columns: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)

    @classmethod
    def from_row(cls, row: Row) -> Study:
        values = row.asDict()
        columns = {c: values[c] for c in MAPPED if values.get(c) not in (None, "", "NA")}
        counts = {c: values.get(c) for c in STUDY_COUNTS}
        counts = {c: None if v in (None, "") else int(float(v)) for c, v in counts.items()}
        return cls(values["study"], values["phenotype"], values.get("build"), columns, counts)


def canonical_value(column: Column, name: str, kind: str = "string") -> Column:
    """A source column of Spark type ``kind`` as canonical column ``name``: missing markers -> NULL, numbers cast."""
    missing = F.coalesce(column.try_cast("double").isin(*MISSING_NUMBERS), F.lit(False))
    if kind == "string":
        missing = missing | column.isin(*MISSING_TEXTS)
    target = "string" if name in TEXT_COLUMNS else "double"
    typed = column if kind == target else column.cast(target)
    return F.when(~missing, typed.cast("bigint") if name == "POS" else typed).alias(name)


def rename_columns(df: DataFrame, study: Study) -> DataFrame:
    """Source columns -> canonical ones, missing markers -> NULL, numbers cast, study constants added."""
    types = dict(df.dtypes)
    return df.select(
        *[canonical_value(F.col(f"`{source}`"), name, types[source]) for name, source in study.columns.items()],
        *[F.lit(study.counts[c]).cast("bigint").alias(c) for c in STUDY_COUNTS],
        F.lit(study.study).alias("study"),
        F.lit(study.phenotype).alias("phenotype"),
    )


def qc_filters(columns, filter_cases_af: bool = False) -> dict:
    """The row filters by name, in order, over canonical columns; optional ones only where mapped."""
    filters = {
        "acgt": alleles.acgt_only(F.col("otherAllele")) & alleles.acgt_only(F.col("effectAllele")),
        "effect_known": F.col("beta").isNotNull() & F.col("SE").isNotNull(),
    }
    if "effect_AF" in columns:
        filters["effect_AF"] = F.col("effect_AF").between(MIN_AF, MAX_AF)
    if "cases_AF" in columns:
        if filter_cases_af:
            filters["cases_AF"] = F.col("cases_AF").between(MIN_AF, MAX_AF)
        filters["case_count"] = F.col("cases_AF") * F.col("cases_N") * 2 > MIN_CASE_COUNT
    if "infoScore" in columns:
        filters["infoScore"] = F.col("infoScore") > MIN_INFO
    return filters


def upper_alleles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in ("otherAllele", "effectAllele")})


def canonical_rows(df: DataFrame, study: Study) -> DataFrame:
    """Source rows -> canonical rows with upper-case alleles, before any filter."""
    renamed = df.transform(rename_columns, study).transform(upper_alleles)
    return compute_once(renamed, {c: F.col(c) for c in study.columns})


def qc_summary_stats(df: DataFrame, study: Study, filter_cases_af: bool = False) -> DataFrame:
    """Source rows of one study -> clean canonical rows; one projection and one fused filter."""
    kept = canonical_rows(df, study)
    for condition in qc_filters(study.columns, filter_cases_af).values():
        kept = kept.filter(condition)
    return kept


def summary_funnel(df: DataFrame, study: Study, filter_cases_af: bool = False) -> DataFrame:
    """Rows read in and left after each filter, counted in one pass: (step_no, step, n_rows)."""
    return funnel(canonical_rows(df, study), qc_filters(study.columns, filter_cases_af))


def canonical_studies(df: DataFrame) -> DataFrame:
    """Rows of many studies (``sources.sumstats.read_studies``) -> canonical rows, before any filter.

    Columns that a row's study does not map are NULL and not in its ``mapped_columns``.
    """
    others = [c for c in df.columns if c not in MAPPED]
    renamed = df.select(*others, *[canonical_value(F.col(c), c) for c in MAPPED]).transform(upper_alleles)
    return compute_once(renamed, {c: F.col(c) for c in MAPPED})


def studies_filters(filter_cases_af: bool = False) -> dict:
    """The row filters by name; each passes the rows of studies that lack its column."""
    source = {"case_count": "cases_AF"}
    unmapped = {c: ~F.array_contains("mapped_columns", c) for c in ("effect_AF", "cases_AF", "infoScore")}
    filters = qc_filters(MAPPED, filter_cases_af)
    return {n: unmapped.get(source.get(n, n), F.lit(False)) | condition for n, condition in filters.items()}


def qc_studies(df: DataFrame, filter_cases_af: bool = False) -> DataFrame:
    """Rows of many studies -> clean canonical rows: one plan, whatever the number of studies."""
    kept = canonical_studies(df)
    for condition in studies_filters(filter_cases_af).values():
        kept = kept.filter(condition)
    return kept


def studies_funnel(df: DataFrame, filter_cases_af: bool = False) -> DataFrame:
    """(phenotype_file, step_no, step, n_rows) of all studies in one pass; steps that a study lacks keep its count."""
    return funnel(canonical_studies(df), studies_filters(filter_cases_af), by=("phenotype_file",))


def info_text(df: DataFrame) -> DataFrame:
    """``INFO``: k=v over the present columns in fixed order; a NULL prints ".".

    In rows of many studies, columns that the row's study does not map are left out.
    """
    of_many = "mapped_columns" in df.columns

    def token(key: str) -> Column:
        text = F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit(".")))
        return F.when(F.array_contains("mapped_columns", key), text) if of_many and key in MAPPED else text

    return df.withColumn("INFO", F.concat_ws(";", *[token(k) for k in INFO_KEYS if k in df.columns]))


def to_vcf_rows(df: DataFrame) -> DataFrame:
    """Canonical rows -> the eight text columns of a sites-only VCF body."""
    return df.transform(info_text).select(
        "CHR",
        "POS",
        F.coalesce("ID", F.lit(".")).alias("ID") if "ID" in df.columns else F.lit(".").alias("ID"),
        F.col("otherAllele").alias("REF"),
        F.col("effectAllele").alias("ALT"),
        F.lit(".").alias("QUAL"),
        F.lit(".").alias("FILTER"),
        "INFO",
    )
