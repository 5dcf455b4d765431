"""Study metadata and summary-statistics tables in, harmonised tables out."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.operators.sumstats import MAPPED, STUDY_COUNTS, Study
from siteloom.session import small_side

HEADER_READERS = 16  # headers read at the same time


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The study metadata CSV, every column as text; blanks are NULL."""
    return spark.read.csv(path, header=True)


def study_row(metadata: DataFrame, phenotype_file: str) -> DataFrame:
    """The metadata rows of one input file."""
    return metadata.where(F.col("phenotype_file") == phenotype_file)


def find_study(metadata: DataFrame, phenotype_file: str) -> Study:
    """The one study of an input file; ValueError when there is none or more than one."""
    rows = study_row(metadata, phenotype_file).limit(2).collect()
    if not rows:
        raise ValueError(f"no metadata row for {phenotype_file!r}: check the file name")
    if len(rows) > 1:
        raise ValueError(f"several metadata rows for {phenotype_file!r}: check the metadata")
    return Study.from_row(rows[0])


def write_params(metadata: DataFrame, phenotype_file: str, path: str) -> None:
    """Record the chosen metadata row as TSV."""
    study_row(metadata, phenotype_file).write.mode("overwrite").csv(path, sep="\t", header=True)


def read_summary_stats(spark: SparkSession, path: str, study: Study, sep: str = "\t") -> DataFrame:
    """The mapped columns of a summary-statistics file, as text under their source names."""
    table = spark.read.csv(path, sep=sep, header=True)
    return table.select(*[F.col(f"`{source}`") for source in dict.fromkeys(study.columns.values())])


def find_studies(metadata: DataFrame, phenotype_files: Sequence[str]) -> dict[str, Study]:
    """The one study of each input file, from one read; ValueError where there is none or more than one."""
    found: dict[str, list] = {name: [] for name in phenotype_files}
    for row in metadata.where(F.col("phenotype_file").isin(*found)).collect():
        found[row["phenotype_file"]].append(row)
    wrong = {name: len(rows) for name, rows in found.items() if len(rows) != 1}
    if wrong:
        raise ValueError(f"not one metadata row for each file, but {wrong}: check the file names and the metadata")
    return {name: Study.from_row(rows[0]) for name, rows in found.items()}


def read_studies(spark: SparkSession, paths: Sequence[str], metadata: DataFrame, sep: str = "\t") -> DataFrame:
    """Summary-statistics files of many studies, read together.

    The last part of each path is the study's ``phenotype_file``: a file or a folder of files, which may be named
    ``key=phenotype_file``. Files may differ in columns and their order. Gives ``phenotype_file``, all canonical
    columns as source text (NULL where the study maps none), ``mapped_columns``, the study's counts, names and build.

    Only the headers are read file by file. A row finds its study through the path of its file; the table of studies
    is counted before it is broadcast. Only columns that some study maps leave the scan.
    """
    names = [path.rstrip("/").rsplit("/", 1)[-1] for path in paths]
    files = [name.split("=", 1)[-1] for name in names]
    if len(set(names)) < len(names):
        raise ValueError("several paths end in one name, so their rows could not be told apart")
    studies = find_studies(metadata, files)
    with ThreadPool(HEADER_READERS) as pool:
        headers = pool.map(lambda path: spark.read.csv(path, sep=sep, header=True).columns, paths)
    held = []
    for name, file, header in zip(names, files, headers):
        study = studies[file]
        lacking = [source for source in study.columns.values() if source not in header]
        if lacking:
            raise ValueError(f"{file!r} has no columns {lacking}")
        place = [header.index(study.columns[c]) if c in study.columns else -1 for c in MAPPED]
        held.append((name, file, place, list(study.columns), *[study.counts[c] for c in STUDY_COUNTS], study.study, study.phenotype, study.build))
    used = sorted({at for row in held for at in row[2]} - {-1})
    held = [(row[0], row[1], [used.index(at) if at >= 0 else -1 for at in row[2]], *row[3:]) for row in held]
    kind = "_name string, phenotype_file string, _place array<int>, mapped_columns array<string>, "
    kind += ", ".join(f"{c} bigint" for c in STUDY_COUNTS) + ", study string, phenotype string, build string"
    table = small_side(spark.createDataFrame(held, kind))

    wide = ", ".join(f"c{i} string" for i in range(max(map(len, headers))))
    rows = spark.read.csv(list(paths), schema=wide, sep=sep, header=True, enforceSchema=True)
    way = F.split("_metadata.file_path", "/")
    # a path is given with its special characters escaped; file names come before the names of folders
    last, folder = (F.call_function("try_url_decode", F.replace(F.element_at(way, F.lit(i)), F.lit("+"), F.lit("%2B"))) for i in (-1, -2))
    own = rows.select(F.array(*[f"c{i}" for i in used]).alias("_cells"), F.when(last.isin(*names), last).otherwise(folder).alias("_name"))
    cells = [F.get("_cells", F.get("_place", F.lit(i))).alias(c) for i, c in enumerate(MAPPED)]
    return own.join(table, "_name").select("phenotype_file", *cells, "mapped_columns", *STUDY_COUNTS, "study", "phenotype", "build")


def write_harmonised(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)
