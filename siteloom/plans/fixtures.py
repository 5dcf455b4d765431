"""Variant-shaped inputs derived from the given tables by integer arithmetic (see FIXTURES.md).

Everything is a lazy plan over the parquet tables, so each fixture grows with them. Multi-allelic depth
arrays carry one value per allele: an allele held c times by a call of depth d gets d*c div 2 reads and
the reference gets the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.session import small_side

# The fixture's reference sequence repeats with this period on every contig.
REFERENCE_PERIOD = 52
CHUNK = 10_000

TERM_CYCLE = [
    "stop_gained",
    "frameshift_variant",
    "splice_donor_variant",
    "splice_acceptor_variant",
    "stop_lost",
    "start_lost",
    "missense_variant",
    "inframe_insertion",
    "inframe_deletion",
    "splice_region_variant",
    "synonymous_variant",
    "start_retained_variant",
    "stop_retained_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "intron_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "regulatory_region_variant",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than the session has cores one partition per core; leave others alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def label(key: str) -> str:
    """SQL text of the contig label of an integer key."""
    return f"CASE ({key}) % 24 WHEN 0 THEN 'X' WHEN 23 THEN 'Y' ELSE CAST(({key}) % 24 AS STRING) END"


def letter(key: str) -> str:
    return f"substr('ACGT', CAST(({key}) % 4 AS INT) + 1, 1)"


def base(pos: str) -> str:
    """SQL text of the reference base at a 1-based position."""
    return letter(f"({pos}) * 7 + ({pos}) div 13")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").selectExpr("p_partkey AS sid", "p_size")
    return part.selectExpr(
        "sid",
        f"concat('chr', {label('sid')}) AS contigName",
        "sid * 1000 AS start",
        "sid * 1000 + 1 AS POS",
        "IF(p_size % 10 = 0, 2, 1) AS n_alt",
        f"{letter('sid')} AS ref",
        f"concat({letter('sid + 1')}, IF(p_size % 7 = 0, 'TT', '')) AS alt1",
        f"{letter('sid + 2')} AS alt2",
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (site, sample): a1, a2 (-1 missing), dp and the per-allele depths."""
    grouped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("sid"), F.col("l_suppkey").alias("s"))
        .agg(
            F.min(F.expr("l_orderkey * 10 + l_linenumber")).alias("k"),
            F.min("l_quantity").cast("int").alias("dp"),
        )
    )
    n_alt = table(spark, sf_dir, "part").selectExpr("p_partkey AS sid", "IF(p_size % 10 = 0, 2, 1) AS n_alt")
    carried = "(sid * 7) % 100"
    return grouped.join(n_alt, "sid").selectExpr(
        "sid",
        "s",
        "k",
        "dp",
        "n_alt",
        f"""CASE WHEN (k * 7 + s) % 29 = 0 THEN -1
                 WHEN (k * 31 + s * 7) % 100 < {carried} THEN 1 ELSE 0 END AS a1""",
        f"""CASE WHEN (k * 7 + s) % 29 IN (0, 1) THEN -1
                 WHEN (k * 17 + s * 13) % 100 < {carried} THEN IF(n_alt = 2 AND k % 3 = 0, 2, 1)
                 ELSE 0 END AS a2""",
    )


def pvcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population rows: one per site with its genotypes sorted by sample number."""
    reads = "dp * (CAST(a1 = {i} AS INT) + CAST(a2 = {i} AS INT)) div 2"
    genotype = f"""struct(
        s AS sample_no,
        array(a1, a2) AS calls,
        CAST(s AS STRING) AS sampleId,
        k % 2 = 0 AS phased,
        dp AS depth,
        CAST(k % 99 AS INT) AS conditionalQuality,
        CASE WHEN a1 < 0 OR a2 < 0 THEN NULL
             WHEN n_alt = 1 THEN array(CAST(dp - {reads.format(i=1)} AS INT), CAST({reads.format(i=1)} AS INT))
             ELSE array(CAST(dp - {reads.format(i=1)} - {reads.format(i=2)} AS INT),
                        CAST({reads.format(i=1)} AS INT), CAST({reads.format(i=2)} AS INT)) END AS alleleDepths
    )"""
    called = (
        entries(spark, sf_dir).groupBy("sid").agg(F.sort_array(F.collect_list(F.expr(genotype))).alias("genotypes"))
    )
    return (
        sites(spark, sf_dir)
        .join(called, "sid")
        .selectExpr(
            "sid",
            "contigName",
            "start",
            "start + length(ref) AS end",
            "ref AS referenceAllele",
            "IF(n_alt = 2, array(alt1, alt2), array(alt1)) AS alternateAlleles",
            "array('PASS') AS filters",
            "CAST(sid % 60 AS DOUBLE) AS qual",
            "map('SID', CAST(sid AS STRING)) AS attributes",
            "transform(genotypes, g -> struct(g.calls, g.sampleId, g.phased, g.depth, g.conditionalQuality,"
            " g.alleleDepths)) AS genotypes",
        )
    )


# The meta lines of the fixture's text.
META_LINES = [
    "##fileformat=VCFv4.2",
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Quality">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Likelihoods">',
    '##FORMAT=<ID=AB,Number=1,Type=Float,Description="Balance">',
    '##FORMAT=<ID=FT,Number=1,Type=String,Description="Filter">',
]


def write_pvcf_text(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Population text of all entries: the r-th entry of a site, by sample number, stands in sample column r."""
    high, low = "greatest(a1, a2)", "least(a1, a2)"
    place = f"{high} * ({high} + 1) div 2 + {low}"
    values = f"transform(sequence(0, (n_alt + 1) * (n_alt + 2) div 2 - 1), i -> CAST(IF(i = {place}, 0, (k * 7 + i * 13) % 60 + 1) AS STRING))"
    cell = f"""concat_ws(':', concat(IF(a1 < 0, '.', CAST(a1 AS STRING)), IF(k % 2 = 0, '|', '/'), IF(a2 < 0, '.', CAST(a2 AS STRING))), CAST(dp AS STRING),
        CAST(k % 50 AS STRING), IF({low} < 0, '.', array_join({values}, ',')), CAST((k % 8) / 8 AS STRING), IF(k % 5 = 0, '.', concat('f', k % 5)))"""
    held = entries(spark, sf_dir).selectExpr("sid", f"struct(s, {cell} AS cell) AS held").groupBy("sid")
    rows = held.agg(F.sort_array(F.collect_list("held")).alias("cells")).selectExpr("sid", "cells.cell AS cells", "size(cells) AS n")
    rows.write.parquet(f"{path}-cells")  # the number of sample columns comes from the data
    rows = spark.read.parquet(f"{path}-cells")
    width = rows.agg(F.max("n")).first()[0] or 0
    body = sites(spark, sf_dir).join(rows, "sid").selectExpr(
        r"""concat_ws('\t', contigName, POS, '.', ref, IF(n_alt = 2, concat(alt1, ',', alt2), alt1), '.', 'PASS', concat('SID=', sid), 'GT:DP:GQ:PL:AB:FT',"""
        + rf""" array_join(concat(cells, array_repeat('./.', {width} - n)), '\t')) AS value"""
    )
    columns = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *[f"s{i}" for i in range(width)]])
    top = spark.createDataFrame([(text,) for text in [*META_LINES, columns]], "value string")
    top.coalesce(1).unionByName(body).write.text(path)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey AS k", "c_nationkey AS n")
        .selectExpr(
            f"{label('k')} AS CHR",
            "k * 1300 AS featureStart",
            "k * 1300 + 2000 + (k % 7) * 1000 AS featureEnd",
            "concat('ENSG', k) AS geneId",
            "concat('G', k) AS GeneName",
            "IF(n % 3 = 0, 'protein_coding', 'lncRNA') AS biotype",
        )
    )


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-only rows, one for each alternate: sid, uid, CHR, POS, REF, ALT."""
    alternates = sites(spark, sf_dir).selectExpr(
        "sid", "substr(contigName, 4) AS CHR", "POS", "ref AS REF", "explode(IF(n_alt = 2, array(alt1, alt2), array(alt1))) AS ALT"
    )
    return alternates.selectExpr("sid", "concat_ws(':', CHR, CAST(POS AS STRING), REF, ALT) AS uid", "CHR", "POS", "REF", "ALT")


def csq_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant rows with the raw consequence text ``csqs`` (1 to 3 records)."""
    terms = "array(" + ", ".join(f"'{t}'" for t in TERM_CYCLE) + ")"
    tx, cp = "(gene * 3 + j)", "((sid * 13) % (300 + gene * 3) + 1)"
    record = f"""concat_ws('|',
        ALT,
        concat(get({terms}, CAST((sid * 5 + j * 7) % 19 AS INT)),
               IF(sid % 4 = 0, concat('&', get({terms}, CAST((sid + j) % 19 AS INT))), '')),
        'MODIFIER', concat('G', gene), concat('ENSG', gene), 'Transcript', concat('ENST', {tx}), 'protein_coding',
        IF(j = 0, concat(sid % 9 + 1, '/10'), ''),
        IF(j = 1, concat(sid % 8 + 1, '/9'), ''),
        IF(sid % 10 = 9, '', concat('ENST', {tx}, ':c.', {cp}, IF(sid % 2 = 0, '+2C>T', 'A>G'))),
        IF(j = 0, concat('ENSP', {tx}, ':p.', ({cp} + 2) div 3), ''),
        '',
        CASE WHEN sid % 50 = 7 THEN '?' WHEN sid % 6 = 5 THEN concat({cp}, '-', {cp} + 1)
             WHEN sid % 11 = 3 THEN '' ELSE CAST({cp} AS STRING) END,
        IF(j = 2, '', CAST(({cp} + 2) div 3 AS STRING)),
        '', '', '', '', '', '', '', '',
        IF({tx} % 3 = 0, 'YES', ''),
        IF({tx} % 3 = 0, concat('NM_', {tx}), ''))"""
    return (
        spread(variants(spark, sf_dir))
        .withColumn("gene", F.expr("(sid % 24) * 10 + (sid div 24) % 10"))
        .withColumn(
            "csqs", F.expr(f"array_join(transform(sequence(0, CAST(sid % 3 AS INT)), j -> {record}), ',')")
        )
        .drop("gene")
    )


def annotated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotator output as text lines, with header-like lines and lines without consequences among them."""
    return csq_sites(spark, sf_dir).selectExpr(
        r"""concat(IF(sid % 100 = 0, '#', ''), concat_ws('\t', CHR, CAST(POS AS STRING), '.', REF, ALT, '.', '.',
            CASE WHEN sid % 37 = 0 THEN 'AC=1'
                 WHEN sid % 3 = 1 THEN concat('AC=1;CSQ=', csqs) ELSE concat('CSQ=', csqs) END)) AS text"""
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript dimension with the raw source column names (Start, End): three for each gene that a site lies in."""
    return (
        table(spark, sf_dir, "part")
        .selectExpr("(p_partkey % 24) * 10 + (p_partkey div 24) % 10 AS gene")
        .distinct()
        .selectExpr("gene", "explode(sequence(gene * 3, gene * 3 + 2)) AS tx")
        .where("tx % 5 <> 0")
        .selectExpr(
            "concat('ENST', tx) AS Transcript",
            "concat('G', gene) AS GeneName",
            "concat('ENSG', gene) AS EnsemblGeneId",
            "IF(tx % 2 = 0, '+', '-') AS Strand",
            f"{label('tx div 30')} AS CHR",
            "(gene % 10) * 100000 + 200000 AS Start",
            "(gene % 10) * 100000 + 1000000 AS End",
            "300 + gene * 3 AS CDSLength",
        )
    )


def missense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missense-prediction table with the raw source column names (rsid_151 and an empty one)."""
    rows = (
        variants(spark, sf_dir)
        .where("sid % 3 <> 0")
        .selectExpr(
            "CHR",
            "POS",
            "REF",
            "ALT",
            "concat('ENSG', (sid % 24) * 10 + (sid div 24) % 10) AS EnsemblGeneId",
            "IF(sid % 11 = 0, ALT, REF) AS ancestralAllele",
            "concat('rs', sid) AS rsid_151",
            "'D;T' AS missensePredictions",
            "CAST(sid % 7 AS STRING) AS n_deleterious",
            "'.' AS MetaSVM",
            "IF(sid % 5 = 0, '.', concat('0.', lpad(CAST(sid % 100 AS STRING), 2, '0'))) AS Revel",
        )
    )
    return rows.withColumnRenamed("n_deleterious", "")


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Study metadata, one row per nation: three column mappings in turn, two builds."""
    full, most, bare = "n_nationkey % 3 = 0", "n_nationkey % 3 <> 2", "n_nationkey % 3 = 1"
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('study_', n_nationkey) AS study",
        "concat(n_name, '.tsv') AS phenotype_file",
        "concat('trait_', n_regionkey) AS phenotype",
        "'chrom' AS CHR",
        "'bp' AS POS",
        "'marker' AS ID",
        "'Allele2' AS effectAllele",
        "'Allele1' AS otherAllele",
        f"IF({bare}, NULL, 'imputationInfo') AS infoScore",
        "'BETA' AS beta",
        "'SE' AS SE",
        "'p.value' AS pvalue",
        f"IF({bare}, NULL, 'AF.Allele2') AS effect_AF",
        f"IF({full}, 'AF.Cases', NULL) AS cases_AF",
        f"IF({full}, 'AF.Controls', NULL) AS controls_AF",
        "IF(n_nationkey % 2 = 0, 'hg19', 'hg38') AS build",
        "CAST(100000 + n_nationkey AS BIGINT) AS total_N",
        "CAST(NULL AS STRING) AS snp_N",
        "CAST(1000 + n_nationkey AS BIGINT) AS cases_N",
        "CAST(99000 AS BIGINT) AS controls_N",
    )


def sumstats_raw(spark: SparkSession, sf_dir: str, build: str = "hg19") -> DataFrame:
    """Association results under the source column names; -99 / -999 mark missing numbers."""
    orders = spread(table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c"))
    placed = orders.selectExpr(
        "k",
        "c",
        "k % 24 AS chr_key",
        "1 + IF(c % 40 = 0, (k div 48) * 6000, (k div 24) * 3000) AS bp",
    ).withColumn("d", F.expr("bp + 1000 * (chr_key + 1)" if build == "hg19" else "bp"))
    own, nxt = base("d"), letter("d * 7 + d div 13 + 1")
    return placed.selectExpr(
        f"{label('chr_key')} AS chrom",
        "bp",
        "IF(k % 50 = 0, NULL, concat('rs', k)) AS marker",
        f"IF(k % 6 = 0, lower({nxt}), {own}) AS Allele1",
        f"CASE WHEN k % 89 = 0 THEN 'I' WHEN k % 6 = 0 THEN {own} ELSE {nxt} END AS Allele2",
        "(k % 101) / 100 AS imputationInfo",
        "IF(k % 97 = 0, -99, ((k % 41) - 20) / 100) AS BETA",
        "IF(k % 193 = 0, -999, (k % 9 + 1) / 100) AS SE",
        "(k % 1000 + 1) / 1000 AS `p.value`",
        "(c % 1000) / 1000 AS `AF.Allele2`",
        "(c % 500) / 1000 AS `AF.Cases`",
        "(c % 250) / 1000 AS `AF.Controls`",
    )


def write_studies_text(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """The results dealt by customer to the nations' studies, one folder of text each; three layouts in turn."""
    own = table(spark, sf_dir, "nation").selectExpr("concat(n_name, '.tsv') AS phenotype_file", "n_nationkey AS nation")
    rows = sumstats_raw(spark, sf_dir).withColumn("nation", F.expr("CAST(round(`AF.Allele2` * 1000) AS INT) % 25"))
    dealt = rows.join(small_side(own), "nation")
    columns = [c for c in rows.columns if c != "nation"]
    few = [c for c in columns if not c.startswith("AF.") and c != "imputationInfo"]
    layouts = [columns, ["extra", *few[::-1]], ["extra", *columns[:-2]]]
    for i, layout in enumerate(layouts):
        part = dealt.where(F.col("nation") % 3 == i).withColumn("extra", F.lit("unused"))
        part.select("phenotype_file", *[f"`{c}`" for c in layout]).write.partitionBy("phenotype_file").csv(f"{path}/{i}", sep="\t", header=True)
    names = dealt.groupBy("nation", "phenotype_file").count().collect()
    return [f"{path}/{r.nation % 3}/phenotype_file={r.phenotype_file}" for r in names]


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build-to-build alignment blocks (0-based half-open)."""
    key = "s_suppkey % 24"
    return (
        table(spark, sf_dir, "supplier")
        .selectExpr("s_suppkey", "(s_suppkey div 24) * 500000 AS srcStart")
        .selectExpr(
            f"{label('s_suppkey')} AS srcContig",
            "srcStart",
            "srcStart + 499000 AS srcEnd",
            f"IF(s_suppkey % 25 = 7, 'X', {label('s_suppkey')}) AS dstContig",
            f"srcStart + 1000 * ({key} + 1) AS dstStart",
            "IF(s_suppkey % 9 = 0, '-', '+') AS strand",
        )
    )


def chain_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored chains that overlap: one of two blocks with a gap of 50 bases, and one
    of another score, across the gap or beside it."""
    source = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS s", "(s_suppkey div 24) * 500000 AS ss")
    shift = f"{REFERENCE_PERIOD} * (s % 5 + 1)"
    layers = [
        (f"ss + 0, ss + 200000, {label('s')}, ss + {shift}, '+'", "concat('a', s)", "1000 + s % 7"),
        (f"ss + 200050, ss + 499000, {label('s')}, ss + 200050 + {shift} + {REFERENCE_PERIOD}, '+'", "concat('a', s)", "1000 + s % 7"),
        (f"ss + IF(s % 4 = 1, 210000, 100000), ss + 400000, {label('s + 1')}, ss + 300000 + 13 * (s % 4), IF(s % 3 = 0, '-', '+')", "concat('b', s)", "1000 + s % 5"),
    ]
    made = ", ".join(f"struct({label('s')}, {block}, {name}, {score})" for block, name, score in layers)
    rows = source.selectExpr(f"inline(array({made}))")
    return rows.toDF("srcContig", "srcStart", "srcEnd", "dstContig", "dstStart", "strand", "chainId", "score")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body rows of 1 to 60 reference bases, half of them near the gaps of ``chain_layers``."""
    placed = spread(table(spark, sf_dir, "orders").select("o_orderkey")).selectExpr(
        "o_orderkey AS k",
        "(o_orderkey div 48) % 3 * 500000 + 1 + CASE WHEN o_orderkey % 8 = 0 THEN 498940 + o_orderkey % 90 WHEN o_orderkey % 2 = 0 THEN (o_orderkey * 7919) % 520000 ELSE 199900 + (o_orderkey * 13) % 220 END AS p",
        "CASE o_orderkey % 9 WHEN 0 THEN 60 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS n",
    )
    text = "array_join(transform(sequence(0L, n - 1), i -> {}), '')".format(base("p + i"))
    return placed.selectExpr(
        f"{label('k')} AS CHR", "p AS POS", "CAST(k AS STRING) AS ID", f"{text} AS REF",
        f"IF(n = 1, {letter('p * 7 + p div 13 + 1 + k % 3')}, {base('p')}) AS ALT", "'.' AS QUAL", "'.' AS FILTER", "'.' AS INFO",
    )


def _period(offset: int = 0) -> str:
    """The repeating reference text, starting at 1-based position ``offset + 1``."""
    positions = range(offset + 1, offset + 1 + REFERENCE_PERIOD)
    return "".join("ACGT"[(p * 7 + p // 13) % 4] for p in positions)


def reference(spark: SparkSession, sf_dir: str, size: int = CHUNK) -> DataFrame:
    """ref_chunk(contig, chunk, seq): ``size`` bases per chunk, as far as the positions of orders reach."""
    last = table(spark, sf_dir, "orders").agg(F.expr(f"(max(o_orderkey) div 24 * 3000 + 600000) div {size}").alias("n"))
    text = _period() * (size // REFERENCE_PERIOD + 3)
    return (
        last.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n"))).alias("chunk"))
        .select(F.explode(F.array(*[F.lit(c) for c in [*map(str, range(1, 23)), "X", "Y"]])).alias("contig"), "chunk")
        # dealt as lookups join it, before there is text to move; a given number is not coalesced
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "contig", "chunk")
        .withColumn(
            "seq", F.expr(f"substr('{text}', CAST(chunk * {size} % {REFERENCE_PERIOD} AS INT) + 1, {size})")
        )
    )
