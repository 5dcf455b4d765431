"""Study metadata, cleaning, liftover, REF repair, alignment and formatting on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from siteloom.operators import harmonise, intervals, liftover, normalize
from siteloom.operators.sumstats import Study, info_text, qc_studies, qc_summary_stats, rename_columns, studies_funnel, to_vcf_rows
from siteloom.plans import pipelines
from siteloom.sources import sumstats as source

META = (
    "Link,study,VM instance,phenotype_file,phenotype,CHR,POS,ID,effectAllele,otherAllele,infoScore,beta,SE,pvalue,"
    "effect_AF,cases_AF,controls_AF,build,total_N,snp_N,cases_N,controls_N,sep,compression\n"
    "l,S,v,one.txt,P,chrom,bp,id,a1,a2,info,b,se,p.value,af,caf,,hg19,100,,50,50,TAB,gz\n"
    "l,S,v,two.txt,P,chrom,bp,id,a1,a2,,b,se,p,,,,hg38,100,,50,50,TAB,\n"
    "l,S,v,two.txt,P,chrom,bp,id,a1,a2,,b,se,p,,,,hg38,100,,50,50,TAB,\n"
)


@pytest.fixture(scope="module")
def metadata(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("meta") / "meta.csv"
    path.write_text(META)
    return source.read_metadata(spark, str(path))


def test_metadata_lookup(metadata, spark, tmp_path):
    study = source.find_study(metadata, "one.txt")
    assert study.columns["pvalue"] == "p.value" and "snp_N" not in study.columns and "controls_AF" not in study.columns
    assert study.counts == {"total_N": 100, "cases_N": 50, "controls_N": 50} and study.build == "hg19"
    source.write_params(metadata, "one.txt", str(tmp_path / "params"))
    assert spark.read.csv(str(tmp_path / "params"), sep="\t", header=True).first().phenotype_file == "one.txt"


@pytest.mark.parametrize("name", ["none.txt", "two.txt"])
def test_metadata_must_match_once(metadata, name):
    with pytest.raises(ValueError):
        source.find_study(metadata, name)


TSV = "chrom\tbp\tid\ta1\ta2\tinfo\tb\tse\tp.value\taf\tcaf\textra\n"


def read(spark, tmp_path, study, *lines):
    path = tmp_path / "study.tsv"
    path.write_text(TSV + "\n".join("\t".join(map(str, x)) for x in lines) + "\n")
    return source.read_summary_stats(spark, str(path), study)


def test_cleaning_rules(metadata, spark, tmp_path):
    study = source.find_study(metadata, "one.txt")
    good = dict(chrom=1, bp="7.0", id="rs1", a1="a", a2="g", info=0.9, b=0.1, se=0.2, p=0.5, af=0.5, caf=0.5, extra=0)
    cases = {
        "kept": {},
        "no id": {"id": "NA"},
        "indel letters": {"a1": "I"},
        "beta missing": {"b": -99},
        "SE missing": {"se": "-999.0"},
        "beta text": {"b": "NA"},
        "rare": {"af": 0.0009},
        "edge": {"af": 0.001},
        "no frequency": {"af": "NA"},
        "few cases": {"caf": 0.25},
        "low info": {"info": 0.3},
        "no allele": {"a2": ""},
    }
    lines = [list((good | {"chrom": name} | change).values()) for name, change in cases.items()]
    raw = read(spark, tmp_path, study, *lines)
    assert "extra" not in raw.columns
    kept = qc_summary_stats(raw, study)
    assert sorted(r.CHR for r in kept.collect()) == ["edge", "kept", "no id"]
    row = to_vcf_rows(kept.where("CHR = 'no id'")).first()
    assert (row.POS, row.ID, row.REF, row.ALT, row.QUAL, row.FILTER) == (7, ".", "G", "A", ".", ".")
    assert row.INFO == (
        "effectAllele=A;SE=0.2;beta=0.1;pvalue=0.5;infoScore=0.9;effect_AF=0.5;cases_AF=0.5;total_N=100;"
        "cases_N=50;controls_N=50;phenotype=P;study=S"
    )


def test_optional_case_frequency_filter(metadata, spark, tmp_path):
    study = source.find_study(metadata, "one.txt")
    raw = read(spark, tmp_path, study, [1, 7, "r", "A", "G", 0.9, 0.1, 0.2, 0.5, 0.5, 1.0, 0])
    assert qc_summary_stats(raw, study).count() == 1
    assert qc_summary_stats(raw, study, filter_cases_af=True).count() == 0


def test_unmapped_columns_and_null_info(spark):
    study = Study("S", "P", None, {"CHR": "c", "beta": "b"}, {"total_N": 1, "cases_N": None, "controls_N": None})
    df = rename_columns(spark.createDataFrame([("1", -99.0)], "c string, b double"), study)
    assert info_text(df).first().INFO == "beta=.;total_N=1;cases_N=.;controls_N=.;phenotype=P;study=S"


# --- many studies at once -----------------------------------------------------------------------------

MANY = ["one.tsv", "two + 2%20é.tsv", "part=three.tsv"]


def many_studies(spark, tmp_path):
    """Three studies: a file, a file of a difficult name, and a folder of two files; their columns differ."""
    row = {c: None for c in ("CHR", "POS", "otherAllele", "effectAllele", "SE", "beta", "infoScore", "cases_AF", "total_N", "cases_N", "controls_N")}
    base = row | dict(CHR="c", POS="p", otherAllele="a1", effectAllele="a2", SE="se", beta="b", phenotype="P", build="hg19", cases_N="100")
    rows = [
        base | dict(phenotype_file="one.tsv", study="S1", infoScore="info"),
        base | dict(phenotype_file=MANY[1], study="S2", cases_AF="caf", build="hg38"),
        base | dict(phenotype_file="three.tsv", study="S3", otherAllele="a2", effectAllele="a1"),
        base | dict(phenotype_file="twice.tsv", study="S4"),
        base | dict(phenotype_file="twice.tsv", study="S5"),
        base | dict(phenotype_file="lacking.tsv", study="S6", beta="not there"),
    ]
    metadata = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rows[0]))
    (tmp_path / MANY[0]).write_text("c\tp\ta1\ta2\tb\tse\tinfo\n1\t5\ta\tg\t0.1\t0.2\t0.9\n1\t6\tA\tG\t0.1\t0.2\t0.1\n1\t7\tA\tG\t-99\t0.2\t0.9\n")
    (tmp_path / MANY[1]).write_text("caf\tx\tse\tb\ta2\ta1\tp\tc\n0.5\tx\t0.3\t0.4\tT\tC\t8\t2\n0.1\tx\t0.3\t0.4\tT\tC\t9\t2\n")
    folder = tmp_path / MANY[2]
    folder.mkdir()
    for i in range(2):
        (folder / f"part-{i}.csv").write_text(f"c\tp\ta1\ta2\tb\tse\n3\t{10 + i}\tA\tC\t0.5\t0.6\n")
    for name in ("twice.tsv", "lacking.tsv", "unknown.tsv"):
        (tmp_path / name).write_text("c\tp\ta1\ta2\tb\tse\n")
    return metadata


def test_many_studies_are_read_together(spark, tmp_path):
    metadata = many_studies(spark, tmp_path)
    rows = source.read_studies(spark, [str(tmp_path / n) for n in MANY], metadata)
    assert rows.count() == 7
    kept = {(r.study, r.POS): r for r in info_text(qc_studies(rows)).collect()}
    assert set(kept) == {("S1", 5), ("S2", 8), ("S3", 10), ("S3", 11)}
    assert kept["S3", 10].otherAllele == "C" and kept["S3", 10].effectAllele == "A" and kept["S1", 5].otherAllele == "A"
    assert kept["S2", 8].phenotype_file == MANY[1] and kept["S2", 8].build == "hg38" and kept["S2", 8].infoScore is None
    assert kept["S2", 8].INFO == "effectAllele=T;SE=0.3;beta=0.4;cases_AF=0.5;total_N=.;cases_N=100;controls_N=.;phenotype=P;study=S2"
    # the same rows as one study at a time
    for name in MANY:
        study = source.find_study(metadata, name.split("=")[-1])
        alone = info_text(qc_summary_stats(source.read_summary_stats(spark, str(tmp_path / name), study), study))
        assert sorted(r.INFO for r in alone.collect()) == sorted(r.INFO for r in kept.values() if r.study == study.study)
    steps = {(r.phenotype_file, r.step): r.n_rows for r in studies_funnel(rows).collect()}
    assert [steps["one.tsv", s] for s in ("all", "effect_known", "infoScore")] == [3, 2, 1] and steps[MANY[1], "case_count"] == 1


def test_many_studies_are_one_scan(spark, tmp_path):
    metadata = many_studies(spark, tmp_path)
    plan = qc_studies(source.read_studies(spark, [str(tmp_path / n) for n in MANY], metadata))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["twice.tsv", "unknown.tsv", "lacking.tsv"])
def test_every_file_needs_its_one_study(spark, tmp_path, name):
    metadata = many_studies(spark, tmp_path)
    with pytest.raises(ValueError, match=name):
        source.read_studies(spark, [str(tmp_path / n) for n in (MANY[0], name)], metadata)


def test_paths_of_one_name_are_refused(spark, tmp_path):
    metadata = many_studies(spark, tmp_path)
    with pytest.raises(ValueError, match="one name"):
        source.read_studies(spark, [str(tmp_path / MANY[0]), str(tmp_path / "x" / MANY[0])], metadata)


# --- reference, liftover and alignment --------------------------------------------------------------

SIZE = 16
RNG = random.Random(11)
GENOME = "GATTACA" + "CAG" * 60 + "TTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTT" + "".join(RNG.choice("ACGT") for _ in range(60))


@pytest.fixture(scope="module")
def reference(spark):
    chunks = [("1", i // SIZE, GENOME[i : i + SIZE]) for i in range(0, len(GENOME), SIZE)]
    return spark.createDataFrame(chunks, "contig string, chunk bigint, seq string")


def body(spark, rows):
    full = [(c, p, i, r, a, ".", ".", "k=v") for c, p, i, r, a in rows]
    schema = "CHR string, POS bigint, ID string, REF string, ALT string, QUAL string, FILTER string, INFO string"
    return spark.createDataFrame(full, schema)


def left_most(pos, ref, alt):
    """The textbook loop: cut equal ends, borrow a base from the left when an allele runs empty."""
    if ref == alt:
        return pos, ref, alt
    changed = True
    while changed:
        changed = False
        if ref and alt and ref[-1] == alt[-1] and (min(len(ref), len(alt)) > 1 or pos > 1):
            ref, alt, changed = ref[:-1], alt[:-1], True
        if not ref or not alt:
            pos -= 1
            ref, alt, changed = GENOME[pos - 1] + ref, GENOME[pos - 1] + alt, True
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def test_left_align_equals_the_textbook_loop(spark, reference):
    rng, rows = random.Random(5), []
    for i in range(400):
        pos = rng.randrange(2, len(GENOME) - 12)
        kind, m = i % 4, rng.randrange(1, 7)
        if kind == 0:  # deletion
            ref, alt = GENOME[pos - 1 : pos + m], GENOME[pos - 1]
        elif kind == 1:  # insertion of what follows, often a repeat unit
            ref, alt = GENOME[pos - 1], GENOME[pos - 1 : pos + m]
        elif kind == 2:  # insertion of anything
            ref = GENOME[pos - 1]
            alt = ref + "".join(rng.choice("ACGT") for _ in range(m))
        else:  # padded substitution
            ref = GENOME[pos - 1 : pos + m]
            alt = ref[:-1] + rng.choice("ACGT") + GENOME[pos + m]
            ref += GENOME[pos + m]
        rows.append(("1", pos, str(i), ref, alt))
    out = normalize.left_align(body(spark, rows), reference, SIZE)
    got = {r.ID: (r.POS, r.REF, r.ALT) for r in out.collect()}
    assert got == {i: left_most(p, r, a) for _, p, i, r, a in rows}
    again = normalize.left_align(out, reference, SIZE)
    assert {r.ID: (r.POS, r.REF, r.ALT) for r in again.collect()} == got


def test_alignment_leaves_unknown_contigs_and_single_bases(spark, reference):
    rows = [("9", 5, "a", "AT", "A"), ("1", 3, "b", "T", "C"), ("1", 1, "c", "GA", "A")]
    out = normalize.left_align(body(spark, rows), reference, SIZE)
    assert sorted((r.ID, r.POS, r.REF, r.ALT) for r in out.collect()) == [
        ("a", 5, "AT", "A"),
        ("b", 3, "T", "C"),
        ("c", 1, "GA", "A"),
    ]


def test_fix_reference(spark, reference):
    rows = [
        ("1", 1, "none", "G", "C"),
        ("1", 2, "swap", "C", "A"),
        ("1", 3, "set", "A", "C"),
        ("1", SIZE - 1, "long", GENOME[SIZE - 2 : SIZE + 2], "A"),
        ("1", 4, "long set", "TG", "T"),
        ("9", 4, "off", "T", "C"),
    ]
    out = {r.ID: (r.REF, r.ALT, r.ref_fixed) for r in normalize.fix_reference(body(spark, rows), reference, SIZE).collect()}
    assert out == {
        "none": ("G", "C", "none"),
        "swap": ("A", "C", "swap"),
        "set": ("T", "C", "set"),
        "long": (GENOME[SIZE - 2 : SIZE + 2], "A", "none"),
        "long set": ("T", "TG", "swap"),
        "off": ("T", "C", None),
    }


def test_best_chain_takes_the_whole_span_and_no_row_repeats(spark, reference):
    chain = spark.createDataFrame(
        [
            ("5", 100, 120, "6", 0, "+", "good", 9.0), ("5", 124, 140, "6", 20, "+", "good", 9.0), ("5", 90, 130, "6", 40, "+", "wide", 5.0),
            ("5", 90, 200, "6", 60, "+", "tied b", 5.0), ("5", 300, 310, "6", 0, "+", "gap", 1.0), ("5", 312, 320, "6", 10, "+", "gap", 1.0), ("5", 318, 320, "6", 10, "+", "end", 2.0),
        ],
        "srcContig string, srcStart bigint, srcEnd bigint, dstContig string, dstStart bigint, strand string, chainId string, score double",
    )
    rows = [
        ("5", 111, "best", "A", "C"), ("5", 120, "span leaves the best chain's block", "AA", "C"), ("5", 122, "only the lesser ones", "A", "C"), ("5", 129, "beyond wide", "AAAA", "C"),
        ("5", 309, "over a gap", "AAAAA", "C"), ("5", 311, "inside a gap", "A", "C"), ("5", 320, "past the chain", "AA", "C"), ("5", 299, "before", "AAA", "C"), ("9", 1, "nowhere", "A", "C"),
    ]
    body = spark.createDataFrame([(*r[:3], *r[3:], ".", ".", "") for r in rows * 2], "CHR string, POS bigint, ID string, REF string, ALT string, QUAL string, FILTER string, INFO string")
    for many in (10**6, 0):  # the index broadcast, or shuffled with salts
        index = intervals.index_join(body.withColumn("_start", F.col("POS") - 1), liftover.chain_index(chain), contig="CHR", pos="_start", width=liftover.CHAIN_BIN, max_broadcast_rows=many)
        assert index.count() == len(rows) * 2
    made = liftover.map_positions(body, chain).collect()
    assert len(made) == len(rows) * 2
    got = {r.ID: (r.CHR, r.POS, r.reject_reason) for r in made}
    assert got == {
        "best": ("6", 11, None), "span leaves the best chain's block": ("6", 90, None), "only the lesser ones": ("6", 92, None), "beyond wide": ("6", 25, None),
        "over a gap": ("5", 309, liftover.GAP), "inside a gap": ("5", 311, liftover.NO_TARGET), "past the chain": ("5", 320, liftover.SPLIT_TARGET), "before": ("5", 299, liftover.NO_TARGET),
        "nowhere": ("9", 1, liftover.NO_TARGET),
    }


def test_liftover_cases(spark, reference):
    comp = str.maketrans("ACGT", "TGCA")
    chain = spark.createDataFrame(
        [("5", 100, 120, "1", 10, "+"), ("6", 0, 50, "1", 40, "-")],
        "srcContig string, srcStart bigint, srcEnd bigint, dstContig string, dstStart bigint, strand string",
    )
    base = lambda p: GENOME[p - 1]
    other = lambda b: "ACGT"[("ACGT".index(b) + 1) % 4]
    rows = [
        ("5", 103, "forward", base(13), other(base(13))),
        ("5", 103, "swapped", other(base(13)), base(13)),
        ("5", 103, "neither", other(base(13)), other(other(base(13)))),
        ("5", 121, "outside", "A", "C"),
        ("7", 103, "no contig", "A", "C"),
        ("5", 119, "split", "ACG", "A"),
        ("5", 103, "deletion", GENOME[12:15], base(13)),
        # 0-based 9 of a 50-base reverse block starting at 40 -> 0-based 80, 1-based 81
        ("6", 10, "reverse", base(81).translate(comp), other(base(81)).translate(comp)),
        # bases 10-12 -> 79..81 reversed
        ("6", 10, "reverse deletion", GENOME[78:81][::-1].translate(comp), base(81).translate(comp)),
    ]
    lifted = liftover.liftover(body(spark, rows), chain, reference, SIZE)
    assert lifted.count() == len(rows)
    ok = {r.ID: (r.CHR, r.POS, r.REF, r.ALT, r.INFO) for r in liftover.lifted_rows(lifted).collect()}
    back = {r.ID: (r.CHR, r.POS, r.reject_reason) for r in liftover.rejected_rows(lifted).collect()}
    b = base(13)
    assert ok == {
        "forward": ("1", 13, b, other(b), "k=v;OriginalContig=5;OriginalStart=103"),
        "swapped": (
            "1", 13, b, other(b),
            f"k=v;OriginalContig=5;OriginalStart=103;OriginalAlleles={other(b)},{b};SwappedAlleles",
        ),
        "deletion": ("1", 13, GENOME[12:15], b, "k=v;OriginalContig=5;OriginalStart=103"),
        "reverse": (
            "1", 81, base(81), other(base(81)),
            "k=v;OriginalContig=6;OriginalStart=10;OriginalAlleles="
            f"{base(81).translate(comp)},{other(base(81)).translate(comp)}",
        ),
        "reverse deletion": (
            "1", 79, GENOME[78:81], base(81),
            "k=v;OriginalContig=6;OriginalStart=10;OriginalAlleles="
            f"{GENOME[78:81][::-1].translate(comp)},{base(81).translate(comp)}",
        ),
    }
    assert back == {
        "neither": ("5", 103, liftover.MISMATCH),
        "outside": ("5", 121, liftover.NO_TARGET),
        "no contig": ("7", 103, liftover.NO_TARGET),
        "split": ("5", 119, liftover.SPLIT_TARGET),
    }
    assert tuple(liftover.count_swapped(liftover.lifted_rows(lifted)).first()) == (5, 1)


def test_info_tokens(spark):
    info = "beta=0.1;beta=0.2;SE=a=b;pvalue=.;unknown=1;NotSwappedAlleles;OriginalStart=12.0;study=s"
    row = harmonise.parse_info(body(spark, [("1", 1, "x", "A", "C")]).withColumn("INFO", F.lit(info))).first()
    assert (row.beta, row.SE, row.pvalue, row.OriginalStart, row.study, row.SwappedAlleles) == (
        0.2, None, None, 12, "s", False,
    )


@pytest.mark.parametrize("exact", [False, True])
def test_swapping_twice_changes_nothing(spark, exact):
    rows = body(spark, [("1", 1, "x", "A", "C")]).withColumn(
        "INFO", F.lit("effectAllele=A;beta=0.0;effect_AF=0.1;SwappedAlleles")
    )
    once = harmonise.swap_fix(harmonise.parse_info(rows, exact))
    row = once.first()
    assert (row.effectAllele, row.effectAllele_pre_swap) == ("C", "A") and str(row.beta)[0] != "-"
    assert float(row.effect_AF) == pytest.approx(0.9) and row.cases_AF is None
    twice = harmonise.swap_fix(once.drop("effectAllele_pre_swap").withColumn("ALT", F.lit("A"))).first()
    assert twice.effectAllele == "A" and float(twice.effect_AF) == pytest.approx(0.1)


def formatted(spark, rows, **options):
    df = body(spark, [r[:5] for r in rows])
    infos = spark.createDataFrame([(r[2], r[5]) for r in rows], "ID string, INFO string")
    return harmonise.format_harmonised(df.drop("INFO").join(infos, "ID"), **options)


def test_format_rules(spark):
    rows = [
        ("1_alt", 1, "alt contig", "A", "C", ""),
        ("1.0", 2, "dotted", "A", "C", "OriginalContig=1"),
        ("X", 3, "moved to X", "A", "C", "OriginalContig=1"),
        ("X", 4, "stayed on X", "A", "C", "OriginalContig=X"),
        ("X", 5, "never lifted", "A", "C", ""),
        ("2", 6, "twin a", "A", "C", ""),
        ("2", 6, "twin b", "A", "C", ""),
        ("2", 7, "locus a", "A", "C", ""),
        ("2", 7, "locus b", "A", "G", ""),
    ]
    ids = lambda df: sorted(r.ID for r in df.collect())
    out = formatted(spark, rows)
    assert out.columns == ["uid", *harmonise.HARMONISED]
    assert ids(out) == ["dotted", "locus a", "locus b", "never lifted", "stayed on X"]
    assert out.where("ID = 'dotted'").first().uid == "1:2:A:C"
    assert ids(formatted(spark, rows, key="locus")) == ["dotted", "never lifted", "stayed on X"]
    assert ids(formatted(spark, rows, strict_x=True)) == ["dotted", "locus a", "locus b", "stayed on X"]


def test_pipeline_aligns_indels_and_writes(spark, reference, tmp_path):
    study = Study("S", "P", "hg38", {c: c for c in ("CHR", "POS", "ID", "otherAllele", "effectAllele", "SE", "beta")})
    study = Study(study.study, study.phenotype, study.build, study.columns, {"total_N": 1, "cases_N": 1, "controls_N": 1})
    raw = spark.createDataFrame(
        [("1", 13, "del", GENOME[12:16], GENOME[12], 0.1, 0.2), ("1", 1, "snp", "g", "c", 0.1, 0.2)],
        "CHR string, POS bigint, ID string, otherAllele string, effectAllele string, SE double, beta double",
    )
    wide = reference.groupBy("contig").agg(F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "seq")))["seq"], "").alias("seq"))
    chunked = wide.select("contig", F.lit(0).cast("bigint").alias("chunk"), "seq")
    out = pipelines.harmonise_study(raw, study, chunked)
    want = left_most(13, GENOME[12:16], GENOME[12])
    assert sorted((r.ID, r.POS, r.REF, r.ALT) for r in out.collect()) == [("del", *want), ("snp", 1, "G", "C")]
    source.write_harmonised(out, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), sep="\t", header=True).count() == 2


def test_unique_rows_with_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("uid"), "id")
    assert harmonise.unique_rows(df).count() == 2000


def test_lookup_table_aligns_indels_only(spark, reference):
    gt = "array<struct<calls:array<int>,sampleId:string,phased:boolean,depth:int,conditionalQuality:int,alleleDepths:array<int>>>"
    calls = [([0, 1], "s0", False, 9, 9, [4, 5]), ([0, 0], "s1", False, 9, 9, [9, 0])]
    schema = (
        "contigName string, start bigint, end bigint, referenceAllele string, alternateAlleles array<string>,"
        f" filters array<string>, qual double, attributes map<string,string>, genotypes {gt}"
    )
    rows = [
        ("chr1", 12, 16, GENOME[12:16], [GENOME[12]], None, None, None, calls),
        ("chr1", 2, 3, "T", ["C"], None, None, None, calls),
    ]
    whole = spark.createDataFrame([("1", 0, GENOME)], "contig string, chunk bigint, seq string")
    out = pipelines.lookup_table(spark.createDataFrame(rows, schema), whole)
    pos, ref, alt = left_most(13, GENOME[12:16], GENOME[12])
    got = sorted((r.uid, r.start, r.end, len(r.genotypes), r.AC) for r in out.collect())
    assert got == sorted([(f"1:{pos}:{ref}:{alt}", pos - 1, pos - 1 + len(ref), 1, 1), ("1:3:T:C", 2, 3, 1, 1)])
