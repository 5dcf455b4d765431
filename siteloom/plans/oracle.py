"""The same results as the registered queries, written independently as SQL over the given tables.

Nothing here is read by the library. Common table expressions below rebuild the fixtures from the tables
with integer arithmetic; ``_sql`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re

from siteloom.plans.queries import LINKED_R2


def _label(key: str) -> str:
    return f"CASE ({key}) % 24 WHEN 0 THEN 'X' WHEN 23 THEN 'Y' ELSE CAST(({key}) % 24 AS VARCHAR) END"


def _letter(key: str) -> str:
    return f"substr('ACGT', CAST(({key}) % 4 AS INT) + 1, 1)"


def _base(pos: str) -> str:
    return _letter(f"({pos}) * 7 + ({pos}) // 13")


_TERMS = [
    ("stop_gained", 1, "stop_gained"),
    ("frameshift_variant", 2, "frameshift"),
    ("splice_donor_variant", 3, "splice_donor"),
    ("splice_acceptor_variant", 4, "splice_acceptor"),
    ("stop_lost", 5, "stop_lost"),
    ("start_lost", 6, "start_lost"),
    ("missense_variant", 7, "missense"),
    ("inframe_insertion", 8, "inframe_indel"),
    ("inframe_deletion", 8, "inframe_indel"),
    ("splice_region_variant", 9, "splice_region"),
    ("synonymous_variant", 10, "synonymous"),
    ("start_retained_variant", 10, "synonymous"),
    ("stop_retained_variant", 10, "synonymous"),
    ("5_prime_UTR_variant", 11, "5_prime_UTR"),
    ("3_prime_UTR_variant", 12, "3_prime_UTR"),
    ("intron_variant", 13, "intronic"),
    ("upstream_gene_variant", 14, "upstream"),
    ("downstream_gene_variant", 15, "downstream"),
    ("regulatory_region_variant", 16, "other"),
]

_CTES: dict[str, str] = {
    # --- sites and genotypes
    "vs": f"""SELECT p_partkey AS sid, p_size, 'chr' || {_label('p_partkey')} AS contigName,
            p_partkey * 1000 AS start, p_partkey * 1000 + 1 AS POS,
            CASE WHEN p_size % 10 = 0 THEN 2 ELSE 1 END AS n_alt, {_letter('p_partkey')} AS ref,
            {_letter('p_partkey + 1')} || CASE WHEN p_size % 7 = 0 THEN 'TT' ELSE '' END AS alt1,
            {_letter('p_partkey + 2')} AS alt2 FROM part""",
    "vv": """SELECT sid, substr(contigName, 4) AS CHR, POS, ref AS REF, alt AS ALT, concat_ws(':', substr(contigName, 4), POS, ref, alt) AS uid
            FROM (SELECT *, alt1 AS alt FROM vs UNION ALL SELECT *, alt2 FROM vs WHERE n_alt = 2)""",
    "vg": """SELECT l_partkey AS sid, l_suppkey AS s, min(l_orderkey * 10 + l_linenumber) AS k,
            CAST(min(l_quantity) AS BIGINT) AS dp FROM lineitem GROUP BY 1, 2""",
    "va": """SELECT g.*, v.n_alt,
            CASE WHEN (k * 7 + s) % 29 = 0 THEN -1
                 WHEN (k * 31 + s * 7) % 100 < (sid * 7) % 100 THEN 1 ELSE 0 END AS a1,
            CASE WHEN (k * 7 + s) % 29 IN (0, 1) THEN -1
                 WHEN (k * 17 + s * 13) % 100 < (sid * 7) % 100
                 THEN CASE WHEN n_alt = 2 AND k % 3 = 0 THEN 2 ELSE 1 END ELSE 0 END AS a2
            FROM vg g JOIN vs v USING (sid)""",
    "ve": """SELECT *, CAST(s AS VARCHAR) AS sampleId, a1 >= 0 AND a2 >= 0 AS called,
            CASE WHEN a1 >= 0 AND a2 >= 0 THEN dp * (CAST(a1 = 1 AS INT) + CAST(a2 = 1 AS INT)) // 2 END AS r1,
            CASE WHEN a1 >= 0 AND a2 >= 0 THEN dp * (CAST(a1 = 2 AS INT) + CAST(a2 = 2 AS INT)) // 2 END AS r2
            FROM va""",
    # one row per (site, allele, sample) after masking (m1, m2) and after repair (x1, x2)
    "vm": """SELECT e.*, i.a_index, n_alt = 2 AS was_split,
            CASE WHEN NOT called THEN -1 WHEN n_alt = 1 OR a1 <= 0 THEN a1 WHEN a1 = i.a_index THEN 1 ELSE -1 END AS m1,
            CASE WHEN NOT called THEN -1 WHEN n_alt = 1 OR a2 <= 0 THEN a2 WHEN a2 = i.a_index THEN 1 ELSE -1 END AS m2,
            dp - r1 - r2 AS ad0, CASE WHEN i.a_index = 1 THEN r1 ELSE r2 END AS ad1
            FROM ve e JOIN (VALUES (1), (2)) i(a_index) ON i.a_index <= n_alt""",
    "vx": """SELECT *,
            CASE WHEN called AND was_split AND least(m1, m2) < 0 AND greatest(m1, m2) >= 0 THEN 0 ELSE m1 END AS x1,
            CASE WHEN called AND was_split AND least(m1, m2) < 0 AND greatest(m1, m2) >= 0 THEN greatest(m1, m2)
                 ELSE m2 END AS x2 FROM vm""",
    "vd": """SELECT e.sid, e.s, e.sampleId, i.a_index, e.n_alt, e.called, e.dp,
            CASE WHEN n_alt = 1 OR a1 <= 0 THEN a1 WHEN a1 = i.a_index THEN 1 ELSE 0 END AS x1,
            CASE WHEN n_alt = 1 OR a2 <= 0 THEN a2 WHEN a2 = i.a_index THEN 1 ELSE 0 END AS x2,
            dp - CASE WHEN i.a_index = 1 THEN r1 ELSE r2 END AS ad0, CASE WHEN i.a_index = 1 THEN r1 ELSE r2 END AS ad1
            FROM ve e JOIN (VALUES (1), (2)) i(a_index) ON i.a_index <= n_alt""",
}


def _counts(source: str) -> str:
    return f"""SELECT sid, a_index, count(*) AS n, count(1) FILTER (WHERE x1 >= 0 AND x2 >= 0) AS n_called,
        count(1) FILTER (WHERE x1 >= 0 AND x2 >= 0 AND x1 <> x2) AS het, count(1) FILTER (WHERE x1 = 0 AND x2 = 0) AS rr,
        count(1) FILTER (WHERE x1 = 1 AND x2 = 1) AS aa,
        coalesce(sum(CASE WHEN x1 >= 0 AND x2 >= 0 THEN x1 + x2 END), 0) AS ac FROM {source} GROUP BY 1, 2"""


def _terms(source: str) -> str:
    """One row per possible heterozygote count with its log probability and the observed one's."""
    logp = "{h} * ln(2) - lgamma({h} + 1) - lgamma((rare - {h}) / 2 + 1) - lgamma(n_called - (rare + {h}) / 2 + 1)"
    return f"""SELECT sid, a_index, het, h, {logp.format(h='h')} AS lp, {logp.format(h='het')} AS obs
        FROM (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS h
              FROM (SELECT *, CAST(2 * least(rr, aa) + het AS BIGINT) AS rare FROM {source}))"""


_CTES |= {
    "cx": _counts("vx"),
    "cd": _counts("vd"),
    "tx": _terms("cx"),
    "td": _terms("cd"),
    "px": """SELECT sid, a_index,
        sum(CASE WHEN lp < obs - 1e-9 THEN exp(lp - top) WHEN lp <= obs + 1e-9 THEN 0.5 * exp(lp - top) ELSE 0 END)
            / sum(exp(lp - top)) AS p
        FROM (SELECT *, max(lp) OVER (PARTITION BY sid, a_index) AS top FROM tx) GROUP BY 1, 2""",
    "pd": """SELECT sid, a_index,
        sum(CASE WHEN h > het THEN exp(lp - top) WHEN h = het THEN 0.5 * exp(lp - top) ELSE 0 END)
            / sum(exp(lp - top)) AS p
        FROM (SELECT *, max(lp) OVER (PARTITION BY sid, a_index) AS top FROM td) GROUP BY 1, 2""",
    "qc": """SELECT c.*, p.p, v.contigName, v.start, v.ref, CASE WHEN a_index = 1 THEN alt1 ELSE alt2 END AS alt,
        n_called / n AS call_rate, ac / (2 * n_called) AS af
        FROM cd c JOIN pd p USING (sid, a_index) JOIN vs v USING (sid)""",
    "dq": """SELECT sid, a_index, d[1] AS d_min, d[len(d) // 2 + 1] AS d_med, d[len(d)] AS d_max FROM (
        SELECT sid, a_index, list_sort(coalesce(list(dp) FILTER (x1 >= 0 AND x2 >= 0), [])) AS d
        FROM {src} GROUP BY 1, 2)""".replace("{src}", "vx"),
    "hb": """SELECT sid, a_index, CASE WHEN n = 0 THEN 0 ELSE d[1] END AS lo,
        CASE WHEN n = 0 THEN 0 ELSE d[len(d) // 2 + 1] END AS mid, CASE WHEN n = 0 THEN 0 ELSE d[len(d)] END AS hi FROM (
        SELECT sid, a_index, count(1) FILTER (WHERE x1 >= 0 AND x2 >= 0 AND x1 <> x2) AS n,
        list_sort(coalesce(list(ad1 / nullif(ad0 + ad1, 0)) FILTER (x1 >= 0 AND x2 >= 0 AND x1 <> x2 AND ad0 + ad1 > 0), [])) AS d
        FROM vx GROUP BY 1, 2)""",
    "ab": """SELECT sid, a_index, CASE WHEN n = 0 THEN 0 ELSE d[1] END AS lo,
        CASE WHEN n = 0 THEN 0 ELSE d[len(d) // 2 + 1] END AS mid, CASE WHEN n = 0 THEN 0 ELSE d[len(d)] END AS hi FROM (
        SELECT sid, a_index, count(1) FILTER (WHERE x1 = 1 AND x2 = 1) AS n,
        list_sort(coalesce(list(ad1 / nullif(ad0 + ad1, 0)) FILTER (x1 = 1 AND x2 = 1 AND ad0 + ad1 > 0), [])) AS d
        FROM vx GROUP BY 1, 2)""",
    # --- intervals
    "vf": f"""SELECT {_label('c_custkey')} AS CHR, c_custkey * 1300 AS fs,
        c_custkey * 1300 + 2000 + (c_custkey % 7) * 1000 AS fe, 'ENSG' || c_custkey AS geneId, 'G' || c_custkey AS GeneName,
        CASE WHEN c_nationkey % 3 = 0 THEN 'protein_coding' ELSE 'lncRNA' END AS biotype FROM customer""",
    "rj": """SELECT uid, CHR, POS, geneId, GeneName, biotype,
        CASE WHEN POS BETWEEN fs AND fe THEN 0 WHEN POS > fe THEN fe - POS ELSE fs - POS END AS distance
        FROM vv JOIN vf USING (CHR) WHERE POS BETWEEN fs - 500000 AND fe + 500000""",
    "ng": """SELECT uid, CASE WHEN biotype = 'protein_coding' THEN 'protein_coding' ELSE 'other' END AS category,
        row_number() OVER (PARTITION BY uid, biotype = 'protein_coding'
            ORDER BY abs(distance), GeneName, geneId, biotype, distance) AS rank,
        GeneName, geneId AS EnsemblGeneId, biotype, distance FROM rj""",
    # one row per (site, allele), numbered so that both keep the order of sites
    "sv": """SELECT sid * 2 + i.a - 1 AS vid, contigName, start
        FROM vs JOIN (VALUES (1), (2)) i(a) ON i.a <= n_alt""",
    "lp": """SELECT a.contigName, a.vid AS a_vid, b.vid AS b_vid, a.start AS a_start, b.start AS b_start
        FROM sv a JOIN sv b ON a.contigName = b.contigName AND a.vid < b.vid AND a.start <= b.start AND b.start - a.start <= 75000""",
    "ds": "SELECT sid * 2 + a_index - 1 AS vid, s, x1 + x2 AS x FROM vd WHERE x1 >= 0 AND x2 >= 0",
    "dm": """SELECT vid, count(*) AS n, sum(x)::BIGINT AS s, (count(*) * sum(x * x) - sum(x) * sum(x))::BIGINT AS d, sum(x) / count(*) AS mean
        FROM ds GROUP BY vid""",
    "lr": """SELECT a_vid, b_vid, n_both, c * c / ((na * da)::DOUBLE * (nb * db)::DOUBLE) AS r2 FROM (
        SELECT a_vid, b_vid, count(*) AS n_both, ma.n AS na, ma.d AS da, mb.n AS nb, mb.d AS db,
        sum((a.x * ma.n - ma.s) * (b.x * mb.n - mb.s))::DOUBLE AS c
        FROM lp JOIN ds a ON a.vid = a_vid JOIN ds b ON b.vid = b_vid AND b.s = a.s
        JOIN dm ma ON ma.vid = a_vid JOIN dm mb ON mb.vid = b_vid
        WHERE ma.d > 0 AND mb.d > 0 GROUP BY ALL)""",
    "edge": f"""SELECT a_vid AS u, b_vid AS v FROM lr WHERE r2 >= {LINKED_R2}
        UNION ALL SELECT b_vid, a_vid FROM lr WHERE r2 >= {LINKED_R2}""",
    "rank": """SELECT vid, row_number() OVER (ORDER BY -least(mean / 2, 1 - mean / 2), vid) AS r
        FROM dm WHERE vid IN (SELECT u FROM edge)""",
    "near": """SELECT r.r, r.vid, list(n.r) FILTER (n.r < r.r) AS earlier FROM rank r JOIN edge e ON e.u = r.vid
        JOIN rank n ON n.vid = e.v GROUP BY 1, 2""",
    # one pass in rank order: a site is kept unless an earlier kept site is linked to it
    "greedy": """SELECT 0::BIGINT AS r, []::BIGINT[] AS kept
        UNION ALL SELECT g.r + 1, CASE WHEN list_has_any(coalesce(n.earlier, []), g.kept) THEN g.kept
            ELSE list_append(g.kept, n.r) END FROM greedy g JOIN near n ON n.r = g.r + 1""",
    # the same over the rows that pass the site filters, ties by uid
    "qp": """SELECT sid * 2 + a_index - 1 AS vid, sid, a_index, concat_ws(':', contigName, start + 1, ref, alt) AS uid FROM qc
        WHERE call_rate > 0.97 AND af > 0.01 AND af < 0.99 AND p > 1e-16
        AND length(alt) = 1 AND ref <> alt AND contigName NOT IN ('chrX', 'chrY')""",
    "qe": "SELECT u, v FROM edge WHERE u IN (SELECT vid FROM qp) AND v IN (SELECT vid FROM qp)",
    "qr": """SELECT vid, row_number() OVER (ORDER BY -least(mean / 2, 1 - mean / 2), uid) AS r
        FROM dm JOIN qp USING (vid) WHERE vid IN (SELECT u FROM qe)""",
    "qn": """SELECT r.r, r.vid, list(n.r) FILTER (n.r < r.r) AS earlier FROM qr r JOIN qe e ON e.u = r.vid
        JOIN qr n ON n.vid = e.v GROUP BY 1, 2""",
    "qg": """SELECT 0::BIGINT AS r, []::BIGINT[] AS kept
        UNION ALL SELECT g.r + 1, CASE WHEN list_has_any(coalesce(n.earlier, []), g.kept) THEN g.kept
            ELSE list_append(g.kept, n.r) END FROM qg g JOIN qn n ON n.r = g.r + 1""",
    # --- consequences
    "gene": "SELECT *, (sid % 24) * 10 + (sid // 24) % 10 AS gene FROM vv",
    "cj": """SELECT *, gene * 3 + j AS tx, (sid * 13) % (300 + gene * 3) + 1 AS cp
        FROM (SELECT *, unnest(range(0, sid % 3 + 1)) AS j FROM gene)""",
    "term": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{t}', {p}, '{e}')" for i, (t, p, e) in enumerate(_TERMS))
    + ") t(i, name, priority, effect)",
    "cr": """SELECT c.*, t1.name || CASE WHEN sid % 4 = 0 THEN '&' || t2.name ELSE '' END AS consequence,
        CASE WHEN sid % 4 = 0 AND (t2.priority, t2.effect) < (t1.priority, t1.effect) THEN t2.priority ELSE t1.priority END AS priority,
        CASE WHEN sid % 4 = 0 AND (t2.priority, t2.effect) < (t1.priority, t1.effect) THEN t2.effect ELSE t1.effect END AS variantEffect,
        'ENSG' || gene AS EnsemblGeneId, 'G' || gene AS GeneName, 'ENST' || tx AS transcript,
        CASE WHEN j = 0 THEN (sid % 9 + 1) || '/10' ELSE '' END AS exon,
        CASE WHEN j = 1 THEN (sid % 8 + 1) || '/9' ELSE '' END AS intron,
        CASE WHEN sid % 10 = 9 THEN '' ELSE 'ENST' || tx || ':c.' || cp || CASE WHEN sid % 2 = 0 THEN '+2C>T' ELSE 'A>G' END END AS hgvsc,
        CASE WHEN j = 0 THEN 'ENSP' || tx || ':p.' || ((cp + 2) // 3) ELSE '' END AS hgvsp,
        CASE WHEN sid % 50 = 7 THEN '?' WHEN sid % 6 = 5 THEN cp || '-' || (cp + 1) WHEN sid % 11 = 3 THEN ''
             ELSE CAST(cp AS VARCHAR) END AS cds_position,
        CASE WHEN j = 2 THEN '' ELSE CAST((cp + 2) // 3 AS VARCHAR) END AS protein_position,
        CASE WHEN tx % 3 = 0 THEN 'YES' ELSE '' END AS canonical,
        CASE WHEN tx % 3 = 0 THEN 'NM_' || tx ELSE '' END AS mane
        FROM cj c JOIN term t1 ON t1.i = (sid * 5 + j * 7) % 19 JOIN term t2 ON t2.i = (sid + j) % 19""",
    "csq": """SELECT sid, uid, CHR, POS, REF, ALT, string_agg(concat_ws('|', ALT, consequence, 'MODIFIER', GeneName, EnsemblGeneId,
        'Transcript', transcript, 'protein_coding', exon, intron, hgvsc, hgvsp, '', cds_position, protein_position,
        '', '', '', '', '', '', '', '', canonical, mane), ',' ORDER BY j) AS csqs FROM cr GROUP BY ALL""",
    "vt": """SELECT 'ENST' || tx AS transcript, CASE WHEN tx % 2 = 0 THEN '+' ELSE '-' END AS strand,
        (tx // 3 % 10) * 100000 + 200000 AS cdsStart, (tx // 3 % 10) * 100000 + 1000000 AS cdsEnd,
        300 + (tx // 3) * 3 AS cdsLength FROM (SELECT DISTINCT ((p_partkey % 24) * 10 + (p_partkey // 24) % 10) * 3 + j AS tx FROM part, range(3) r(j)) WHERE tx % 5 <> 0""",
    "vn": """SELECT uid, 'rs' || sid AS rsid, CASE WHEN sid % 11 = 0 THEN ALT ELSE REF END AS ancestralAllele,
        CAST(sid % 7 AS VARCHAR) AS delMissenseCount, 'D;T' AS missensePredictions,
        CASE WHEN sid % 5 = 0 THEN '.' ELSE '0.' || lpad(CAST(sid % 100 AS VARCHAR), 2, '0') END AS revel
        FROM vv WHERE sid % 3 <> 0""",
    "cf": """SELECT c.sid, c.uid, c.CHR, c.POS, c.REF, c.ALT, c.EnsemblGeneId, c.GeneName, c.transcript, variantEffect, priority, rsid, strand, cdsStart, cdsEnd,
        cdsLength, nullif(split_part(cds_position, '-', 1), '') AS cpos,
        nullif(split_part(cds_position, '-', 1), '') || '_' || cdsLength AS cds,
        nullif(protein_position, '') || '_' || (cdsLength // 3) AS aa,
        nullif(replace(exon, '/', '_'), '') AS exon, nullif(replace(intron, '/', '_'), '') AS intron,
        nullif(split_part(hgvsc, ':', 2), '') AS hgvsc, nullif(split_part(hgvsp, ':', 2), '') AS hgvsp,
        coalesce(ALT = ancestralAllele, false) AS isAncestralAllele,
        CASE WHEN variantEffect = 'missense' THEN delMissenseCount END AS delMissenseCount,
        CASE WHEN variantEffect = 'missense' THEN missensePredictions END AS missensePredictions,
        nullif(revel, '.') AS revel, CASE WHEN canonical = 'YES' THEN 'yes' ELSE 'no' END AS canonical
        FROM cr c JOIN vt USING (transcript) LEFT JOIN vn USING (uid)""",
    "cl": """SELECT *, coalesce(nullif(concat_ws(',',
        CASE WHEN variantEffect IN ('splice_donor', 'splice_acceptor') THEN
            CASE WHEN strand = '+' AND POS <= cdsStart THEN '5_UTR_splice' WHEN strand = '+' AND POS >= cdsEnd THEN '3_UTR_splice'
                 WHEN strand = '-' AND POS >= cdsEnd THEN '5_UTR_splice' WHEN strand = '-' AND POS <= cdsStart THEN '3_UTR_splice' END END,
        CASE WHEN variantEffect = 'splice_donor' AND contains(hgvsc, '+2C>T') THEN 'GC_2_GT_donor' END,
        CASE WHEN variantEffect IN ('frameshift', 'stop_gained') AND TRY_CAST(cpos AS DOUBLE) / cdsLength >= 0.95 THEN 'EndTrunc' END,
        CASE WHEN isAncestralAllele AND priority >= 4 THEN 'ancestral_allele' END), ''), 'NA') AS lofFilters FROM cf""",
    "eg": """SELECT uid, CHR, REF, ALT, POS, sid, rsid, GeneName, EnsemblGeneId, variantEffect, priority, isAncestralAllele, delMissenseCount,
        missensePredictions, revel, """
    + ", ".join(
        f"string_agg({c}, ':' ORDER BY transcript) AS {c}"
        for c in ("hgvsc", "hgvsp", "cds", "aa", "exon", "intron", "lofFilters")
    )
    + """, string_agg(transcript, ':' ORDER BY transcript) AS transcripts, bool_or(canonical = 'yes') AS affectsCanonical,
        bool_or(lofFilters <> 'NA') AS flagged, min(transcript) FILTER (canonical = 'yes') AS canonical_transcript
        FROM cl GROUP BY ALL""",
    "me": """SELECT uid, EnsemblGeneId, rsid, isAncestralAllele, count(*) AS n_effects,
        string_agg(variantEffect, ',' ORDER BY priority, variantEffect) AS effects,
        arg_min(variantEffect, priority) AS worst, arg_min(variantEffect, priority) FILTER (affectsCanonical) AS canonical_effect,
        min(priority) FILTER (affectsCanonical) AS canonical_priority,
        arg_min(canonical_transcript, priority) FILTER (affectsCanonical) AS canonical_transcript
        FROM eg GROUP BY 1, 2, 3, 4""",
    "md": """SELECT eg.*, CASE WHEN priority <= 4 AND flagged THEN 'LC' WHEN priority <= 4 THEN 'HC' WHEN priority IN (5, 6) THEN 'LC'
        ELSE 'NA' END AS HClof FROM eg
        QUALIFY row_number() OVER (PARTITION BY uid, EnsemblGeneId ORDER BY priority, variantEffect) = 1""",
    "mc": """SELECT l.*, CASE WHEN priority <= 4 AND lofFilters <> 'NA' THEN 'LC' WHEN priority <= 4 THEN 'HC'
        WHEN priority IN (5, 6) THEN 'LC' ELSE 'NA' END AS HClof
        FROM me m JOIN cl l ON l.uid = m.uid AND l.EnsemblGeneId = m.EnsemblGeneId AND l.transcript = m.canonical_transcript""",
    "text_sids": "SELECT uid FROM vv WHERE sid % 100 <> 0 AND sid % 37 <> 0",
    # --- summary statistics
    "ok": """SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 24 AS ck,
        1 + CASE WHEN o_custkey % 40 = 0 THEN (o_orderkey // 48) * 6000 ELSE (o_orderkey // 24) * 3000 END AS bp FROM orders""",
}


def _raw(where: str) -> str:
    return f"""SELECT k, c, {_label('ck')} AS CHR, bp AS POS, CASE WHEN k % 50 = 0 THEN NULL ELSE 'rs' || k END AS ID,
        CASE WHEN k % 6 = 0 THEN lower({_letter('d * 7 + d // 13 + 1')}) ELSE {_base('d')} END AS otherAllele,
        CASE WHEN k % 89 = 0 THEN 'I' WHEN k % 6 = 0 THEN {_base('d')} ELSE {_letter('d * 7 + d // 13 + 1')} END AS effectAllele,
        CASE WHEN k % 97 = 0 THEN NULL ELSE ((k % 41) - 20) / 100 END AS beta,
        CASE WHEN k % 193 = 0 THEN NULL ELSE (k % 9 + 1) / 100 END AS SE, (k % 1000 + 1) / 1000 AS pvalue,
        (k % 101) / 100 AS infoScore, (c % 1000) / 1000 AS effect_AF, (c % 500) / 1000 AS cases_AF, (c % 250) / 1000 AS controls_AF
        FROM (SELECT *, {where} AS d FROM ok)"""


def _clean(source: str, cases: int) -> str:
    return f"""SELECT * REPLACE (upper(otherAllele) AS otherAllele, upper(effectAllele) AS effectAllele) FROM {source}
        WHERE upper(effectAllele) <> 'I' AND beta IS NOT NULL AND SE IS NOT NULL AND effect_AF BETWEEN 0.001 AND 0.999
        AND cases_AF * {cases} * 2 > 25 AND infoScore > 0.3"""


def _info(total: int, cases: int, study: int, trait: int) -> str:
    return f"""concat_ws(';', 'effectAllele=' || effectAllele, 'SE=' || SE, 'beta=' || beta, 'pvalue=' || pvalue, 'infoScore=' || infoScore,
        'effect_AF=' || effect_AF, 'cases_AF=' || cases_AF, 'controls_AF=' || controls_AF,
        'total_N={total};cases_N={cases};controls_N=99000;phenotype=trait_{trait};study=study_{study}')"""


_CTES |= {
    "sr": _raw("bp + 1000 * (ck + 1)"),
    "sc": _clean("sr", 1000),
    "si": f"SELECT *, {_info(100000, 1000, 0, 0)} AS INFO FROM sc",
    "ch": f"""SELECT {_label('s_suppkey')} AS CHR, (s_suppkey // 24) * 500000 AS ss, s_suppkey,
        CASE WHEN s_suppkey % 25 = 7 THEN 'X' ELSE {_label('s_suppkey')} END AS dc, s_suppkey % 9 = 0 AS rev,
        (s_suppkey // 24) * 500000 + 1000 * (s_suppkey % 24 + 1) AS ds_ FROM supplier""",
    "lm": """SELECT i.*, dc, CASE WHEN rev THEN ds_ + 499000 - (i.POS - 1 - ss) ELSE ds_ + (i.POS - 1 - ss) + 1 END AS np,
        CASE WHEN rev THEN translate(otherAllele, 'ACGT', 'TGCA') ELSE otherAllele END AS nr,
        CASE WHEN rev THEN translate(effectAllele, 'ACGT', 'TGCA') ELSE effectAllele END AS na, coalesce(rev, false) AS rev
        FROM si i LEFT JOIN ch ON ch.CHR = i.CHR AND i.POS - 1 >= ss AND i.POS - 1 < ss + 499000""",
    "ll": f"""SELECT *, CASE WHEN dc IS NULL THEN 'NoTarget' WHEN nr <> {_base('np')} AND na <> {_base('np')} THEN 'MismatchedRefAllele' END AS reason,
        nr <> {_base('np')} AND na = {_base('np')} AS swapped FROM lm""",
    "lo": """SELECT k, dc AS CHR, np AS POS, ID, CASE WHEN swapped THEN na ELSE nr END AS REF, CASE WHEN swapped THEN nr ELSE na END AS ALT,
        CHR AS oc, POS AS op, swapped, effectAllele, beta, SE, pvalue, infoScore, effect_AF, cases_AF, controls_AF,
        concat_ws(';', INFO, 'OriginalContig=' || CHR, 'OriginalStart=' || POS,
            CASE WHEN swapped OR rev THEN 'OriginalAlleles=' || otherAllele || ',' || effectAllele END,
            CASE WHEN swapped THEN 'SwappedAlleles' END) AS INFO FROM ll WHERE reason IS NULL""",
    "rc": f"""SELECT k, CHR, POS, ID, effectAllele, beta, SE, pvalue, infoScore, effect_AF, cases_AF, controls_AF, otherAllele, INFO,
        CASE WHEN otherAllele = {_base('POS')} THEN 'none' WHEN effectAllele = {_base('POS')} THEN 'swap' ELSE 'set' END AS fixed,
        {_base('POS')} AS base FROM SRC""",
    "nr": _raw("bp"),
    "nc": _clean("nr", 1003),
    "ni": f"SELECT *, {_info(100003, 1003, 3, 3)} AS INFO FROM nc",
    "ind": f"""SELECT o_orderkey AS k, {_label('o_orderkey')} AS CHR, o_orderkey * 37 + 1 AS p, o_orderkey % 6 + 1 AS m FROM orders""",
    # an indel of m bases after p moves left while the base at p equals the base m further on
    "walk": f"""SELECT k, CHR, p, m FROM ind
        UNION ALL SELECT k, CHR, p - 1, m FROM walk WHERE p > 1 AND {_base('p')} = {_base('p + m')}""",
    "ends": "SELECT k, CHR, m, min(p) AS p FROM walk GROUP BY 1, 2, 3",
}
# the rows of all studies: a study's number decides which columns it has, and NULL stands for those it lacks
_CTES["sa"] = """SELECT s.* REPLACE (upper(otherAllele) AS otherAllele, upper(effectAllele) AS effectAllele,
    CASE WHEN g <> 1 THEN infoScore END AS infoScore, CASE WHEN g <> 1 THEN effect_AF END AS effect_AF,
    CASE WHEN g = 0 THEN cases_AF END AS cases_AF, CASE WHEN g = 0 THEN controls_AF END AS controls_AF),
    n, g, n_name || '.tsv' AS phenotype_file, n_regionkey AS region
    FROM (SELECT *, c % 25 AS n, c % 25 % 3 AS g FROM sr) s JOIN nation ON n_nationkey = n"""
_STEPS = ["effectAllele <> 'I'", "beta IS NOT NULL AND SE IS NOT NULL", "(g = 1 OR effect_AF BETWEEN 0.001 AND 0.999)",
    "(g <> 0 OR cases_AF * (1000 + n) * 2 > 25)", "(g = 1 OR infoScore > 0.3)"]
_CTES["rcs"] = _CTES["rc"].replace("SRC", "si")
_CTES["rcn"] = _CTES["rc"].replace("SRC", "ni")
del _CTES["rc"]
_RECURSIVE = {"greedy", "qg", "walk"}


def _needed(text: str) -> set[str]:
    found = {name for name in _CTES if re.search(rf"\b(FROM|JOIN) {name}\b", text)}
    for name in list(found):
        if _CTES[name] != text:
            found |= _needed_once(name)
    return found


def _needed_once(name: str, seen: frozenset = frozenset()) -> set[str]:
    if name in seen:
        return set()
    inner = {n for n in _CTES if re.search(rf"\b(FROM|JOIN) {n}\b", _CTES[name])}
    result = set(inner)
    for n in inner:
        result |= _needed_once(n, seen | {name})
    return result


def _sql(select: str) -> str:
    names = _needed(select)
    ordered = [n for n in _CTES if n in names]
    if not ordered:
        return select
    # a statement's tables must come before it
    placed: list[str] = []
    while ordered:
        for n in ordered:
            needs = _needed_once(n) - {n}
            if needs <= set(placed):
                placed.append(n)
                ordered.remove(n)
                break
    recursive = "RECURSIVE " if names & _RECURSIVE else ""
    own = select.startswith("WITH ")  # a statement's own tables follow the shared ones
    select = select.removeprefix("WITH ")
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({_CTES[n]})" for n in placed) + (",\n" if own else "\n") + select


def _calls(x: str = "x") -> str:
    return f"CAST({x}1 AS BIGINT) AS c0, CAST({x}2 AS BIGINT) AS c1"


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_HARMONISED = """SELECT concat_ws(':', CHR, POS, REF, ALT) AS uid, CHR, POS, coalesce(ID, '.') AS ID, REF, ALT,
    CASE WHEN swapped THEN ALT ELSE effectAllele END AS effectAllele, oc AS OriginalContig, op AS OriginalStart,
    swapped AS SwappedAlleles, CASE WHEN swapped THEN effectAllele END AS effectAllele_pre_swap,
    round(CASE WHEN swapped THEN 0 - beta ELSE beta END, 6) AS beta, round(SE, 6) AS SE, round(pvalue, 6) AS pvalue,
    round(infoScore, 6) AS infoScore, round(CASE WHEN swapped THEN 1 - effect_AF ELSE effect_AF END, 6) AS effect_AF,
    round(CASE WHEN swapped THEN 1 - cases_AF ELSE cases_AF END, 6) AS cases_AF,
    round(CASE WHEN swapped THEN 1 - controls_AF ELSE controls_AF END, 6) AS controls_AF,
    CAST({total} AS BIGINT) AS total_N, CAST({cases} AS BIGINT) AS cases_N, CAST(99000 AS BIGINT) AS controls_N,
    CAST(NULL AS BIGINT) AS snp_N, 'trait_{trait}' AS phenotype, 'study_{study}' AS study FROM {source}
    WHERE CHR <> 'X' OR oc IS NULL OR oc = CHR
    QUALIFY count(*) OVER (PARTITION BY concat_ws(':', CHR, POS, REF, ALT)) = 1"""

_EFFECT = "variantEffect, CAST(priority AS VARCHAR) AS priority, {tx} AS transcripts, {canon} AS affectsCanonical, delMissenseCount, missensePredictions, revel"
_LISTS = ("hgvsc", "hgvsp", "cds", "aa", "exon", "intron", "lofFilters")


def statements() -> dict[str, str]:
    q = {
        "uid_to_site": """SELECT sid, CHR AS contigName, POS - 1 AS start, POS - 1 + length(REF) AS "end", REF AS referenceAllele,
            ALT AS alt FROM vv""",
        "site_to_uid": """SELECT sid, contigName AS CHR, POS, ref AS REF, alt1 AS ALT, concat_ws(':', contigName, POS, ref, alt1) AS uid
            FROM vs""",
        "contig_strip": "SELECT sid, CASE WHEN sid % 7 = 0 THEN 'Un_random' ELSE substr(contigName, 4) END AS contigName FROM vs",
        "gt_project": """SELECT sid, sampleId, k % 2 = 0 AS phased, dp AS depth, k % 99 AS quality,
            CASE WHEN called THEN CAST(n_alt + 1 AS BIGINT) END AS n_depths FROM ve""",
        "gt_halfcall": """SELECT sid, sampleId, CAST(CASE WHEN called THEN a1 ELSE -1 END AS BIGINT) AS c0,
            CAST(CASE WHEN called THEN a2 ELSE -1 END AS BIGINT) AS c1 FROM ve""",
        "gt_called": "SELECT sid, sampleId, called FROM ve",
        "gt_drop_homref": f"SELECT sid, sampleId, {_calls('a')} FROM ve WHERE NOT (a1 = 0 AND a2 = 0)",
        "alt_or_default": """SELECT sid, CASE WHEN n_alt = 2 THEN alt2 ELSE '.' END AS second_alt FROM vs
            WHERE sid IN (SELECT sid FROM vg)""",
        "split_multi": f"""SELECT sid, CAST(a_index AS BIGINT) AS a_index, CASE WHEN a_index = 1 THEN alt1 ELSE alt2 END AS alt,
            was_split AS splitFromMultiAllelic,
            CASE WHEN was_split THEN substr(contigName, 4) || ':' || POS || ':' || ref || '/' || alt1 || '/' || alt2 END AS INFO_OLD_MULTIALLELIC,
            sampleId, {_calls('m')}, ad0, ad1 FROM vm JOIN (SELECT * EXCLUDE (n_alt) FROM vs) USING (sid)""",
        "fix_multi": f"SELECT sid, CAST(a_index AS BIGINT) AS a_index, sampleId, {_calls()} FROM vx",
        "fix_multi_downcode": f"SELECT sid, CAST(a_index AS BIGINT) AS a_index, sampleId, {_calls()}, ad0, ad1 FROM vd",
        "call_stats": """WITH_ SELECT e.sid, CAST(i.i AS BIGINT) AS allele, count(1) FILTER (WHERE called) AS nCalled, count(1) FILTER (WHERE NOT called) AS nUncalled,
            count(1) FILTER (WHERE called AND a1 <> a2) AS nHet, count(1) FILTER (WHERE called AND NOT (a1 = 0 AND a2 = 0)) AS nNonRef,
            2 * count(1) FILTER (WHERE called) AS nAllelesCalled, count(1) FILTER (WHERE called AND a1 = i AND a2 = i) AS n_hom,
            count(1) FILTER (WHERE called AND a1 = i) + count(1) FILTER (WHERE called AND a2 = i) AS ac,
            round((count(1) FILTER (WHERE called AND a1 = i) + count(1) FILTER (WHERE called AND a2 = i)) / (2 * count(1) FILTER (WHERE called)), 6) AS af,
            round(count(1) FILTER (WHERE called) / count(*), 6) AS callRate
            FROM ve e JOIN (VALUES (0), (1), (2)) i(i) ON i.i <= n_alt GROUP BY 1, 2""".replace("WITH_ ", ""),
        "hwe": "SELECT sid, CAST(a_index AS BIGINT) AS a_index, round(p, 6) AS pValueHwe FROM px",
        "excess_het": "SELECT sid, CAST(a_index AS BIGINT) AS a_index, round(p, 6) AS pValueExcessHet FROM pd",
        "depth_quartiles": "SELECT sid, CAST(a_index AS BIGINT) AS a_index, d_min, d_med, d_max FROM dq",
        "het_ab": """SELECT sid, CAST(a_index AS BIGINT) AS a_index, round(lo, 6) AS ab_min, round(mid, 6) AS ab_median,
            round(hi, 6) AS ab_max FROM hb""",
        "hom_ab": """SELECT sid, CAST(a_index AS BIGINT) AS a_index, round(lo, 6) AS ab_min, round(mid, 6) AS ab_median,
            round(hi, 6) AS ab_max FROM ab""",
        "site_lookup": """SELECT sid, CHR AS contigName, POS - 1 AS start, POS - 1 + length(v.ref) AS "end",
            CASE WHEN n_alt = 2 THEN CHR || ':' || POS || ':' || v.ref || '/' || alt1 || '/' || alt2 END AS multiAllelic,
            concat_ws(':', CHR, POS, v.ref, alt) AS uid, POS, v.ref AS REF, alt AS ALT, CAST(ac AS BIGINT) AS AC, rr AS homRR, het AS hetRA,
            aa AS homAA, n - n_called AS noCall, round(ac / (2 * n_called), 6) AS aaf, round(p, 6) AS pValueHwe,
            round(n_called / n, 6) AS callRate, d AS depth_median, round(het_max, 6) AS het_max, round(hom_median, 6) AS hom_median,
            n - rr AS n_genotypes
            FROM (SELECT c.*, p.p, hb.hi AS het_max, ab.mid AS hom_median FROM cx c JOIN px p USING (sid, a_index)
                  JOIN hb USING (sid, a_index) JOIN ab USING (sid, a_index))
            JOIN (SELECT *, substr(contigName, 4) AS CHR FROM vs) v USING (sid)
            JOIN (SELECT sid, a_index, l[len(l) // 2 + 1] AS d FROM (SELECT sid, a_index,
                  list_sort(coalesce(list(dp) FILTER (x1 >= 0 AND x2 >= 0 AND NOT (x1 = 0 AND x2 = 0)), [])) AS l FROM vx GROUP BY 1, 2)) USING (sid, a_index),
            LATERAL (SELECT CASE WHEN a_index = 1 THEN alt1 ELSE alt2 END AS alt)""",
        "site_qc": """SELECT sid, contigName, start, CAST(a_index AS BIGINT) AS a_index, round(call_rate, 6) AS call_rate, round(af, 6) AS af,
            round(p, 6) AS p_excess_het FROM qc WHERE call_rate > 0.97 AND af > 0.01 AND af < 0.99 AND p > 1e-16
            AND length(alt) = 1 AND ref <> alt AND contigName NOT IN ('chrX', 'chrY')""",
        "qc_funnel": """SELECT CAST(i AS BIGINT) AS step_no, name AS step, count(1) FILTER (WHERE i = 0 OR (call_rate > 0.97 AND (i < 2 OR (af > 0.01 AND af < 0.99))
            AND (i < 3 OR p > 1e-16) AND (i < 4 OR (length(alt) = 1 AND ref <> alt)) AND (i < 5 OR contigName NOT IN ('chrX', 'chrY')))) AS n_rows
            FROM qc, (VALUES (0, 'all'), (1, 'call_rate'), (2, 'allele_frequency'), (3, 'excess_het'), (4, 'snp'), (5, 'autosome')) t(i, name)
            GROUP BY 1, 2""",
        "p_hist": """SELECT CAST(CASE WHEN l < -4 THEN 0 WHEN l >= 0 THEN 9 ELSE floor((l + 4) * 2) + 1 END AS BIGINT) AS bucket,
            count(*) AS n_sites FROM (SELECT log10(p) AS l FROM qc) GROUP BY 1""",
        "mean_impute": """SELECT sid, sampleId, round(m, 6) AS mean_dosage, round(CASE WHEN called THEN d ELSE m END, 6) AS dosage FROM (
            SELECT *, CAST(a1 > 0 AS INT) + CAST(a2 > 0 AS INT) AS d,
            avg(CASE WHEN called THEN CAST(a1 > 0 AS INT) + CAST(a2 > 0 AS INT) END) OVER (PARTITION BY sid) AS m FROM ve)""",
        "gp_export": """SELECT sid, a_index, sampleId, CASE WHEN called THEN CAST(d = 0 AS DOUBLE) END AS gp0, CASE WHEN called THEN CAST(d = 1 AS DOUBLE) END AS gp1,
            CASE WHEN called THEN CAST(d = 2 AS DOUBLE) END AS gp2, round(CASE WHEN called THEN d ELSE m END, 6) AS dosage FROM (
            SELECT * REPLACE (CAST(a_index AS BIGINT) AS a_index), x1 + x2 AS d, avg(CASE WHEN called THEN x1 + x2 END) OVER (PARTITION BY sid, a_index) AS m
            FROM (SELECT * EXCLUDE (called), x1 >= 0 AND x2 >= 0 AS called FROM vd))""",
        "range_join_features": "SELECT uid, CHR, POS, geneId, biotype, distance FROM rj",
        "nearest_genes": "SELECT * FROM ng WHERE rank <= 4",
        "nearest_genes_salted": "SELECT * FROM ng WHERE rank <= 4",
        "ld_pairs": "SELECT * FROM lp",
        "ld_r2": "SELECT a_vid, b_vid, n_both, round(r2, 6) AS r2 FROM lr",
        "ld_prune": """SELECT vid, contigName, start FROM sv WHERE vid // 2 IN (SELECT sid FROM vg) AND vid NOT IN (
            SELECT vid FROM rank WHERE r NOT IN (SELECT unnest(kept) FROM (SELECT kept FROM greedy ORDER BY r DESC LIMIT 1)))""",
        "pruned_probabilities": """SELECT sid, uid, sampleId, CASE WHEN called THEN CAST(d = 0 AS DOUBLE) END AS gp0,
            CASE WHEN called THEN CAST(d = 1 AS DOUBLE) END AS gp1, CASE WHEN called THEN CAST(d = 2 AS DOUBLE) END AS gp2,
            round(m, 6) AS mean_dosage, round(CASE WHEN called THEN d ELSE m END, 6) AS dosage FROM (
            SELECT q.sid, uid, sampleId, x1 >= 0 AND x2 >= 0 AS called, x1 + x2 AS d,
                avg(CASE WHEN x1 >= 0 AND x2 >= 0 THEN x1 + x2 END) OVER (PARTITION BY q.vid) AS m
            FROM qp q JOIN vd x ON x.sid = q.sid AND x.a_index = q.a_index WHERE q.vid NOT IN (
                SELECT vid FROM qr WHERE r NOT IN (SELECT unnest(kept) FROM (SELECT kept FROM qg ORDER BY r DESC LIMIT 1))))""",
        "ld_semi": "SELECT sid, contigName, start FROM vs WHERE p_size > 25",
        "csq_text_parse": """SELECT uid, CHR, POS, REF, ALT, CASE WHEN sid % 3 = 1 THEN 'AC=1;' ELSE '' END || 'CSQ=' || csqs AS INFO, csqs
            FROM csq WHERE uid IN (SELECT uid FROM text_sids)""",
        "csq_parse": """SELECT uid, consequence, EnsemblGeneId, GeneName, exon, intron, transcript, hgvsc, hgvsp, canonical, mane, cds_position,
            protein_position FROM cr""",
        "harmonize": "SELECT uid, transcript, consequence, CAST(priority AS BIGINT) AS priority, variantEffect FROM cr",
        "csq_transcripts": "SELECT uid, transcript, strand, cdsStart, cdsEnd, cdsLength FROM cr JOIN vt USING (transcript)",
        "csq_dbnsfp_left": """SELECT uid, transcript, rsid, ancestralAllele, delMissenseCount, missensePredictions, revel
            FROM cr LEFT JOIN vn USING (uid)""",
        "csq_fields": """SELECT uid, transcript, cds, aa, exon, intron, hgvsc, hgvsp, isAncestralAllele, delMissenseCount, missensePredictions,
            revel, canonical FROM cf""",
        "lof_flags": "SELECT uid, transcript, variantEffect, lofFilters FROM cl",
        "csq_effect_groups": """SELECT uid, EnsemblGeneId, variantEffect, CAST(priority AS BIGINT) AS priority, rsid, revel,
            replace(transcripts, ':', ',') AS transcripts, replace(lofFilters, ':', ';') AS flags FROM eg""",
        "merge_effects": """SELECT uid, EnsemblGeneId, n_effects, effects, worst, canonical_effect, canonical_transcript FROM me""",
        "most_deleterious": "SELECT uid, EnsemblGeneId, "
        + _EFFECT.format(tx="transcripts", canon="affectsCanonical")
        + ", "
        + ", ".join(f"coalesce({c}, '') AS {c}" for c in _LISTS)
        + ", HClof FROM md",
        "canonical_effect": "SELECT me.uid, me.EnsemblGeneId, "
        + _EFFECT.format(tx="transcript", canon="CASE WHEN transcript IS NOT NULL THEN true END")
        + ", "
        + ", ".join(_LISTS)
        + ", HClof FROM me LEFT JOIN mc ON mc.uid = me.uid AND mc.EnsemblGeneId = me.EnsemblGeneId",
        "annotate_full": """SELECT me.uid, me.EnsemblGeneId, me.rsid, me.isAncestralAllele, effects, worst, md.transcripts AS worst_transcripts,
            md.lofFilters AS worst_flags, md.HClof AS worst_confidence, canonical_effect AS canonical, mc.HClof AS canonical_confidence
            FROM me JOIN md ON md.uid = me.uid AND md.EnsemblGeneId = me.EnsemblGeneId
            LEFT JOIN mc ON mc.uid = me.uid AND mc.EnsemblGeneId = me.EnsemblGeneId WHERE me.uid IN (SELECT uid FROM text_sids)""",
        "annot_joinback": """SELECT sid, uid, n AS n_genotypes, m.EnsemblGeneId, m.HClof AS confidence FROM vv
            JOIN (SELECT sid, count(*) AS n FROM vg GROUP BY 1) USING (sid)
            LEFT JOIN (SELECT * EXCLUDE (sid) FROM md WHERE uid IN (SELECT uid FROM text_sids)) m USING (uid)""",
        "meta_lookup": """SELECT 'study_' || n_nationkey AS study, n_name || '.tsv' AS phenotype_file, 'trait_' || n_regionkey AS phenotype,
            CASE WHEN n_nationkey % 2 = 0 THEN 'hg19' ELSE 'hg38' END AS build, CASE WHEN n_nationkey % 3 <> 1 THEN 'imputationInfo' END AS infoScore,
            CASE WHEN n_nationkey % 3 = 0 THEN 'AF.Cases' END AS cases_AF, CAST(100000 + n_nationkey AS BIGINT) AS total_N,
            CAST(1000 + n_nationkey AS BIGINT) AS cases_N FROM nation WHERE n_name = 'NATION_3'""",
        "ss_read": f"SELECT CHR, POS, ID, otherAllele, effectAllele, {_r('SE', 'beta', 'pvalue', 'infoScore')} FROM sr",
        "ss_rename": f"""SELECT CHR, POS, ID, otherAllele, {_r('SE', 'beta', 'effect_AF', 'cases_AF')}, CAST(100000 AS BIGINT) AS total_N,
            CAST(1000 AS BIGINT) AS cases_N, 'study_0' AS study, 'trait_0' AS phenotype FROM sr""",
        "ss_qc": f"""SELECT CHR, POS, ID, otherAllele, effectAllele,
            {_r('SE', 'beta', 'pvalue', 'infoScore', 'effect_AF', 'cases_AF', 'controls_AF')} FROM sc""",
        "ss_funnel": """SELECT CAST(i AS BIGINT) AS step_no, name AS step, count(1) FILTER (WHERE i = 0 OR (upper(effectAllele) <> 'I'
            AND (i < 2 OR (beta IS NOT NULL AND SE IS NOT NULL)) AND (i < 3 OR effect_AF BETWEEN 0.001 AND 0.999)
            AND (i < 4 OR cases_AF * 1000 * 2 > 25) AND (i < 5 OR infoScore > 0.3))) AS n_rows
            FROM sr, (VALUES (0, 'all'), (1, 'acgt'), (2, 'effect_known'), (3, 'effect_AF'), (4, 'case_count'), (5, 'infoScore')) t(i, name)
            GROUP BY 1, 2""",
        "ss_qc_all": f"""SELECT phenotype_file, 'study_' || n AS study, 'trait_' || region AS phenotype,
            CASE WHEN n % 2 = 0 THEN 'hg19' ELSE 'hg38' END AS build, CHR, POS, ID, otherAllele, effectAllele,
            {_r('SE', 'beta', 'pvalue', 'infoScore', 'effect_AF', 'cases_AF', 'controls_AF')},
            concat_ws(';', 'effectAllele=' || effectAllele, 'SE=' || SE, 'beta=' || beta, 'pvalue=' || pvalue, 'infoScore=' || infoScore,
                'effect_AF=' || effect_AF, 'cases_AF=' || cases_AF, 'controls_AF=' || controls_AF,
                'total_N=' || (100000 + n) || ';cases_N=' || (1000 + n) || ';controls_N=99000;phenotype=trait_' || region || ';study=study_' || n) AS INFO
            FROM sa WHERE {' AND '.join(_STEPS)}""",
        "ss_funnel_all": "SELECT phenotype_file, CAST(i AS BIGINT) AS step_no, name AS step, count(1) FILTER (WHERE i = 0"
            + "".join(f" OR (i = {i} AND {' AND '.join(_STEPS[:i])})" for i in range(1, 6))
            + """) AS n_rows FROM sa, (VALUES (0, 'all'), (1, 'acgt'), (2, 'effect_known'), (3, 'effect_AF'), (4, 'case_count'),
            (5, 'infoScore')) t(i, name) GROUP BY 1, 2, 3""",
        "ss_qc_cases_af": "SELECT CHR, POS, ID, otherAllele, effectAllele, round(cases_AF, 6) AS cases_AF FROM sc WHERE cases_AF BETWEEN 0.001 AND 0.999",
        "matrix_roundtrip": """SELECT substr(contigName, 4) AS contigName, vid, start, CAST(vid % 2 + 1 AS BIGINT) AS a_index, n_entries, n_alt
            FROM sv JOIN (SELECT sid * 2 + a_index - 1 AS vid, count(*) AS n_entries,
                          CAST(sum(CASE WHEN x1 >= 0 AND x2 >= 0 THEN x1 + x2 END) AS BIGINT) AS n_alt FROM vd GROUP BY 1) USING (vid)""",
        "ss_info_build": "SELECT CHR, POS, ID, INFO FROM si",
        "ss_vcf_body": r"""SELECT concat_ws(chr(9), CHR, POS, coalesce(ID, '.'), otherAllele, effectAllele, '.', '.', INFO) AS value FROM si""",
        "src_sites_vcf": """SELECT CHR, POS, coalesce(ID, '.') AS ID, otherAllele AS REF, effectAllele AS ALT, '.' AS QUAL, '.' AS FILTER, INFO
            FROM si""",
        "info_parse": f"""SELECT CHR, POS, coalesce(ID, '.') AS ID, effectAllele, 'trait_0' AS phenotype, 'study_0' AS study,
            POS % 2 = 0 AS SwappedAlleles, CAST(NULL AS VARCHAR) AS OriginalContig, CAST(NULL AS BIGINT) AS OriginalStart,
            CAST(100000 AS BIGINT) AS total_N, CAST(NULL AS BIGINT) AS snp_N,
            {_r('beta', 'SE', 'pvalue', 'infoScore', 'effect_AF', 'cases_AF', 'controls_AF')} FROM sc""",
        "swap_fix": """SELECT CHR, POS, coalesce(ID, '.') AS ID, effectAllele,
            CASE WHEN POS % 2 = 0 THEN effectAllele END AS effectAllele_pre_swap,
            round(CASE WHEN POS % 2 = 0 THEN 0 - beta ELSE beta END, 6) AS beta,
            round(CASE WHEN POS % 2 = 0 THEN 1 - effect_AF ELSE effect_AF END, 6) AS effect_AF,
            round(CASE WHEN POS % 2 = 0 THEN 1 - cases_AF ELSE cases_AF END, 6) AS cases_AF,
            round(CASE WHEN POS % 2 = 0 THEN 1 - controls_AF ELSE controls_AF END, 6) AS controls_AF FROM sc""",
        "liftover": "SELECT CHR, POS, coalesce(ID, '.') AS ID, REF, ALT, INFO FROM lo",
        "liftover_reject": "SELECT CHR, POS, coalesce(ID, '.') AS ID, reason AS reject_reason FROM ll WHERE reason IS NOT NULL",
        "liftover_chains": f"""WITH src AS (SELECT s_suppkey AS s, (s_suppkey // 24) * 500000 AS ss FROM supplier),
            blk AS (SELECT {_label('s')} AS c, ss AS b, ss + 200000 AS e, {_label('s')} AS dc, ss + 52 * (s % 5 + 1) AS t, false AS rev, 'a' || s AS name, 1000 + s % 7 AS score FROM src
                UNION ALL SELECT {_label('s')}, ss + 200050, ss + 499000, {_label('s')}, ss + 200050 + 52 * (s % 5 + 2), false, 'a' || s, 1000 + s % 7 FROM src
                UNION ALL SELECT {_label('s')}, ss + CASE WHEN s % 4 = 1 THEN 210000 ELSE 100000 END, ss + 400000, {_label('s + 1')}, ss + 300000 + 13 * (s % 4), s % 3 = 0, 'b' || s, 1000 + s % 5 FROM src),
            far AS (SELECT *, max(e) OVER (PARTITION BY name) AS reach FROM blk),
            r0 AS (SELECT o_orderkey AS k, {_label('o_orderkey')} AS CHR, (o_orderkey // 48) % 3 * 500000 + 1
                + CASE WHEN o_orderkey % 8 = 0 THEN 498940 + o_orderkey % 90 WHEN o_orderkey % 2 = 0 THEN (o_orderkey * 7919) % 520000
                    ELSE 199900 + (o_orderkey * 13) % 220 END AS p,
                CASE o_orderkey % 9 WHEN 0 THEN 60 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS n FROM orders),
            r AS (SELECT *, list_aggregate(list_transform(range(0, n), lambda i: {_base('p + i')}), 'string_agg', '') AS REF,
                CASE WHEN n = 1 THEN {_letter('p * 7 + p // 13 + 1 + k % 3')} ELSE {_base('p')} END AS ALT FROM r0),
            best AS (SELECT k, dc, b, e, t, rev FROM r JOIN far ON c = CHR AND p - 1 >= b AND p - 1 + n <= e
                QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, name, b) = 1),
            hit AS (SELECT k, bool_or(reach >= p - 1 + n) AS goes_on FROM r JOIN far ON c = CHR AND p - 1 >= b AND p - 1 < e GROUP BY k),
            m AS (SELECT r.*, dc, goes_on, CASE WHEN dc IS NULL THEN p WHEN rev THEN t + e - (p - 1 + n) + 1 ELSE t + p - 1 - b + 1 END AS np,
                CASE WHEN rev THEN reverse(translate(REF, 'ACGT', 'TGCA')) ELSE REF END AS nr,
                CASE WHEN rev THEN reverse(translate(ALT, 'ACGT', 'TGCA')) ELSE ALT END AS na FROM r LEFT JOIN best USING (k) LEFT JOIN hit USING (k)),
            j AS (SELECT *, list_aggregate(list_transform(range(0, n), lambda i: {_base('np + i')}), 'string_agg', '') AS tb FROM m),
            w AS (SELECT *, dc IS NOT NULL AND nr <> tb AND n = 1 AND na = tb AS swapped FROM j)
            SELECT CAST(k AS VARCHAR) AS ID, coalesce(dc, CHR) AS CHR, np AS POS, CASE WHEN swapped THEN na ELSE nr END AS REF, CASE WHEN swapped THEN nr ELSE na END AS ALT,
                swapped AS SwappedAlleles, CHR AS OriginalContig, p AS OriginalStart, CASE WHEN dc IS NOT NULL THEN CASE WHEN nr <> tb AND NOT swapped THEN 'MismatchedRefAllele' END
                WHEN goes_on IS NULL THEN 'NoTarget' WHEN goes_on THEN 'IndelStraddlesMultipleIntevals' ELSE 'CannotLiftOver' END AS reject_reason FROM w""",
        "swap_count": "SELECT count(*) AS n_rows, count(1) FILTER (WHERE swapped) AS n_swapped FROM lo",
        "ref_check": """SELECT CHR, POS, coalesce(ID, '.') AS ID, base AS REF, CASE WHEN fixed = 'swap' THEN otherAllele ELSE effectAllele END AS ALT,
            fixed AS ref_fixed FROM rcs""",
        "left_align": f"""SELECT k, CHR, p AS POS,
            CASE WHEN k % 2 = 0 THEN s ELSE substr(s, 1, 1) END AS REF, CASE WHEN k % 2 = 0 THEN substr(s, 1, 1) ELSE s END AS ALT
            FROM (SELECT *, list_aggregate(list_transform(range(0, m + 1), lambda i: {_base('p + i')}), 'string_agg', '') AS s FROM ends)""",
        "uniq_uid": """SELECT concat_ws(':', CHR, POS, 'A', 'C') AS uid, CHR AS chrom, POS AS bp, ID AS marker FROM sr
            QUALIFY count(*) OVER (PARTITION BY CHR, POS) = 1""",
        "harmonised": _HARMONISED.format(total=100000, cases=1000, trait=0, study=0, source="lo"),
        "harmonised_same_build": _HARMONISED.format(
            total=100003,
            cases=1003,
            trait=3,
            study=3,
            source="""(SELECT CHR, POS, ID, base AS REF, CASE WHEN fixed = 'swap' THEN otherAllele ELSE effectAllele END AS ALT, effectAllele,
            CAST(NULL AS VARCHAR) AS oc, CAST(NULL AS BIGINT) AS op, false AS swapped, beta, SE, pvalue, infoScore, effect_AF, cases_AF,
            controls_AF FROM rcn)""",
        ),
        "src_vcf_invalid_loci": """SELECT contigName, start, ref AS referenceAllele, CASE WHEN n_alt = 2 THEN alt1 || ',' || alt2 ELSE alt1 END AS alts,
            sampleId, calls, phased, CAST(depth AS BIGINT) AS depth, CAST(n_depths AS BIGINT) AS n_depths, CAST(ad0 AS BIGINT) AS ad0,
            CAST(NULL AS BIGINT) AS ad1
            FROM vs, (VALUES ('p', '0,1', false, 9, 2, 3), ('q', '-1,-1', false, NULL, 1, NULL), ('r', '1,1', true, NULL, NULL, NULL))
                 t(sampleId, calls, phased, depth, n_depths, ad0)
            WHERE sid % 17 <> 0 AND sid % 13 <> 0 AND sid % 19 <> 0""",
        "src_vcf": """WITH cell AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY s) - 1 AS i FROM ve),
            wide AS (SELECT sid, i FROM (SELECT DISTINCT sid FROM vg), range((SELECT max(n) FROM (SELECT count(*) AS n FROM vg GROUP BY sid))) t(i))
            SELECT contigName, start, start + 1 AS "end", CAST(sid AS VARCHAR) AS sid, 's' || i AS sampleId,
            coalesce(a1 || ',' || a2, '-1,-1') AS calls, coalesce(k % 2 = 0, false) AS phased, dp AS depth, k % 50 AS quality,
            CASE WHEN a1 >= 0 AND a2 >= 0 THEN list_aggregate(list_transform(range(0, (vs.n_alt + 1) * (vs.n_alt + 2) // 2), lambda g:
                CASE WHEN g = greatest(a1, a2) * (greatest(a1, a2) + 1) // 2 + least(a1, a2) THEN 0 ELSE (k * 7 + g * 13) % 60 + 1 END), 'string_agg', ',') END AS likelihoods,
            (k % 8) / 8 AS balance, CASE WHEN k % 5 > 0 THEN 'f' || k % 5 END AS filter
            FROM wide JOIN vs USING (sid) LEFT JOIN (SELECT * EXCLUDE (n_alt) FROM cell) USING (sid, i)""",
        # likelihoods of the old genotypes lo/hi, their number of own alleles, and the least of each class
        "fix_multi_pl": """WITH cell AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY s) - 1 AS i FROM ve),
            wide AS (SELECT sid, i FROM (SELECT DISTINCT sid FROM vg), range((SELECT max(n) FROM (SELECT count(*) AS n FROM vg GROUP BY sid))) t(i)),
            pairs AS (SELECT hi.x AS hi, lo.x AS lo, hi.x * (hi.x + 1) // 2 + lo.x AS g FROM (VALUES (0), (1), (2)) hi(x), (VALUES (0), (1), (2)) lo(x) WHERE lo.x <= hi.x),
            own AS (SELECT sid, i, a_index, k, n_alt, a1, a2, CAST(lo = a_index AS INT) + CAST(hi = a_index AS INT) AS c,
                CASE WHEN g = greatest(a1, a2) * (greatest(a1, a2) + 1) // 2 + least(a1, a2) THEN 0 ELSE (k * 7 + g * 13) % 60 + 1 END AS pl
                FROM cell JOIN (VALUES (1), (2)) t(a_index) ON a_index <= n_alt JOIN pairs ON hi <= n_alt WHERE a1 >= 0 AND a2 >= 0),
            least AS (SELECT sid, i, a_index, c, min(pl) AS pl FROM own GROUP BY ALL),
            three AS (SELECT sid, i, a_index, string_agg(pl, ',' ORDER BY c) AS likelihoods, list(pl ORDER BY pl) AS sorted FROM least GROUP BY ALL),
            coded AS (SELECT wide.*, vs.n_alt, t.a_index, k, a1 >= 0 AND a2 >= 0 AS called, CASE WHEN vs.n_alt = 1 THEN a1 ELSE CAST(a1 = t.a_index AS INT) END AS x1,
                CASE WHEN vs.n_alt = 1 THEN a2 ELSE CAST(a2 = t.a_index AS INT) END AS x2
                FROM wide JOIN vs USING (sid) JOIN (VALUES (1), (2)) t(a_index) ON t.a_index <= vs.n_alt LEFT JOIN (SELECT * EXCLUDE (n_alt) FROM cell) USING (sid, i))
            SELECT CAST(sid AS VARCHAR) AS sid, CAST(a_index AS BIGINT) AS a_index, 's' || i AS sampleId, CASE WHEN NOT coalesce(called, false) THEN '-1,-1'
                ELSE x1 || ',' || x2 END AS calls, likelihoods, CASE WHEN n_alt = 2 THEN coalesce(sorted[2] - sorted[1], k % 50) ELSE k % 50 END AS quality
            FROM coded LEFT JOIN three USING (sid, i, a_index)""",
        "pipe_sites": r"""SELECT concat_ws(chr(9), CHR, POS, coalesce(ID, '.'), otherAllele, effectAllele, '.', '.', INFO, 'seen') AS line FROM si""",
    }
    # the same results from tables laid out beforehand
    q |= {"annotate_stored": q["annotate_full"], "annot_joinback_stored": q["annot_joinback"], "qc_funnel_written": q["qc_funnel"]}
    # only T > ATT has a common suffix: an insertion of AT before the T, which goes left over text that repeats it
    q["site_lookup_normalised"] = f"""WITH plain AS ({q["site_lookup"]}),
        moved AS (SELECT *, REF = 'T' AND ALT = 'ATT' AS indel, list_position(list_transform(range(1, 61), lambda i:
            {_base('POS - i')} <> CASE WHEN i % 2 = 1 THEN 'T' ELSE 'A' END), true) - 1 AS k FROM plain),
        named AS (SELECT * REPLACE (CASE WHEN indel THEN POS - k - 1 ELSE POS END AS POS,
            CASE WHEN indel THEN {_base('POS - k - 1')} ELSE REF END AS REF,
            CASE WHEN indel THEN {_base('POS - k - 1')} || CASE WHEN k % 2 = 0 THEN 'AT' ELSE 'TA' END ELSE ALT END AS ALT) FROM moved)
        SELECT * EXCLUDE (indel, k) REPLACE (POS - 1 AS start, POS - 1 + length(REF) AS "end", concat_ws(':', contigName, POS, REF, ALT) AS uid)
        FROM named"""
    return {name: _sql(text) for name, text in q.items()}
