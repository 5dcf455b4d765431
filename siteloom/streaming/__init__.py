"""Which operators also take a streaming DataFrame.

The work reproduced here is batch only: it has no watermark, window or state. The row-local operators are
stateless expressions, so they accept the output of ``readStream`` unchanged; they are listed here and there
is no separate streaming API.
"""

from siteloom.operators import csq, genotypes, harmonise, multiallelic, sites, sumstats

STATELESS = (
    sites.uid_to_site,
    sites.site_to_uid,
    sites.strip_contig,
    genotypes.process_genotypes,
    genotypes.call_summary_stats,
    genotypes.hardy_weinberg,
    genotypes.drop_hom_ref,
    genotypes.mean_impute,
    multiallelic.split_multiallelics,
    multiallelic.correct_multiallelics,
    csq.parse_csq,
    csq.harmonize_consequence,
    sumstats.info_text,
    harmonise.parse_info,
    harmonise.swap_fix,
)
