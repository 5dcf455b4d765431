"""Moving variant rows between genome builds, and checking alleles against the reference text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions import alleles
from siteloom.functions.once import compute_once
from siteloom.operators.intervals import INDEX_MAX_ENTRIES, index_join, interval_index
from siteloom.session import small_side, stored

CHUNK = 10_000
# Bins of the chain index: few blocks touch one, and a genome has about 47,000.
CHAIN_BIN = 1 << 16
# The reject reasons that users of lifted files know.
NO_TARGET, SPLIT_TARGET, MISMATCH, GAP = "NoTarget", "CannotLiftOver", "MismatchedRefAllele", "IndelStraddlesMultipleIntevals"


def reference_bases(df: DataFrame, reference: DataFrame, length: Column, size: int = CHUNK) -> DataFrame:
    """Add ``ref_bases``: the reference text of ``length`` bases from (CHR, POS); shorter or NULL off the reference.

    ``reference`` is ref_chunk(contig, chunk, seq) with ``size`` bases per chunk. Every row is joined to the text
    that begins with the chunk of its first base. Where some allele reaches past its chunk, that text is continued
    by all the chunks the longest such allele covers, so the result doesn't depend on the chunk size; chunks without
    such an allele, nearly all, stay as they are.

    Text is far longer than a planner that goes by columns takes it for. So it is joined by sort and merge, and streamed
    past the few rows that continue a chunk: no join may send it through the driver.
    """
    chunks = reference.select(F.col("contig").alias("_contig"), F.col("chunk").alias("_chunk"), F.col("seq").alias("_text"))
    offset = F.col("POS") - 1
    first, last = F.floor(offset / size).cast("bigint"), F.floor((offset + length - 1) / size).cast("bigint")
    reach = df.where(last > first).select(F.col("CHR").alias("_contig"), first.alias("_from"), last.alias("_to"))
    reach = reach.groupBy("_contig", "_from").agg(F.max("_to").alias("_to"))
    more = reach.select("_contig", "_from", F.explode(F.sequence(F.col("_from") + 1, F.col("_to"))).alias("_chunk"))
    pieces = more.hint("shuffle_hash").join(chunks, ["_contig", "_chunk"]).groupBy("_contig", F.col("_from").alias("_chunk"))
    more = pieces.agg(F.sort_array(F.collect_list(F.struct("_chunk", "_text"))).alias("_pieces"))
    more = more.select("_contig", "_chunk", F.array_join(F.col("_pieces")["_text"], "").alias("_more"))
    text = chunks.join(more.hint("merge"), ["_contig", "_chunk"], "left").select(
        "_contig", "_chunk", F.concat("_text", F.coalesce("_more", F.lit(""))).alias("_text")
    )
    joined = df.join(text.hint("merge"), (F.col("CHR") == F.col("_contig")) & (first == F.col("_chunk")), "left")
    found = F.substring("_text", (offset % size + 1).cast("int"), length.cast("int"))
    return compute_once(joined, {"ref_bases": found}).drop("_contig", "_chunk", "_text")


def chain_index(chain: DataFrame, width: int = CHAIN_BIN) -> DataFrame:
    """The alignment blocks of each bin, those of the best chain first: by score, then chain, then place.

    Each block carries how far its chain ``reaches``. Without ``chainId`` every block is a chain of its own; without
    ``score`` all chains are equally good.
    """
    own = F.concat_ws(":", "srcContig", "srcStart", "srcEnd", "dstContig", "dstStart", "strand")
    known = {c.lower() for c in chain.columns}
    blocks = chain.select(
        F.col("srcContig").alias("CHR"),
        F.col("srcStart").cast("bigint").alias("srcStart"),
        F.col("srcEnd").cast("bigint").alias("srcEnd"),
        (F.col("srcEnd") - 1).alias("_last"),
        "dstContig",
        F.col("dstStart").cast("bigint").alias("dstStart"),
        "strand",
        (F.col("chainId").cast("string") if "chainid" in known else own).alias("chainId"),
        (-F.col("score").cast("double") if "score" in known else F.lit(0.0)).alias("rank"),
    )
    if "chainid" in known:
        ends = blocks.groupBy("chainId").agg(F.max("srcEnd").alias("reaches"))
        blocks = blocks.join(small_side(ends, INDEX_MAX_ENTRIES), "chainId")
    else:
        blocks = blocks.withColumn("reaches", F.col("srcEnd"))
    entry = F.struct("rank", "chainId", "srcStart", "srcEnd", "reaches", "dstContig", "dstStart", "strand")
    return interval_index(blocks, contig="CHR", start="srcStart", end="_last", width=width, entry=entry)


def map_positions(df: DataFrame, chain: DataFrame) -> DataFrame:
    """Place rows on the target build: new CHR, POS, REF, ALT plus the OriginalContig, OriginalStart and
    OriginalAlleles they came from. ``reject_reason`` is set, and the place left alone, where there is none.

    ``chain``: srcContig, srcStart, srcEnd (0-based half-open), dstContig, dstStart, strand, and optionally chainId and
    score. Blocks of different chains may overlap: a row takes the block of the best chain that holds its whole
    span, so every row comes out once for any chain table. On a reverse block the span is counted from the block's
    end and both alleles are reverse-complemented. A span that begins in a block and leaves it is rejected, with a
    reason of its own where that chain goes on behind a gap.
    """
    placed = index_join(
        df.withColumn("_start", F.col("POS") - 1), chain_index(chain), contig="CHR", pos="_start", width=CHAIN_BIN
    )
    span_end = F.col("_start") + F.length("REF")
    begun = F.filter("entries", lambda e: (e["srcStart"] <= F.col("_start")) & (F.col("_start") < e["srcEnd"]))
    placed = compute_once(placed, {"_begun": begun}).drop("entries")
    whole = F.get(F.filter("_begun", lambda e: e["srcEnd"] >= span_end), F.lit(0))
    goes_on = F.exists("_begun", lambda e: e["reaches"] >= span_end)
    reason = F.when(F.coalesce(F.size("_begun"), F.lit(0)) <= 0, NO_TARGET).when(goes_on, GAP).otherwise(SPLIT_TARGET)
    placed = compute_once(placed, {"_block": whole, "_reason": reason}).drop("_begun")
    placed = placed.withColumn("reject_reason", F.when(F.col("_block").isNull(), F.col("_reason")))
    block = F.col("_block")
    forward = block["dstStart"] + F.col("_start") - block["srcStart"] + 1
    reverse = block["dstStart"] + block["srcEnd"] - span_end + 1
    reversed_ = block["strand"] == "-"
    ok = F.col("reject_reason").isNull()

    def allele(name: str) -> Column:
        return F.when(ok & reversed_, alleles.reverse_complement(F.col(name))).otherwise(F.col(name))

    kept = [c for c in df.columns if c not in ("CHR", "POS", "REF", "ALT")]
    return placed.select(
        F.when(ok, block["dstContig"]).otherwise(F.col("CHR")).alias("CHR"),
        F.when(ok, F.when(reversed_, reverse).otherwise(forward)).otherwise(F.col("POS")).alias("POS"),
        allele("REF").alias("REF"),
        allele("ALT").alias("ALT"),
        *kept,
        F.col("CHR").alias("OriginalContig"),
        F.col("POS").alias("OriginalStart"),
        F.concat_ws(",", "REF", "ALT").alias("OriginalAlleles"),
        "reject_reason",
    )


def liftover(df: DataFrame, chain: DataFrame, reference: DataFrame, size: int = CHUNK) -> DataFrame:
    """Lift VCF body rows; every input row comes out once, with ``reject_reason`` NULL when lifted.

    A lifted row's REF must be the target base. Where only ALT is, a single-base row is recovered by
    exchanging the alleles and flagged ``SwappedAlleles`` (also an INFO flag). INFO gets the original place.
    The mapped rows are written to the shared folder once, so that the lookup of reference text, which needs them
    twice, doesn't read and map the source twice.
    """
    placed = stored(map_positions(df, chain), "mapped")
    checked = reference_bases(placed, reference, F.length("REF"), size)
    single = (F.length("REF") == 1) & (F.length("ALT") == 1)
    ok = F.col("reject_reason").isNull()
    matches = F.coalesce(F.col("REF") == F.col("ref_bases"), F.lit(False))
    swapped = ok & ~matches & single & F.coalesce(F.col("ALT") == F.col("ref_bases"), F.lit(False))
    judged = checked.withColumn("SwappedAlleles", swapped).withColumn(
        "reject_reason",
        F.when(ok & ~matches & ~F.col("SwappedAlleles"), MISMATCH).otherwise(F.col("reject_reason")),
    )
    flipped = F.col("SwappedAlleles")
    changed = F.concat_ws(",", "REF", "ALT") != F.col("OriginalAlleles")
    final = judged.withColumn("_ref", F.when(flipped, F.col("ALT")).otherwise(F.col("REF"))).withColumn(
        "_alt", F.when(flipped, F.col("REF")).otherwise(F.col("ALT"))
    )
    lifted = F.col("reject_reason").isNull()
    tokens = [
        F.col("INFO"),
        F.concat(F.lit("OriginalContig="), F.col("OriginalContig")),
        F.concat(F.lit("OriginalStart="), F.col("OriginalStart").cast("string")),
        F.when(changed | flipped, F.concat(F.lit("OriginalAlleles="), F.col("OriginalAlleles"))),
        F.when(flipped, F.lit("SwappedAlleles")),
    ]
    columns = [c for c in df.columns if c not in ("CHR", "POS", "REF", "ALT", "INFO")]
    return final.select(
        "CHR",
        "POS",
        F.col("_ref").alias("REF"),
        F.col("_alt").alias("ALT"),
        *columns,
        F.when(lifted, F.concat_ws(";", *tokens)).otherwise(F.col("INFO")).alias("INFO"),
        "OriginalContig",
        "OriginalStart",
        "SwappedAlleles",
        "reject_reason",
    )


VCF_BODY = ["CHR", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]


def lifted_rows(df: DataFrame) -> DataFrame:
    """The body rows that found a place."""
    return df.where(F.col("reject_reason").isNull()).select(*VCF_BODY)


def rejected_rows(df: DataFrame) -> DataFrame:
    """The rows that did not, at their original place, with the reason."""
    original = df.where(F.col("reject_reason").isNotNull())
    return original.select(
        F.col("OriginalContig").alias("CHR"),
        F.col("OriginalStart").alias("POS"),
        *[c for c in VCF_BODY[2:] if c not in ("REF", "ALT")],
        "reject_reason",
    )


def count_swapped(df: DataFrame) -> DataFrame:
    """Rows whose INFO carries the SwappedAlleles flag: one row (n_rows, n_swapped)."""
    flagged = F.array_contains(F.split("INFO", ";"), "SwappedAlleles")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(flagged).alias("n_swapped"),
    )
