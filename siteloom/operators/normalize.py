"""Fixing REF against the reference, and left-aligning indels (Tan, Abecasis & Kang 2015)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions.once import compute_once
from siteloom.operators.liftover import CHUNK, reference_bases
from siteloom.session import checkpoint

NEAR = 64  # bases of left context joined in the first pass; later passes use ever more


def fix_reference(df: DataFrame, reference: DataFrame, size: int = CHUNK) -> DataFrame:
    """Make REF the reference text. ``ref_fixed``: "none" when it was, "swap" when ALT was and the alleles
    are exchanged, "set" when neither was and REF is replaced, NULL where the reference does not reach."""
    longest = F.greatest(F.length("REF"), F.length("ALT"))
    checked = reference_bases(df, reference, longest, size)
    begins = lambda allele: F.col("ref_bases").startswith(F.col(allele))
    fixed = checked.withColumn(
        "ref_fixed",
        F.when(F.coalesce(F.length("ref_bases"), F.lit(0)) < F.length("REF"), F.lit(None))
        .when(begins("REF"), "none")
        .when(begins("ALT"), "swap")
        .otherwise("set"),
    )
    swap, replace = F.col("ref_fixed") == "swap", F.col("ref_fixed") == "set"
    ref = F.when(swap, F.col("ALT")).when(replace, F.expr("left(ref_bases, length(REF))")).otherwise(F.col("REF"))
    alt = F.when(swap, F.col("REF")).otherwise(F.col("ALT"))
    return fixed.withColumns({"REF": ref, "ALT": alt}).drop("ref_bases")


def single_bases() -> Column:
    """Rows whose alleles are one base each."""
    return F.coalesce((F.length("REF") == 1) & (F.length("ALT") == 1), F.lit(True))


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two strings."""
    n = F.least(F.length(a), F.length(b))
    letters = lambda s: F.split(F.substring(s, F.lit(1), n), "")
    differs = F.zip_with(letters(a), letters(b), lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differs, True)
    return F.when(n == 0, 0).when(at > 0, (at - 1).cast("int")).otherwise(n)


def _with_left_context(df: DataFrame, reference: DataFrame, size: int, reach: int) -> DataFrame:
    """Add ``_left``: up to ``reach`` (at most ``size``) bases before POS, nearest base first."""
    text = reference.select(
        F.col("contig").alias("_contig"), F.col("chunk").alias("_chunk"), F.col("seq").alias("_text")
    )
    before = text.select("_contig", (F.col("_chunk") + 1).alias("_chunk"), F.right("_text", F.lit(reach)).alias("_before"))
    # merge joins: reference text must not be broadcast, whatever its planned size
    context = text.join(before.hint("merge"), ["_contig", "_chunk"], "left").select(
        "_contig",
        "_chunk",
        F.concat(F.coalesce("_before", F.lit("")), "_text").alias("_text"),
        F.length(F.coalesce("_before", F.lit(""))).alias("_lead"),
    )
    offset = F.col("POS") - 1
    here = (F.col("CHR") == F.col("_contig")) & (F.floor(offset / size).cast("bigint") == F.col("_chunk"))
    end = F.col("_lead") + (offset % size).cast("int")
    n = F.least(F.lit(reach), end)
    left = F.reverse(F.substring("_text", end - n + 1, n))
    return compute_once(df.join(context.hint("merge"), here, "left"), {"_left": left}).drop("_contig", "_chunk", "_text", "_lead")


def _align(df: DataFrame, reference: DataFrame, size: int, reach: int) -> DataFrame:
    """One pass over rows with a multi-base allele; ``_more`` marks those that used all their context.

    After the common suffix is cut, a row with an empty side is a pure insertion or deletion of text S. It
    moves left by k, the length over which the text to its left reads like S repeated backwards; S rotates
    by k and the base before it becomes the anchor.
    """
    row = (
        _with_left_context(df, reference, size, reach)
        .withColumn("_s", _common_prefix(F.reverse("REF"), F.reverse("ALT")))
        .withColumn("_r", F.left("REF", F.length("REF") - F.col("_s")))
        .withColumn("_a", F.left("ALT", F.length("ALT") - F.col("_s")))
        .withColumn("_indel", F.concat("_r", "_a"))
        .withColumn("_m", F.length("_indel"))
        .withColumn("_reach", F.coalesce(F.length("_left"), F.lit(0)))
        .withColumn(
            "_pure",
            ((F.length("_r") == 0) | (F.length("_a") == 0)) & (F.col("_m") > 0) & (F.col("_reach") > 0),
        )
        .withColumn("_mixed", (F.length("_r") > 0) & (F.length("_a") > 0))
    )

    times = F.ceil(F.col("_reach") / F.col("_m")).cast("int")
    moved = (
        row.withColumn(
            "_run", F.when(F.col("_pure"), _common_prefix(F.col("_left"), F.repeat(F.reverse("_indel"), times)))
        )
        .withColumn("_k", F.least(F.col("_run"), F.col("_reach") - 1))
        .withColumn("_turn", F.when(F.col("_pure"), F.col("_k") % F.col("_m")))
        .withColumn("_text", F.concat(F.right("_indel", F.col("_turn")), F.left("_indel", F.col("_m") - F.col("_turn"))))
        .withColumn("_anchor", F.substring("_left", F.col("_k") + 1, F.lit(1)))
        .withColumn(
            "_p",
            F.when(
                F.col("_mixed"),
                F.least(_common_prefix(F.col("_r"), F.col("_a")), F.length("_r") - 1, F.length("_a") - 1),
            ),
        )
    )

    def allele(original: str, cut: str) -> Column:
        text = F.when(F.length(cut) > 0, F.concat("_anchor", "_text")).otherwise(F.col("_anchor"))
        rest = F.substring(cut, F.col("_p") + 1, F.length(cut))
        return F.when(F.col("_pure"), text).when(F.col("_mixed"), rest).otherwise(F.col(original))

    place = (
        F.when(F.col("_pure"), F.col("POS") - F.col("_k") - 1)
        .when(F.col("_mixed"), F.col("POS") + F.col("_p"))
        .otherwise(F.col("POS"))
    )
    more = F.col("_pure") & (F.col("_run") == F.col("_reach")) & (F.col("POS") - F.col("_reach") > 1)
    changed = {"POS": place, "REF": allele("REF", "_r"), "ALT": allele("ALT", "_a")}
    return moved.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns], more.alias("_more"))


def left_align(df: DataFrame, reference: DataFrame, size: int = CHUNK) -> DataFrame:
    """Parsimonious, left-most form of every row (CHR, POS, REF, ALT upper case, REF as in the reference).

    Single-base rows bypass everything. Others get the few bases before them; those whose repeat runs past
    these go round again, from where they got to, with ever more context until none is left.
    """
    plain = single_bases()
    done, reach = df.where(plain), min(NEAR, size)
    aligned = checkpoint(_align(df.where(~plain), reference, size, reach))
    while True:
        done = done.unionByName(aligned.where(~F.col("_more")).drop("_more"))
        left_over = aligned.where("_more").drop("_more")
        if left_over.isEmpty():
            return done
        reach = min(reach * 8, size)
        aligned = checkpoint(_align(left_over, reference, size, reach))
