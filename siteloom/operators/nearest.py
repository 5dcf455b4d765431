"""The nearest features of each variant, by category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteloom.functions.once import compute_once
from siteloom.operators.intervals import bin_intervals, bin_of, range_join
from siteloom.session import BROADCAST_MAX_ROWS

# Reach on either side of a feature, and features kept per category.
REACH = 500_000
NEAREST = 4
VARIANT_KEYS = ("uid", "CHR", "REF", "ALT", "POS")
CODING, OTHER = "nearestProteinCodingGenes", "nearestNonCodingFeatures"
RANK_FIELDS = ("absDistance", "GeneName", "EnsemblGeneId", "biotype", "distance")


def _distance(pos, start, end):
    """0 inside the feature, negative once the variant lies after it, positive before it."""
    return F.when(pos > end, end - pos).when(pos < start, start - pos).otherwise(F.lit(0))


def join_features(df: DataFrame, features: DataFrame, reach: int = REACH) -> DataFrame:
    """Every (variant, feature) pair within ``reach``, with its signed distance."""
    paired = range_join(
        df,
        features,
        contig="CHR",
        pos="POS",
        start="featureStart",
        end="featureEnd",
        pad=reach,
        width=reach,
    )
    return paired.withColumn("distance", _distance(F.col("POS"), F.col("featureStart"), F.col("featureEnd")))


def _ranked_struct(distance, gene_name, gene_id, biotype):
    values = (F.abs(distance), gene_name, gene_id, biotype, distance)
    return F.struct(*[v.alias(n) for v, n in zip(values, RANK_FIELDS)])


def _by_scan(df, features, reach, k):
    """Few features a bin: broadcast them as one array per bin, which each variant filters and ranks in its row."""
    boxed = (
        bin_intervals(features, F.col("featureStart") - reach, F.col("featureEnd") + reach, reach)
        .groupBy("CHR", "_bin")
        .agg(
            F.collect_set(F.struct("featureStart", "featureEnd", "geneId", "GeneName", "biotype")).alias("_near")
        )
    )
    placed = df.withColumn("_bin", bin_of(F.col("POS"), reach)).join(F.broadcast(boxed), ["CHR", "_bin"])
    pos = F.col("POS")

    def top(in_category):
        reachable = F.filter(
            "_near",
            lambda f: in_category(f["biotype"]) & (pos >= f["featureStart"] - reach) & (pos <= f["featureEnd"] + reach),
        )
        ranked = F.transform(
            reachable,
            lambda f: _ranked_struct(
                _distance(pos, f["featureStart"], f["featureEnd"]), f["GeneName"], f["geneId"], f["biotype"]
            ),
        )
        return F.slice(F.sort_array(ranked), 1, k)

    coding = lambda b: F.coalesce(b == "protein_coding", F.lit(False))
    return placed.withColumns({CODING: top(coding), OTHER: top(lambda b: ~coding(b))}).drop("_bin", "_near")


def _first_at(n: Column, holds) -> Column:
    """The least i in 0..n-1 for which ``holds(i)``, which must stay true from there on; n if there is none."""
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int") + 1)

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        lower = F.struct(acc["lo"].alias("lo"), middle.alias("hi"))
        upper = F.struct((middle + 1).alias("lo"), acc["hi"].alias("hi"))
        return F.when(acc["lo"] >= acc["hi"], acc).when(holds(middle), lower).otherwise(upper)

    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


def _index(boxed: DataFrame) -> DataFrame:
    """``_<category>`` of each bin: a struct of sorted arrays ``starts`` and ``ends``, an implicit interval tree.

    They are in order of start and of falling end, then of ranking; ``top`` is the largest end so far along ``starts``.
    One shuffle by bin serves the running ends and the arrays.
    """
    names = ["GeneName", "geneId", "biotype"]
    coding = F.coalesce(F.col("biotype") == "protein_coding", F.lit(False))
    spread = boxed.select("CHR", "_bin", coding.alias("_coding"), "featureStart", "featureEnd", *names).repartition("CHR", "_bin")
    along = Window.partitionBy("CHR", "_bin", "_coding").orderBy("featureStart", *names, "featureEnd")
    top = F.max("featureEnd").over(along.rowsBetween(Window.unboundedPreceding, 0))
    by_start = F.struct("featureStart", *names, "featureEnd", top.alias("top"))
    by_end = F.struct((-F.col("featureEnd")).alias("falling"), *names)
    rows = spread.select("CHR", "_bin", "_coding", by_start.alias("s"), by_end.alias("e"))

    def arrays(own: Column) -> Column:
        starts, ends = (F.sort_array(F.collect_list(F.when(own, F.col(c)))) for c in "se")
        return F.struct(starts.alias("starts"), ends.alias("ends"))

    return rows.groupBy("CHR", "_bin").agg(
        arrays(F.col("_coding")).alias(f"_{CODING}"), arrays(~F.col("_coding")).alias(f"_{OTHER}")
    )


def _nearest_in_index(pos: Column, index: Column, reach: int, k: int) -> Column:
    """The k first of an index by (distance, name, id, type): three searches and at most k steps either way.

    Features over the position lie between the first whose running largest end gets there and the last that starts
    at or before it.
    """
    starts, ends = index["starts"], index["ends"]
    n = F.size(starts)
    after = _first_at(n, lambda i: F.get(starts, i)["featureStart"] > pos)
    over = _first_at(n, lambda i: F.get(starts, i)["top"] >= pos)
    before = _first_at(n, lambda i: -F.get(ends, i)["falling"] < pos)

    def ranked(distance: Column, f: Column) -> Column:
        return _ranked_struct(distance, f["GeneName"], f["geneId"], f["biotype"])

    zero = F.lit(0).cast("bigint")
    inside = F.filter(F.slice(starts, over + 1, F.greatest(after - over, F.lit(0))), lambda f: f["featureEnd"] >= pos)
    right = F.filter(F.slice(starts, after + 1, F.lit(k)), lambda f: f["featureStart"] <= pos + reach)
    left = F.filter(F.slice(ends, before + 1, F.lit(k)), lambda f: -f["falling"] >= pos - reach)
    near = F.concat(
        F.transform(left, lambda f: ranked((-f["falling"] - pos).cast("bigint"), f)),
        F.transform(inside, lambda f: ranked(zero, f)),
        F.transform(right, lambda f: ranked((f["featureStart"] - pos).cast("bigint"), f)),
    )
    return F.slice(F.sort_array(near), 1, k)


def _by_index(df, features, reach, k):
    """Crowded bins: broadcast the features them as sorted arrays per bin and category, which each variant searches in its row."""
    boxed = bin_intervals(features, F.col("featureStart") - reach, F.col("featureEnd") + reach, reach)
    placed = df.withColumn("_bin", bin_of(F.col("POS"), reach)).join(F.broadcast(_index(boxed)), ["CHR", "_bin"])
    found = {name: _nearest_in_index(F.col("POS"), F.col(f"_{name}"), reach, k) for name in (CODING, OTHER)}
    # the filter on the results must not evaluate the searches a second time
    return compute_once(placed, found).drop("_bin", *[f"_{name}" for name in found])


def _by_rank(df, features, reach, k, keys):
    """Many features: salted bin join, then the k first per (variant, category).

    The rank filter becomes a partial group limit, so at most k pairs per category and variant of a task
    are shuffled.
    """
    ranked = (
        join_features(df, features, reach)
        .select(
            *keys,
            F.coalesce(F.col("biotype") == "protein_coding", F.lit(False)).alias("_coding"),
            _ranked_struct(F.col("distance"), F.col("GeneName"), F.col("geneId"), F.col("biotype")).alias("_f"),
        )
        .withColumn(
            "_rank",
            F.row_number().over(Window.partitionBy(*keys, "_coding").orderBy("_f")),
        )
        .where(F.col("_rank") <= k)
    )

    def gather(coding: bool):
        chosen = F.when(F.col("_coding") == F.lit(coding), F.col("_f"))
        return F.sort_array(F.collect_list(chosen))

    return ranked.groupBy(*keys).agg(gather(True).alias(CODING), gather(False).alias(OTHER))


def nearest_genes(
    df: DataFrame,
    features: DataFrame,
    cols_2_include: Sequence[str] = (),
    *,
    reach: int = REACH,
    k: int = NEAREST,
    keep_empty: bool = False,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    max_scan_features: int = 512,
) -> DataFrame:
    """The k nearest protein-coding genes and k nearest other features within ``reach`` of each variant.

    ``features``: CHR, featureStart, featureEnd, geneId, GeneName, biotype. One row per distinct variant
    (keys plus ``cols_2_include``); a category without features gives an empty array. Variants without any
    feature are left out unless ``keep_empty``.

    The feature table is broadcast as arrays per bin only when its rows, repeated over the bins they cover, were counted
    to be few. Up to ``max_scan_features`` in the fullest bin a variant looks at its whole bin, beyond at a few binary
    searches' worth of it; the rows are the same. A larger table, or one with crowded bins in which features end before
    their start, takes the salted join path.
    """
    keys = [*VARIANT_KEYS, *cols_2_include]
    variants = df.select(*keys).distinct()
    features = features.select("CHR", "featureStart", "featureEnd", "geneId", "GeneName", "biotype").distinct()
    fullest, few, turned = _crowding(features, reach, max_broadcast_rows)
    if few and (fullest <= max_scan_features or not turned):
        by_bin = _by_scan if fullest <= max_scan_features else _by_index
        found = by_bin(variants, features, reach, k).where((F.size(CODING) > 0) | (F.size(OTHER) > 0))
    else:
        found = _by_rank(variants, features, reach, k, keys)
    found = found.select(*keys, CODING, OTHER)
    if not keep_empty:
        return found
    empty = F.array().cast(found.schema[CODING].dataType)
    return (
        variants.join(found, keys, "left")
        .withColumns({c: F.coalesce(c, empty) for c in (CODING, OTHER)})
        .select(*keys, CODING, OTHER)
    )


def _crowding(features: DataFrame, reach: int, max_rows: int) -> tuple[int, bool, bool]:
    """One small aggregate: features of the fullest bin, are all bins together few, does any end before its start."""
    counts = (
        bin_intervals(features, F.col("featureStart") - reach, F.col("featureEnd") + reach, reach)
        .groupBy("CHR", "_bin")
        .agg(F.count(F.lit(1)).alias("count"), F.max(F.col("featureEnd") < F.col("featureStart")).alias("turned"))
        .agg(F.max("count").alias("fullest"), F.sum("count").alias("rows"), F.max("turned").alias("turned"))
        .first()
    )
    return counts["fullest"] or 0, (counts["rows"] or 0) <= max_rows, bool(counts["turned"])
