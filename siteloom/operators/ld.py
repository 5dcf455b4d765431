"""Linkage disequilibrium: r-squared of nearby sites, and pruning to a set without linked pairs.

Genotypes are packed in the row into 64-sample words of three bit planes (called, >=1 alt, 2 alt). Every sum a
correlation needs is then a population count of two ANDed words, so a pair of sites costs one joined row, counts
stay exact integers and no genotype array is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions import calls
from siteloom.functions.once import compute_once
from siteloom.operators.intervals import pairs_within
from siteloom.session import checkpoint, stored

# Pruning threshold and window (base pairs).
MAX_R2 = 0.6
WINDOW = 75_000


def pack_words(df: DataFrame, key: str, sample_index=None) -> DataFrame:
    """(contigName, start, key, n, s, d, words) from biallelic rows with genotypes.

    ``words`` is an array, one struct (w, called, one, two) for each 64 samples, numbered w in the order of the samples'
    numbers. Words without a genotype of the site are left out, so a site costs as much as it holds genotypes, however
    large the numbers are. Over the called samples: their number n, the dosage sum s, and d = n * sum(x * x) - s * s,
    which is n times the sum of squared deviations and zero for a constant site. ``sample_index`` maps the genotype
    struct to the sample's number; by default it is the position in the array.
    """
    bigint = lambda value: F.lit(value).cast("bigint")
    number = (lambda g, i: i) if sample_index is None else (lambda g, i: sample_index(g))
    entries = F.transform(
        "genotypes",
        lambda g, i: F.struct(number(g, i).cast("bigint").alias("i"), calls.alt_dosage(g["calls"]).cast("bigint").alias("x")),
    )
    names = ("n", "s", "q", "called", "one", "two")
    zero = F.struct(*[bigint(0).alias(name) for name in names])

    def add(acc: Column, e: Column) -> Column:
        x, bit = e["x"], F.call_function("shiftleft", bigint(1), (e["i"] % 64).cast("int"))
        values = (
            acc["n"] + 1,
            acc["s"] + x,
            acc["q"] + x * x,
            acc["called"].bitwiseOR(bit),
            acc["one"].bitwiseOR(F.when(x >= 1, bit).otherwise(bigint(0))),
            acc["two"].bitwiseOR(F.when(x >= 2, bit).otherwise(bigint(0))),
        )
        return F.when(x.isNull(), acc).otherwise(F.struct(*[v.alias(c) for v, c in zip(values, names)]))

    def packed(e: Column) -> Column:
        if sample_index is None:  # in column order a word is a slice; with other numbers its entries are picked out
            held = F.sequence(bigint(0), F.floor((F.size(e) - 1) / 64).cast("bigint"))
        else:
            held = F.array_sort(F.array_distinct(F.transform(F.filter(e, lambda x: x["i"] >= 0), lambda x: F.floor(x["i"] / 64))))

        def word(w: Column) -> Column:
            own = F.slice(e, (w * 64 + 1).cast("int"), 64) if sample_index is None else F.filter(e, lambda x: F.floor(x["i"] / 64) == w)
            return F.struct(w.alias("w"), F.aggregate(own, zero, add).alias("t"))

        return F.transform(F.when(F.size(e) > 0, held).otherwise(F.array().cast("array<bigint>")), word)

    message = F.lit("LD needs split rows: a site has several alternate alleles")
    kind = "array<struct<w:bigint,t:struct<" + ",".join(f"{c}:bigint" for c in names) + ">>>"
    bound = F.transform(F.array(entries), packed)[0]
    words = F.when(F.size("alternateAlleles") > 1, F.raise_error(message).cast(kind)).otherwise(bound)
    once = compute_once(df.select("contigName", "start", key, "alternateAlleles", "genotypes"), {"words": words})
    total = {c: F.aggregate(F.col("words.t")[c], bigint(0), lambda t, v: t + v) for c in ("n", "s", "q")}
    summed = compute_once(once.select("contigName", "start", key, "words"), total)
    planes = F.transform("words", lambda w: F.struct(w["w"].alias("w"), *[w["t"][c].alias(c) for c in names[3:]]))
    d = F.col("n") * F.col("q") - F.col("s") * F.col("s")
    return summed.select("contigName", "start", key, "n", "s", d.alias("d"), planes.alias("words"))


def _spreads(packed: DataFrame) -> DataFrame:
    """Adds ``reach`` and ``grip``: squares of the absolute and of the half range of deviations, over their square sum.

    Genotype counts follow from n, s and d. Deviations u of a site add up to zero and those of another, v, lie in a
    range of width w (uncalled samples stand at zero, inside it), so |<u, v>| <= sum|u| * w / 2. Hence r2 of a pair is
    at most ``reach`` of either site times ``grip`` of the other.
    """
    n, s, d = (F.col(c).cast("double") for c in ("n", "s", "d"))
    squares = F.round((d + s * s) / n)
    two, mean = F.floor((squares - s) / 2), s / n
    one = s - 2 * two
    none = n - one - two
    absolute = none * mean + one * F.abs(1 - mean) + two * (2 - mean)
    width = F.when(two > 0, 2.0).otherwise(1.0) - F.when(none > 0, 0.0).otherwise(1.0)
    return packed.withColumns({"reach": absolute * absolute * n / d, "grip": width * width / 4 * n / d})


def linkable(min_r2: float) -> Column:
    """Can a pair reach ``min_r2`` by the allele frequencies of its sites? A condition on columns of ``_spreads``."""
    least = F.lit(min_r2 * (1 - 1e-9))
    return (F.col("a_reach") * F.col("b_grip") >= least) & (F.col("b_reach") * F.col("a_grip") >= least)


def site_pairs(df: DataFrame, key: str, window: int = WINDOW) -> DataFrame:
    """Site pairs on one contig within ``window``: (contigName, a_start, a_<key>, b_start, b_<key>)."""
    return pairs_within(
        df.select("contigName", "start", key), contig="contigName", pos="start", key=key, window=window
    )


def ld_r2(df: DataFrame, key: str, window: int = WINDOW, sample_index=None, min_r2: float | None = None) -> DataFrame:
    """Squared correlation of mean-imputed dosages for pairs within ``window`` (at least ``min_r2``, if given).

    Imputed values sit at the mean, so only samples called at both sites enter the covariance. It is formed
    from integer sums, scaled by both called counts, so nothing cancels; the products are decimals, which hold
    them for any cohort below 300 million samples. Pairs without a shared called sample, or with a constant site,
    have no correlation and give no row. A row with several alternate alleles is an error: split first.

    With ``min_r2``, pairs whose allele frequencies allow no such correlation are left out in the join, by a few
    numbers a site, before any word is compared: rare sites then meet only sites about as rare.
    """
    # the fold of all genotypes is the dearest step and the pairing needs it three times, so it is written once
    packed = stored(pack_words(df, key, sample_index).where(F.col("d") > 0), "ld-packed")
    keep = None
    if min_r2 is not None:
        packed, keep = _spreads(packed), linkable(min_r2)
    joined = pairs_within(packed, contig="contigName", pos="start", key=key, window=window, crowd=512, keep=keep)
    zero = F.struct(*[F.lit(0).cast("bigint").alias(name) for name in ("n", "xy", "x", "y")])

    def common(x: Column, y: Column) -> Column:
        return F.bit_count(x.bitwiseAND(y)).cast("bigint")

    def counted(a: Column, b: Column) -> Column:
        product = sum((common(a[x], b[y]) for x in ("one", "two") for y in ("one", "two")), F.lit(0))
        return F.struct(
            common(a["called"], b["called"]).alias("n"),
            product.alias("xy"),
            (common(a["one"], b["called"]) + common(a["two"], b["called"])).alias("x"),
            (common(a["called"], b["one"]) + common(a["called"], b["two"])).alias("y"),
        )

    def both(words: str) -> Column:
        """The words of one site that the other has too; sites of one cohort's columns mostly have the same."""
        return F.when(F.col("_same"), F.col(words)).otherwise(F.filter(words, lambda w: F.array_contains("_shared", w["w"])))

    each = F.zip_with(both("a_words"), both("b_words"), counted)
    sums = F.aggregate(each, zero, lambda t, w: F.struct(*[(t[c] + w[c]).alias(c) for c in ("n", "xy", "x", "y")]))
    pair = ["contigName", f"a_{key}", f"b_{key}"]
    totals = [f"{side}_{name}" for side in "ab" for name in ("n", "s", "d")]
    a_at, b_at = F.col("a_words")["w"], F.col("b_words")["w"]
    at = {"_same": a_at == b_at, "_shared": F.when(a_at != b_at, F.array_intersect(a_at, b_at))}
    matched = compute_once(joined.select(*pair, *totals, "a_words", "b_words"), at)
    met = compute_once(matched, {"_t": sums}).select(*pair, *totals, "_t")
    exact = {c: F.col(c).cast("decimal(10,0)") for c in totals if not c.endswith("_d")}
    na, sa, nb, sb = (exact[c] for c in ("a_n", "a_s", "b_n", "b_s"))
    n, xy, x, y = (F.col(f"_t.{c}").cast("decimal(10,0)") for c in ("n", "xy", "x", "y"))
    covariance = na * nb * xy - sa * nb * y - sb * na * x + sa * sb * n
    scaled = covariance.cast("double")
    spread = (F.col("a_n").cast("double") * F.col("a_d").cast("double")) * (F.col("b_n").cast("double") * F.col("b_d").cast("double"))
    found = met.where(F.col("_t.n") > 0).select(
        *pair,
        F.col("_t.n").alias("n_both"),
        (F.col("a_s") / F.col("a_n")).alias("a_mean"),
        (F.col("b_s") / F.col("b_n")).alias("b_mean"),
        (scaled * scaled / spread).alias("r2"),
    )
    return found if min_r2 is None else found.where(F.col("r2") >= min_r2)


def _rank(mean: Column, key: Column, tie: Column | None) -> Column:
    """Higher minor-allele frequency first; ties in hash order, which keeps dependency chains short."""
    frequency = mean / 2
    first = -F.least(frequency, 1 - frequency)
    return F.struct(first.alias("f"), (F.xxhash64(key) if tie is None else tie).alias("t"), key.alias("k"))


def linked_away(pairs: DataFrame, key: str, max_r2: float = MAX_R2, tie_by_key: bool = False) -> DataFrame:
    """Keys to remove so that no linked pair is left: greedy in rank order, run in parallel rounds.

    A round keeps each site ranked before all its undecided neighbours and removes those neighbours; their
    edges go with them. What is never removed is kept, so only removals are recorded. The result equals one
    sequential pass in rank order.
    """

    def rank(side: str) -> Column:
        own = F.col(f"{side}_{key}")
        return _rank(F.col(f"{side}_mean"), own, own if tie_by_key else None)

    linked = pairs.where(F.col("r2") >= max_r2).select(rank("a").alias("a"), rank("b").alias("b"))
    edges = checkpoint(
        linked.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
            linked.select(F.col("b").alias("src"), F.col("a").alias("dst"))
        )
    )
    removed = edges.select(F.col("src.k").alias(key)).limit(0)
    while not edges.isEmpty():
        first = edges.groupBy("src").agg(F.min("dst").alias("next")).where(F.col("src") < F.col("next")).select("src")
        gone = checkpoint(edges.join(first, "src", "left_semi").select("dst").distinct())
        edges = checkpoint(
            edges.join(gone, "dst", "left_anti").join(gone.withColumnRenamed("dst", "src"), "src", "left_anti")
        )
        removed = removed.unionByName(gone.select(F.col("dst.k").alias(key)))
    return removed


def ld_prune(
    df: DataFrame,
    key: str,
    max_r2: float = MAX_R2,
    window: int = WINDOW,
    sample_index=None,
    tie_by_key: bool = False,
) -> DataFrame:
    """Rows of ``df`` after pruning: no two within ``window`` keep r2 >= ``max_r2``. Rows must be split."""
    linked = ld_r2(df, key, window, sample_index, min_r2=max_r2)
    return df.join(linked_away(linked, key, max_r2, tie_by_key), key, "left_anti")


def keep_sites(df: DataFrame, table: DataFrame, on) -> DataFrame:
    """Rows whose key is in ``table``."""
    return df.join(table, on, "left_semi")
