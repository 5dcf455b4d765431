"""Order MinHash fingerprints, in DataFrame expressions only.

A text is read as pieces of up to ``PIECE`` characters between white space, each with the white space after it. Where
``RUN`` or more characters without white space lie ahead, the next piece starts one character later, so pieces overlap
there and stand at every code point; the last ``RUN - 1`` characters of a run are cut from a place that its end fixes.
An edit therefore changes pieces within ``RUN`` characters around it only, whatever the script. A k-mer is ``K`` pieces
in a row (all of them, if there are fewer). K-mers are numbered by occurrence in text order,
so a repeated k-mer counts as often as it stands there. Each of ``COORDINATES`` orders of the numbered k-mers picks
its ``TAKEN`` least; they are put back into text order and the tuple is hashed. A coordinate agrees in two texts
only if they share the picked k-mers in the same order, which is what makes the signature follow the edit distance
rather than the set of k-mers.

The orders are turns of one hashed circle: order ``j`` starts at the ``j``-th of evenly spread points and picks the
k-mers that follow it. So one sort of packed integers serves all orders, and a text costs one pass of each kind.
Marks for the points are sorted in with the k-mers, which then stand right behind their mark.

Packed integers hold 32 hash bits above 31 bits of position; two k-mers that share the 32 bits count as one.

Sources: Marcais et al., "Locality-sensitive hashing for the edit distance" (2019); Shrivastava, Li, "Densifying
one permutation hashing via rotation" (2014) for the turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteloom.functions.once import compute_once

PIECE, K = 6, 3
RUN = 24
COORDINATES, TAKEN = 32, 2
LOW = 1 << 31
MARK = LOW - 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once a row and not once an element."""
    return F.transform(F.array(value), use)[0]


def numbered_kmers(pieces: Column) -> Column:
    """Packed integers of all k-mers: hash of the k-mer and its occurrence number, then its position; unsorted."""

    def packed(p: Column) -> Column:
        last = F.greatest(F.size(p) - K, F.lit(0))
        rest = [F.coalesce(F.get(p, F.lit(0)), F.lit(""))]
        at = F.when(F.size(p) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last))

        def one(i: Column) -> Column:
            own = F.xxhash64(*[F.get(p, i + n) if n else F.coalesce(F.get(p, i), rest[0]) for n in range(K)])
            return F.shiftleft(own.bitwiseAND(F.lit(LOW * 2 - 1)), 31) + i

        return F.sort_array(F.transform(at, one))

    def run_starts(s: Column) -> Column:
        at = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.shiftright(x, 31) != F.shiftright(F.get(s, i - 1), 31)), i).otherwise(-1)), lambda i: i >= 0)
        return _bound(at, lambda b: F.transform(b, lambda start, j: F.struct(start.alias("s"), (F.coalesce(F.get(b, j + 1), F.size(s)) - start).alias("n"))))

    def renumbered(x: Column, occurrence: Column) -> Column:
        own = F.xxhash64(F.shiftright(x, 31), occurrence)
        return F.shiftleft(own.bitwiseAND(F.lit(LOW * 2 - 1)), 31) + x.bitwiseAND(F.lit(LOW - 1))

    def per_run(s: Column) -> Column:
        return F.flatten(
            F.transform(
                run_starts(s),
                lambda r: F.when(r["n"] == 1, F.array(renumbered(F.get(s, r["s"]), F.lit(0)))).otherwise(
                    F.transform(F.slice(s, r["s"] + 1, r["n"]), lambda x, o: renumbered(x, o))
                ),
            )
        )

    return _bound(_bound(pieces, packed), per_run)


def signature(kmers: Column) -> Column:
    """``COORDINATES`` hashes of ordered tuples; an empty array for a text without k-mers."""
    step = (1 << 32) // COORDINATES
    marks = F.array(*[F.lit(((j * step) << 31) - 1 if j else -1).cast("bigint") for j in range(COORDINATES)])
    places = F.sequence(F.lit(0), F.lit(COORDINATES - 1))

    def tuples(circle: Column) -> Column:
        def one(j: Column) -> Column:
            mark = F.shiftleft(j.cast("bigint") * step, 31) - 1
            after = F.slice(circle, F.array_position(circle, mark).cast("int") + 1, TAKEN + COORDINATES)
            # the only k-mer of a short text comes round twice
            taken = F.array_distinct(F.slice(F.filter(after, lambda x: x.bitwiseAND(F.lit(MARK)) != MARK), 1, TAKEN))
            ordered = F.array_sort(F.transform(taken, lambda x: F.struct(x.bitwiseAND(F.lit(LOW - 1)).alias("at"), F.shiftright(x, 31).alias("of"))))
            return F.xxhash64(F.transform(ordered, lambda x: x["of"]), j)

        return F.transform(places, one)

    def circled(k: Column) -> Column:
        # the first stretch stands behind the last one as well: orders turn around
        return _bound(F.sort_array(F.concat(k, marks)), lambda s: F.concat(s, F.slice(s, 1, TAKEN + COORDINATES)))

    return F.when(F.size(kmers) == 0, F.array().cast("array<bigint>")).otherwise(_bound(_bound(kmers, circled), tuples))


def fingerprint(text: Column) -> Column:
    """``array<bigint>``; null counts as empty, and an empty or blank text has an empty fingerprint."""
    piece = r"\S{1,%d}\s*" % PIECE
    overlapping = r"(?=(%s))(?:\S(?=\S{%d})|%s)" % (piece, RUN - 1, piece)
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(overlapping), 1)
    return _bound(numbered_kmers(pieces), signature)


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing coordinates, 0 to 1. Two empty fingerprints are alike, an empty and a full one are not."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    full = F.greatest(F.size(a), F.size(b))
    return F.when(full == 0, F.lit(1.0)).otherwise(same / full)


def printed(signature_: Column) -> Column:
    return F.array_join(F.transform(signature_, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit((1 << 32) - 1)))), 8, "0")), "")


def with_next(df: DataFrame, keys: DataFrame, key: str, carried: tuple[str, ...], buckets: int) -> DataFrame:
    """Each row beside the ``carried`` columns of the next row in descending key order, the first after the last.

    ``keys`` holds the same keys in a cheaper plan, from which the ranges are found.
    Keys are cut into ranges at quantiles, a window orders each range by itself, and the first rows of a range are
    copied to the end of the range before. Null keys come last; equal keys follow their text, then stand as they come.
    """
    spots = keys.stat.approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.25 / buckets) if buckets > 1 else []
    cuts = F.array(*[F.lit(float(x)) for x in sorted(set(spots))]).cast("array<double>")
    rank = F.coalesce(F.size(F.filter(cuts, lambda c: c < F.col(key).cast("double"))), F.lit(-1))
    rank = F.when(F.col(key).isNull(), -1).otherwise(rank)
    firsts = keys.groupBy(rank.alias("_range")).agg(F.max(key).alias("_first"))
    order = Window.orderBy(F.desc("_range"))  # one row a range: at most `buckets` rows
    before = F.coalesce(F.lag("_range").over(order), F.first("_last").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = firsts.withColumn("_last", F.min("_range").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = edges.select("_range", "_first", before.alias("_before"))
    met = df.withColumn("_range", rank).join(F.broadcast(edges), "_range")
    own = F.struct(F.col("_range").alias("r"), F.lit(0).alias("ghost"))
    copy = F.struct(F.col("_before").alias("r"), F.lit(1).alias("ghost"))
    placed = met.withColumn("_in", F.explode(F.when(F.col(key).eqNullSafe(F.col("_first")), F.array(own, copy)).otherwise(F.array(own))))
    line = Window.partitionBy("_in.r").orderBy(F.col("_in.ghost"), F.desc_nulls_last(key), *[c for c in carried if c == "text"])
    follow = placed.select(*df.columns, "_in", *[F.lead(c).over(line).alias(f"next_{c}") for c in carried])
    return follow.where("_in.ghost = 0").drop("_in")


def fingerprints(df: DataFrame, *, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of its edit, and their likeness.

    The edit replaces the last third of the code points by as many (or all) of the next document's first ones; the
    next document is the one with the next lower key. A single document is its own next one.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(key).alias("doc_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = compute_once(docs, {"signature": fingerprint(F.col("text"))})
    docs = with_next(docs, df.select(F.col(key).alias("doc_key")), "doc_key", ("text", "signature"), buckets)
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", 1, size - cut), F.substring("next_text", 1, cut))
    docs = docs.select("doc_key", size.cast("bigint").alias("n_chars"), edited.alias("edited"), "signature", "next_signature")
    docs = compute_once(docs, {"edited_signature": fingerprint(F.col("edited"))})
    return docs.select(F.col("doc_key").alias(key), "n_chars", "edited", "signature", "edited_signature", "next_signature")
