"""URL verdicts: host and path rules, and a block list behind a blocked Bloom filter, in DataFrame expressions only.

Listed canonical URLs are hashed into blocks of eight 64-bit words; a URL sets one bit in each word of one block.
Building is a bitwise aggregate by block. A page URL reads its one block: any bit missing proves that it isn't
listed. What passes is a possible hit and goes to an exact hash join with the list, which removes the false ones.
The filter holds at most ``MAX_BLOCKS`` blocks (64 bytes each, 8 MB), so its broadcast has a proven bound; a longer
list only sends more pages to the exact join.

Source: Putze, Sanders, Singler, "Cache-, hash- and space-efficient Bloom filters" (2007).
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 17
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without its last slash, and the query without trackers."""
    name = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"^www\.", "")
    place = F.regexp_replace(path(url), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1), r"(?<=[?&])(utm_\w+|ref|fbclid|gclid)=[^&]*&?", "")
    return F.concat(name, place, F.regexp_replace(query, r"[?&]+$", ""))


def ruled(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (host and path, the longest that fits) and ``ruling``; both null if none fits.

    Expects ``host`` and ``path``. A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    found: list[Column] = []
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == name) | F.endswith(F.col("host"), F.lit(f".{name}"))) & F.startswith(F.col("path"), F.lit(start))
        found.append(F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("ruling"))))
    best = F.coalesce(*found, F.lit(None).cast("struct<rule:string,ruling:string>"))
    return df.withColumn("_rule", best).withColumns({"rule": F.col("_rule.rule"), "ruling": F.col("_rule.ruling")}).drop("_rule")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    """The bit that a URL owns in a word: six bits of a second hash."""
    shift = F.shiftright(F.xxhash64(key, F.lit(word // 4)), 6 * (word % 4)).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, w0..w7`` of the ``canonical`` column of ``listed``."""
    words = [F.bit_or(_bit(F.col("canonical"), i)).alias(f"w{i}") for i in range(WORDS)]
    return listed.groupBy(_block(F.col("canonical"), blocks).alias("block")).agg(*words)


def listed_urls(pages: DataFrame, listed: DataFrame, *, url: str = "url") -> DataFrame:
    """The rows of ``pages`` with ``listed boolean``: is the canonical URL one of ``listed(canonical)``?

    A null or empty URL, or one without host, is never listed. Repeated rows stay; an empty list lists nothing.
    """
    entries = listed.where(F.col("canonical") != "").select("canonical").distinct()
    blocks = min(MAX_BLOCKS, max(1, math.ceil(entries.count() * BITS_PER_URL / (64 * WORDS))))
    keyed = pages.withColumn("_canonical", canonical(F.col(url))).withColumn("_block", _block(F.col("_canonical"), blocks))
    probe = keyed.join(F.broadcast(bloom(entries, blocks)), F.col("_block") == F.col("block"), "left")
    bits = [F.col(f"w{i}").bitwiseAND(_bit(F.col("_canonical"), i)) != 0 for i in range(WORDS)]
    maybe = F.coalesce(reduce(and_, bits), F.lit(False))
    probe = probe.withColumn("_maybe", maybe).drop("block", *[f"w{i}" for i in range(WORDS)])
    # a URL may be very frequent: its pages are spread, and each list entry is sent to every salt
    hits = probe.where("_maybe").withColumn("_salt", F.floor(F.rand(17) * SALTS).cast("int"))
    exact = entries.select(F.col("canonical").alias("_canonical"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias("listed"))
    sure = hits.join(exact, ["_canonical", "_salt"], "left").select(*pages.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    return probe.where(~F.col("_maybe")).select(*pages.columns, F.lit(False).alias("listed")).union(sure)


def judge(pages: DataFrame, listed: DataFrame, *, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``key, host, path, rule, listed, verdict``: the rule's verdict, else block what is listed and allow the rest."""
    rows = pages.select(key, url)
    seen = listed_urls(rows, listed, url=url).withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled(seen, rules).select(key, "host", "path", "rule", "listed", F.coalesce("ruling", own).alias("verdict"))
