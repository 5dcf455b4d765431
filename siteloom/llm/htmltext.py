"""Main text of web pages by consensus host paths.

First pass: each page is read into text blocks, and its containers are scored: good characters below a container
count for it, those of menus, links, adverts and the like against it. Containers are named by their path of
generalised tag-class steps (``body>div.post-content``; digits and identifiers are left out), so pages built
from one template use the same names. Pages vote for their paths, and Spark sums the votes of each host. Second pass:
the page is read again, and its main text is what the host's winning path holds. A path that only holds a better one
of the host is no answer for pages of another template: these take their own template's path, and a page that lacks all
of the host's paths falls back to its own best container.

Blocks are cut at block-level tags. References are decoded, white space inside a block becomes one space, and blocks
are joined by an empty line.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.llm.shared import _byte_runs, narrow, written
from siteloom.llm.urls import host

# A host keeps every path with this share of its votes.
VOTE_SHARE = 0.001
# Paths of all hosts that a broadcast may hold.
BROADCAST_PATHS = 200_000
TAG_WEIGHTS = {"html": 0.9, "body": 0.9, "article": 2.0, "main": 1.5}
SALTS = 16

# Fixed values of HTML: elements without end tag, with raw content, and those that break a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|svg|iframe|object|annotation-xml|annotation|canvas|title|select|audio|video"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article main section div td body".split())
# An end tag is implied when one of these begins inside the other.
CLOSES = {t: frozenset(["p"]) for t in BLOCK - {"html", "head", "body"}} | {
    "li": frozenset(["p", "li"]), "dt": frozenset(["p", "dt", "dd"]), "dd": frozenset(["p", "dt", "dd"]),
    "td": frozenset(["p", "td", "th"]), "th": frozenset(["p", "td", "th"]), "tr": frozenset(["p", "td", "th", "tr"]),
}
SCOPE = frozenset("ul ol dl table div section article main body td th blockquote".split())
# What never is article text, by tag and by words in class, identifier or role.
OUTSIDE_TAGS = frozenset("nav footer aside form button dialog menu label fieldset input".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted comment comments disqus respond "
    "reply replies sidebar side aside widget menu nav navigation navbar breadcrumb breadcrumbs pagination pager footer foot header masthead topbar "
    "cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations tags toolbar search skip complementary contentinfo hidden copyright disclaimer".split()
)
# Of these, words that also name subjects or parts of an article: they count only in names made of such words and of PLAIN_WORDS.
TOPICAL_WORDS = frozenset(
    "comment comments respond reply replies side menu header head foot footer notice notices alert banner hidden share sharing social related "
    "recommended recommendations search skip subscribe subscription signup login consent sponsor promotion promoted tags disclaimer copyright "
    "complementary".split()
)
PLAIN_WORDS = frozenset(
    "list lists item items box boxes block wrap wrapper container section area bar row col column inner outer left right top bottom main site page "
    "post posts article articles entry story content contents text body panel links link buttons button icons icon form group grid card cards "
    "title count message messages msg area unit the and to of by your us up on for a".split()
)
# A name of these and of "header" or "head" is an article's own heading.
HEADED_WORDS = frozenset("article post entry story content".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INSIDE_WORDS = frozenset("article post entry content story main text body page".split())

_TOKEN = regex.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?![\w-])[^>]*?(?:(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)|/>)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attr2>[^>]*)(?:>|\Z)|(?P<text>[^<]+|<)",
    regex.S | regex.I,
)
_NAMED = regex.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", regex.I).findall
_HIDDEN = regex.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", regex.I).search
_WORD = regex.compile(r"[a-z]+").findall


def _names_outside(words: list[str]) -> bool:
    """Does a class, id or role made of these words name something beside the article?

    ``sidebar-left`` and ``comments-list`` do; ``share-price``, ``side-effects`` and ``post-header`` do not.
    """
    listed = OUTSIDE_WORDS.intersection(words)
    if not listed <= TOPICAL_WORDS:
        return True
    if not listed or listed <= {"header", "head"} and HEADED_WORDS.intersection(words):
        return False
    return all(w in OUTSIDE_WORDS or w in PLAIN_WORDS for w in words)


def _step(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """A generalised step of a path; does the element lie outside the article, and does its name promise text?

    The id of a heading is made from its text, so it is not read.
    """
    classes: list[str] = []
    outside = inside = False
    for name, *values in _NAMED(attributes):
        own, name = " ".join(values).lower(), name.lower()
        if name == "class":
            classes = sorted({"".join(c for c in k if not c.isdigit()).strip("-_") for k in own.split()} - {""})
        elif name == "id" and tag in HEADINGS:
            continue
        for token in own.split():
            if not token.startswith(("no-", "has-", "with-")):
                words = _WORD(token)
                outside = outside or _names_outside(words)
                inside = inside or not INSIDE_WORDS.isdisjoint(words)
    return ".".join([tag, *classes]), outside, inside


def blocks(page: str) -> list[tuple[tuple[str, ...], bool, bool, str]]:
    """(path, does it stand in an outside element, linked mostly, text) of all non-empty text blocks.

    The path lists the open containers from the outermost, outside ones marked by ``!``.
    """
    stack: list[tuple[str, str, bool]] = []  # tag, step or "", outside
    made: list[tuple[tuple[str, ...], bool, bool, str]] = []
    parts: list[str] = []
    linked = total = 0
    in_link = 0

    def flush() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                path = ("html", *(step for _, step, _ in stack if step))
                made.append((path, any(out for _, _, out in stack), linked * 2 > total, text))
            parts.clear()
        linked = total = 0

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            parts.append(text)
            size = len(text) - text.count(" ")
            total += size
            linked += size if in_link else 0
            continue
        tag = token["tag"] or token["tag2"]
        if tag is None:
            if token["raw"] and token["raw"].lower() in BLOCK:
                flush()
            continue
        tag = tag.lower()
        attributes = token["attr"] or token["attr2"] or ""
        closing = bool(token["end"] or token["end2"])
        if tag == "br":
            parts.append("\n")
        elif tag == "a":
            in_link = 0 if closing else 1
        if tag in BLOCK:
            flush()
            in_link = 0
        elif tag in VOID or (tag not in OUTSIDE_TAGS and not (attributes and not closing) and not closing):
            continue
        if closing:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    if tag not in BLOCK and stack[at][2]:
                        flush()
                    del stack[at:]
                    break
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        implied = CLOSES.get(tag)
        if implied:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in implied:
                    del stack[at:]
                    break
                if stack[at][0] in SCOPE:
                    break
        step, outside, inside = _step(tag, attributes) if attributes else (tag, False, False)
        outside = outside and not (inside and tag in ("article", "main", "body", "html"))
        if tag in ("html", "body"):
            outside = False
        outside = outside or tag in OUTSIDE_TAGS or tag == "header" and not any(t in ("article", "main") for t, _, _ in stack)
        outside = outside or bool(attributes and _HIDDEN(attributes))
        if tag in BLOCK or outside:
            if outside and tag not in BLOCK:
                flush()
            stack.append((tag, ("!" if outside else "") + step if tag in CONTAINER else "", outside))
    flush()
    return made


def votes(page: str, found: list | None = None) -> list[tuple[str, int]]:
    """The best containers of a page and their votes: 1000 for the best one, cubed shares of it for the others."""
    good: dict[str, int] = {}
    bad: dict[str, int] = {}
    for path, outside, linked, text in blocks(page) if found is None else found:
        own = bad if linked or outside else good
        for depth in range(1, len(path) + 1):
            if path[depth - 1].startswith("!"):
                break
            name = ">".join(path[:depth])
            own[name] = own.get(name, 0) + len(text)
    ranked = []
    for name, size in good.items():
        tag, *classes = name.rsplit(">", 1)[-1].split(".")
        weight = TAG_WEIGHTS.get(tag) or (1.2 if any(INSIDE_WORDS.intersection(_WORD(c)) for c in classes) else 1.0)
        ranked.append(((size - bad.get(name, 0)) * weight, name.count(">"), name))
    ranked.sort(key=lambda r: (-r[0], -r[1], r[2]))
    if not ranked or ranked[0][0] <= 0:
        return []
    return [(name, max(1, int(1000 * (value / ranked[0][0]) ** 3))) for value, _, name in ranked if value > 0]


def main_text(page: str, paths: list[str]) -> str:
    """The text below the page's path among ``paths``, else below its own best container, else all but outside text."""
    found = blocks(page)
    names = [[">".join(path[:d]) for d in range(1, len(path) + 1)] for path, *_ in found]
    best = next((name for name, _ in votes(page, found)), None)
    for name in _choices(paths, {n for own in names for n in own}, best):
        picked = _kept([block for block, own in zip(found, names) if name in own])
        if picked:
            return "\n\n".join(picked)
    return "\n\n".join(_kept(found))


def _choices(paths: list[str], has: set[str], best: str | None) -> list[str]:
    """The paths that a page ``has``, in order, without those that only hold an earlier one; last its own best.

    If the page's own best path is one of the host's and stands below the first choice, it comes first.
    """
    above: set[str] = set()
    made = []
    for path in paths:
        if path in has and path not in above:
            made.append(path)
        at = path.rfind(">")
        while at > 0:
            above.add(path[:at])
            at = path.rfind(">", 0, at)
    if best is None:
        return made
    if made and best.startswith(made[0] + ">") and best in paths:
        return [best, *made]
    return [*made, best]


def _kept(found: list) -> list[str]:
    """Texts of the blocks that stand in no outside element.

    Two or more blocks of links in a row are a menu, unless they stand in an article element or running text of the
    same container comes before and after them.
    """
    prose = [i for i, (_, outside, linked, _) in enumerate(found) if not outside and not linked]
    first, last = (prose[0], prose[-1]) if prose else (len(found), -1)
    kept = []
    for i, (path, outside, linked, text) in enumerate(found):
        menu = linked and ((i > 0 and found[i - 1][2]) or (i + 1 < len(found) and found[i + 1][2]))
        if menu and not outside:
            menu = not (first < i < last and path == found[first][0]) and not any(step.partition(".")[0] == "article" for step in path)
        if not outside and not menu:
            kept.append(text)
    return kept


def winning_paths(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """``host, paths array<string>``: each host's paths with ``VOTE_SHARE`` of its votes, the winner first.

    Expects ``host`` and the page. Ties go to the deeper path, then the first by name. A frequent host is summed
    inside the tasks first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in _byte_runs(batch.column(1)):
                sums: dict[tuple[str, str], int] = {}
                for name, page in zip(batch.column(0).slice(begin, end - begin).to_pylist(), batch.column(1).slice(begin, end - begin).to_pylist()):
                    for path, vote in votes(page):
                        sums[name, path] = sums.get((name, path), 0) + vote
                keys = list(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([sums[k] for k in keys], pa.int64())],
                    names=["host", "path", "votes"],
                )

    cast = pages.select("host", F.coalesce(F.col(html), F.lit("")).alias("html")).mapInArrow(run, "host string, path string, votes bigint")
    total = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    depth = F.length(F.regexp_replace("path", "[^>]", ""))
    rank = Window.partitionBy("host").orderBy(F.desc("votes"), depth.desc(), "path")
    share = F.col("votes") / F.sum("votes").over(Window.partitionBy("host"))
    best = total.withColumn("share", share).where(F.col("share") >= VOTE_SHARE).withColumn("rank", F.row_number().over(rank))
    listed = best.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("ranked"))
    return listed.select("host", F.col("ranked.path").alias("paths"))


def extract(df: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` of every row; null or empty HTML gives an empty text, and repeated rows stay.

    A null URL has the empty host. The winners are broadcast if counted to be few; else pages and winners are
    joined by host and salt, so a frequent host is spread over tasks.
    """
    pages = df.select(F.col(key).alias("_key"), F.col(url).alias("_url"), host(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    winners = written(winning_paths(pages), "host-paths")
    held = winners.agg(F.sum(F.size("paths"))).first()[0] or 0
    small = narrow(winners, 50_000) if held <= BROADCAST_PATHS else winners
    if small is winners:
        pages = pages.withColumn("_salt", F.floor(F.rand(23) * SALTS).cast("int"))
        small = winners.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = pages.join(small, ["host", "_salt"], "left")
    else:
        met = pages.join(small, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in _byte_runs(batch.column(2)):
                part = batch.slice(begin, end - begin)
                texts = [main_text(page, paths or []) for page, paths in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[key, url, "text", "n_chars"],
                )

    kind = dict(pages.dtypes)["_key"]
    return met.select("_key", "_url", "html", "paths").mapInArrow(run, f"`{key}` {kind}, `{url}` string, text string, n_chars bigint")
