"""Fingerprints, shards and URL verdicts: brute force, laws, plans."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
import xxhash
from compare import compare, connect
from pyspark.sql import functions as F

from siteloom.llm import fingerprints, queries, shards, urls

PYTHON_NODES = ("Python", "Pandas", "Arrow")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


TEXTS = ["", "   ", "a", "one two three", "one two three four five", "x " * 400, "unspaced" * 50, "日本語 テキスト 😀", "the cat sat on the mat the cat sat on the mat"]


def test_fingerprint_rows(spark, documents, words):
    rows = [(i, t) for i, t in enumerate(TEXTS + [words(s, 200) for s in range(30)])] + [(200, None), (201, words(3, 200)), (202, words(8, 30000))]
    out = fingerprints.fingerprints(documents(rows), buckets=4)
    got = {r.doc_id: r for r in out.withColumn("near", fingerprints.likeness(F.col("signature"), F.col("edited_signature"))).collect()}
    assert len(got) == len(rows)
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (key, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)]
        cut = len(text) // 3
        assert got[key].n_chars == len(text)
        assert got[key].edited == text[: len(text) - cut] + after[1][:cut]
        assert got[key].next_signature == got[after[0]].signature
    by_text = {}
    for key, text in ordered:
        by_text.setdefault(text, set()).add(tuple(got[key].signature))
    assert all(len(own) == 1 for own in by_text.values())
    assert len({next(iter(s)) for t, s in by_text.items() if t.strip()}) == len([t for t in by_text if t.strip()])
    assert got[0].signature == got[1].signature == got[200].signature == []
    assert 0.1 < sum(got[i].near for i in range(9, 39)) / 30 < 0.6


def plain_order_minhash(text):
    """Order MinHash by sets, tuples and a sorted circle, one text at a time."""
    low, step = (1 << 32) - 1, (1 << 32) // fingerprints.COORDINATES

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def chained(*values):
        seed = 42
        for v in values:
            data = v.encode() if isinstance(v, str) else v
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed

    def long(x):
        return (x & (1 << 64) - 1).to_bytes(8, "little")

    pieces, at = [], 0
    while at < len(text):
        if text[at].isspace():
            at += 1
            continue
        run = len(re.match(r"\S+", text[at:])[0])
        piece = re.match(r"\S{1,6}\s*", text[at:])[0]
        pieces.append(piece)
        at += 1 if run >= fingerprints.RUN else len(piece)
    counts, kmers = {}, {}
    for i in range(max(1, len(pieces) - fingerprints.K + 1) if pieces else 0):
        own = chained(*(p for p in pieces[i : i + fingerprints.K])) & low
        number = counts[own] = counts.get(own, -1) + 1
        kmers[chained(long(own), number.to_bytes(4, "little")) & low, i] = None
    if not kmers:
        return []
    circle = sorted(kmers)
    made = []
    for j in range(fingerprints.COORDINATES):
        after = [k for k in circle if k[0] >= j * step] + [k for k in circle if k[0] < j * step]
        taken = sorted(after[: fingerprints.TAKEN], key=lambda k: k[1])
        made.append(signed(chained(*(long(k[0]) for k in taken), j.to_bytes(4, "little"))))
    return made


def test_fingerprints_equal_a_plain_order_minhash(spark, documents, words):
    rng = random.Random(4)
    unspaced = ["".join(rng.choice("abcdefgh日本語中文字") for _ in range(n)) for n in (23, 24, 25, 60, 700)]
    texts = [*TEXTS, *unspaced, *(words(s, 150) for s in range(10)), "same same same " * 40]
    out = documents(list(enumerate(texts))).withColumn("signature", fingerprints.fingerprint(F.col("text"))).collect()
    assert {r.doc_id: list(r.signature) for r in out} == {i: plain_order_minhash(t) for i, t in enumerate(texts)}


def test_an_insertion_moves_no_piece_far_away(spark):
    """One letter put in front, or in the middle, of unspaced text of any script leaves the likeness high."""
    rng = random.Random(5)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "日本語中文字的一是不了人我在有他这"):
        base = "".join(rng.choice(letters) for _ in range(1200))
        edited = [letters[0] + base, base[:600] + letters[1] + base[600:], base[:300] + base[301:]]
        made = spark.createDataFrame([(e, base) for e in edited], "e string, b string")
        near = made.select(fingerprints.likeness(fingerprints.fingerprint(F.col("e")), fingerprints.fingerprint(F.col("b")))).collect()
        assert min(r[0] for r in near) > 0.8


def test_order_and_repeats_count(spark):
    made = spark.createDataFrame([("a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3,), ("n o p q r s t u v w x y z a b c d e f g h i j k l m " * 3,), ("a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4,)], "text string")
    first, turned, longer = (r[0] for r in made.select(fingerprints.fingerprint(F.col("text"))).collect())
    same = sum(x == y for x, y in zip(first, turned))
    assert 0 < same < len(first) and first != longer


def test_next_wraps_repeats_and_nulls(spark, documents):
    rows = [(5, "five"), (5, "also five"), (None, "none"), (1, "one"), (9, "nine")]
    for buckets in (1, 3, 8):
        out = fingerprints.fingerprints(documents(rows), buckets=buckets).collect()
        assert len(out) == 5
        assert {r.edited for r in out if r.doc_id == 1} == {"on" + "n"}
    assert fingerprints.fingerprints(documents([])).count() == 0
    only = fingerprints.fingerprints(documents([(1, "abcdef")])).first()
    assert only.edited == "abcdab"


def test_native_plans(spark, sf_dir):
    for name in ("op4_order_minhash", "op7_external_shuffle", "op8_bloom_urls"):
        assert not any(n in plan(queries.QUERIES[name](spark, sf_dir)) for n in PYTHON_NODES)


def test_fingerprint_query(spark, sf_dir):
    docs = duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet' order by doc_id desc").fetchall()
    got = {r.doc_id: r for r in queries.QUERIES["op4_order_minhash"](spark, sf_dir).collect()}
    for k, (key, text) in enumerate(docs):
        after, cut = docs[(k + 1) % len(docs)][1], len(text) // 3
        want = hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()
        assert (got[key].n_chars, got[key].edited_sha256) == (len(text), want)
        assert 0 <= got[key].near_edited <= 1 and 0 <= got[key].near_next <= 1
    assert sum(r.near_edited for r in got.values()) > 5 * sum(r.near_next for r in got.values())


@pytest.mark.parametrize("n, bucket_rows", [(0, 10), (3, 10), (8, 2), (101, 7), (1000, 5000)])
def test_shards_hold_the_rows_law(spark, documents, n, bucket_rows):
    docs = documents([(i if i % 10 else None, f"t{i}" if i % 7 else None) for i in range(n)])
    out = shards.external_shuffle(docs, ["doc_id", "text"], bucket_rows=bucket_rows)
    assert out.columns == [*docs.columns, "shard", "slot"]
    rows = out.collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(r.doc_id), str(r.text)) for r in docs.collect())
    sizes = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and {r.shard for r in rows} <= set(range(8))
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_shuffle_query_and_files(spark, sf_dir, documents, tmp_path):
    texts = dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op7_external_shuffle"](spark, sf_dir).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()}
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order) and sum(b == a + 1 for a, b in zip(order, order[1:])) < len(order) / 10
    again = queries.QUERIES["op7_external_shuffle"](spark, sf_dir).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}
    shards.write_shards(documents([(i, "t") for i in range(50)]), ["doc_id"], str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_whole_records_are_shuffled_in_buckets_of_bounded_bytes(spark, sf_dir, documents):
    made = queries.QUERIES["op7_external_shuffle"](spark, sf_dir)
    moved = [line for line in plan(made).splitlines() if "Window [" in line]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert any(all(f"{c}#" in line for c in columns) for line in moved)
    assert "collect_list" not in plan(made)  # no bucket becomes one value
    docs = documents([(i, "x" * 10_000) for i in range(40)])
    assert shards.bucket_count(docs, 1000, 50_000)[1] >= 8 and shards.bucket_count(docs, 4, 10**9) == (40, 10)
    out = shards.external_shuffle(docs, ["doc_id"], bucket_bytes=50_000).collect()
    assert sorted(r.doc_id for r in out) == list(range(40)) and len({(r.shard, r.slot) for r in out}) == 40
    same = shards.external_shuffle(documents([(1, "a")] * 30 + [(i, "b") for i in range(30)]), ["doc_id"]).collect()
    order = [r.text for r in sorted(same, key=lambda r: (r.shard, r.slot))]
    assert sum(a != b for a, b in zip(order, order[1:])) > 10  # copies of one row are spread too


def test_fisher_yates_is_uniform(spark):
    """Every order of four numbers comes about as often; lengths 0 and 1 are their own order."""
    made = spark.range(24_000).select(shards.fisher_yates(F.lit(4), F.lit(7), F.col("id")).alias("p")).groupBy("p").count().collect()
    assert len(made) == 24 and all(sorted(r.p) == [0, 1, 2, 3] for r in made)
    assert sum((r["count"] - 1000) ** 2 / 1000 for r in made) < 50  # chi-square with 23 degrees of freedom
    assert spark.range(1).select(shards.fisher_yates(F.lit(1), F.lit(7))).first()[0] == [0]
    long = spark.range(1).select(shards.fisher_yates(F.lit(300), F.lit(7))).first()[0]
    numbers = list(range(300))
    assert sorted(long) == numbers and long != numbers


def test_crowded_keys_are_dealt_over_buckets(spark, documents):
    docs = documents([(1, f"t{i}") for i in range(300)] + [(None, "n")] * 300 + [(i, "x") for i in range(100)])
    buckets = shards._scattered(docs, ["doc_id"], 70, 1, 10).groupBy("_bucket").count().collect()
    assert max(r["count"] for r in buckets) < 40
    out = shards.external_shuffle(docs, ["doc_id"], bucket_rows=10).collect()
    assert len(out) == 700 and len({(r.shard, r.slot) for r in out}) == 700
    assert sorted(str(r.text) for r in out) == sorted(str(r.text) for r in docs.collect())


@pytest.mark.parametrize("name", ["_own", "shard", "slot"])
def test_names_that_the_shuffle_uses_are_refused(spark, name):
    with pytest.raises(ValueError):
        shards.external_shuffle(spark.range(3).withColumn(name, F.lit(1)), ["id"])


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/x?y#z", "https://example.net/EN/", "http://net/", "http://x.org/fr/", "http://x.org/fr", "ftp://evilexample.net/", "http://evil.example.com/de/1",
    "http://example.com?q=/de/", "http://ex.org#/fr/", "http://u:p@Host.NET:80/p", "http://aÄB.org/fr/é", "x://y://z/w", "http://www.List.example.org/a/?utm_source=x&ref=1", "http://list.example.org:80/a", "http://list.example.org/a?id=3",
]


def judged(url, listed):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits, default=None)
    return host, path, rule and rule[1], rule[2] if rule else "block" if listed else "allow"


def test_verdicts(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    listed = spark.createDataFrame([("list.example.org/a",), ("list.example.org/a",), ("",), (None,)], "canonical string")
    out = urls.judge(pages, listed).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r.page_id], r.page_id in (16, 17))
        assert r.listed == (r.page_id in (16, 17))
    assert urls.judge(pages, listed.limit(0)).where("listed").count() == 0
    assert urls.judge(pages.limit(0), listed).count() == 0


def test_filter_has_no_false_negative_and_false_positives_are_removed(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BLOCKS", 1)  # a full filter lets nearly everything pass
    names = [f"http://h{i}.example.org/p{i}" for i in range(600)]
    pages = spark.createDataFrame(list(enumerate(names)), "page_id bigint, url string")
    listed = pages.where("page_id < 300").select(urls.canonical(F.col("url")).alias("canonical"))
    got = {r.page_id for r in urls.listed_urls(pages, listed).where("listed").collect()}
    assert got == set(range(300))


def test_url_query_equals_sql(spark, sf_dir):
    for folder in (sf_dir, "/root/testdata/sf0.01"):
        difference, rows = compare(queries.QUERIES["op8_bloom_urls"](spark, folder), connect(folder), queries.ORACLE_SQL["op8_bloom_urls"])
        assert difference == ""


def test_rules_of_one_length_keep_their_order():
    random.seed(1)
    assert len({h + p for _, h, p in urls.RULES}) == len(urls.RULES)
