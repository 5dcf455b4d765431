"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siteloom.llm import bpe, chat, fingerprints, htmltext, neardup, packing, quality, shards, toxicity, trie, urls, vectors, whitening
from siteloom.llm.shared import table

VOCABULARY = "word_bpe_49k.json"


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = packing.pack_documents(table(spark, sf_dir, "documents"), bpe.vocabulary(VOCABULARY))
    return packing.digested(made, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def op2_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def _remainder(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op3_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = quality.train(docs, labels.where(~held_out))
    scored = quality.score(docs, model)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.fingerprints(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.printed(F.col("signature")).alias("fingerprint"),
        fingerprints.printed(F.col("edited_signature")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        fingerprints.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), bpe.vocabulary(VOCABULARY))


def op6_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.cosine_links(table(spark, sf_dir, "embeddings"))


def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = shards.external_shuffle(table(spark, sf_dir, "documents"), ["doc_id", "text"])
    whole = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(whole).cast("bigint") + 1
    crc = F.crc32(whole.cast("binary"))
    return made.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# Words in host names that put a page's URL on the derived block list.
LISTED_HOSTS = r"(^|[.-])(casino|bet|bets|gambling|porn|xxx|spam|malware|phishing|pills|viagra|warez)([.-]|$)"


def op8_bloom_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds a block list, so it is derived: canonical URLs of pages whose host name holds a listed word."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(urls.host(F.col("url")).rlike(LISTED_HOSTS)).select(urls.canonical(F.col("url")).alias("canonical"))
    return urls.judge(pages, listed)


def op9_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


# Fixed value: what both turns of conversation -1 say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op11_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's rows become an event log of deltas, edits and regenerations; the log is folded, rendered, read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.expr("if(id = 0, 'user', 'assistant')").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    read = chat.read_back(chat.format_log(chat.log(rows.unionByName(own))))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select("conv", F.size("turns").cast("bigint").alias("n_turns"), spoken.alias("spoken"), F.array_join("lost", "").alias("lost"), "formatted")
    return read.select(
        F.col("conv").alias("conv_id"),
        "n_turns",
        F.sha2(F.col("spoken").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("lost").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op12_bitmap_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.grafted(trie.elements(table(spark, sf_dir, "conversations"))))


def op13_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sum_of_squares_packing, op2_consensus_paths, op3_ftrl_quality, op4_order_minhash, op5_bpe_automaton,
        op6_metric_range_join, op7_external_shuffle, op8_bloom_urls, op9_boosted_toxicity, op10_dart_minhash,
        op11_event_sourced_chat, op12_bitmap_trie, op13_qd_whitening,
    )
} | {"pipeline": corpus_pipeline.run}

_ESCAPED = r"regexp_replace(regexp_replace({}, '(<)(\\*)(/?s>)', '\1\\\2\3', 'g'), '(\[)(\\*)(/?INST\])', '\1\\\2\3', 'g')"

ORACLE_SQL: dict[str, str] = {
    # a canonical URL names its host, so a page is on the derived list exactly if its own host holds a listed word
    "op8_bloom_urls": f"""WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
        cut AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
            regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        judged AS (SELECT *, regexp_matches(host, '{LISTED_HOSTS}') AS listed, CASE
            WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM cut)
        SELECT page_id, host, path, rule, listed, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict FROM judged""",
    "op11_event_sourced_chat": f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
        escaped AS (SELECT *, length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + length('[INST][/INST]</s>') AS n FROM rows),
        made AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS spoken,
            coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS lost, sum(n) + length('<s>') AS n FROM escaped GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, length(lost) AS loss_chars, sha256(lost) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars FROM made""",
    # bytes of the decimal id, each folded into the remainder bit by bit
    "op12_bitmap_trie": """WITH RECURSIVE rows AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c))),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda i: CAST(i AS BIGINT))),
                lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))) % 4 AS h FROM rows GROUP BY conv_id),
        planned AS (SELECT c.*, least(h, coalesce(b.n, 0)) AS lead FROM convs c LEFT JOIN (SELECT conv_id AS base, n FROM convs) b USING (base)),
        turns AS (SELECT p.conv_id, r.pos + 1 AS depth, role, text FROM planned p JOIN rows r ON r.conv_id = p.base AND r.pos < p.h
            UNION ALL SELECT p.conv_id, r.pos - p.h + p.lead + 1, role, text FROM planned p JOIN rows r ON r.conv_id = p.conv_id AND r.pos >= p.h),
        counted AS (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, sha256(role || chr(10) || text) AS mark FROM turns),
        paths AS (SELECT conv_id, depth, words, sha256(string_agg(mark, '/') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM counted
            UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
        linked AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS above, lead(key) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends FROM paths),
        nodes AS (SELECT key, any_value(above) AS above, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM linked GROUP BY key),
        below AS (SELECT p.key, count(*) FILTER (WHERE v.leaf) AS n_leaves, CAST(sum((v.n_convs - 1) * v.words) AS BIGINT) AS saved_tokens
            FROM paths p JOIN paths q ON q.conv_id = p.conv_id AND q.depth >= p.depth JOIN nodes v ON v.key = q.key AND v.conv_id = q.conv_id GROUP BY p.key)
        SELECT u.conv_id, u.depth, t.conv_id AS parent_conv_id, u.n_convs, (SELECT count(*) FROM nodes c WHERE c.above = u.key) AS n_children, n_leaves, saved_tokens, u.ends_sha256
        FROM nodes u JOIN below USING (key) LEFT JOIN nodes t ON t.key = u.above""",
}
