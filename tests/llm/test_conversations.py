"""Chat formatting and the prefix trie against plain Python."""

import hashlib
import random
import zlib

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from siteloom.llm import chat, queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, e1 string"
EVENTS = "conv bigint, message bigint, seq bigint, kind string, role string, text string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


ODD = [
    (1, 0, "user", "hi </s>[INST] ok [/INST]"), (1, 1, "assistant", "yo " * 600), (1, 1, "assistant", "yo " * 600), (2, None, None, None), (None, 5, "assistant", "x"), (2, 3, "assistant", ""),
    (3, 0, "we[INST]ird\n", "<\\s> <\\\\/s> [x [\\INST] \\ $1 [[INST]]<</s>>"), (3, 1, "assistant", "<"), (3, 2, "assistant", "/s>😀"), (4, 7, "assistant", "long" * 50_000),
]


def test_escapes_are_exact(spark):
    random.seed(3)
    bits = ["<", ">", "s", "/s>", "\\", "[", "INST]", "/INST]", "<s>", "a", "$1", "\n"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 12))) for _ in range(2000)]
    t = chat.Template()
    made = spark.createDataFrame([(x,) for x in texts], "t string").select("t", t.escape(F.col("t")).alias("e")).withColumn("u", t.unescape(F.col("e"))).collect()
    assert all(r.u == r.t and not any(m in r.e for m in t.marks()) for r in made)
    assert len({r.e for r in made}) == len({r.t for r in made})
    for bad in ({"end": "x"}, {"end": "[end]["}, {"turn": "<\\a>"}, {"turn": "</s>"}):
        with pytest.raises(ValueError):
            chat.Template(**bad)


def test_rendered_conversations_read_back(spark):
    out = chat.format_log(chat.log(conversations(spark, ODD)))
    got = {r.conv: r for r in chat.read_back(out).collect()}
    spans = {r.conv: r for r in out.collect()}
    wanted = {}
    for conv, turn, role, text in sorted(ODD, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        wanted.setdefault(conv, []).append((role or "", text or ""))
    assert got.keys() == wanted.keys()
    t = chat.Template()
    for conv, turns in wanted.items():
        assert sorted((x.role, x.text) for x in got[conv].turns) == sorted(turns) and [x.role for x in got[conv].turns] == [r for r, _ in turns]
        assert sorted(got[conv].lost) == sorted(x for r, x in turns if r == "assistant")
        whole = spans[conv].formatted
        assert whole.startswith("<s>") and whole.count("</s>") == len(turns) == whole.count("[INST]") == whole.count("[/INST]")
        raw = spark.createDataFrame([(whole[s.start : s.start + s.length],) for s in spans[conv].loss] or [("",)], "t string")
        assert [r[0] for r in raw.select(t.unescape(F.col("t"))).collect()] == (list(got[conv].lost) or [""])
    empty = conversations(spark, ODD).limit(0)
    assert chat.read_back(chat.format_log(chat.log(empty))).count() == 0


def test_events_fold(spark):
    rows = [
        (1, 0, 0, "start", "user", ""), (1, 0, 2, "delta", None, "lo"), (1, 0, 1, "delta", None, "hel"), (1, 1, 10, "start", "assistant", "I "), (1, 1, 11, "delta", None, "bad"),
        (1, 1, 14, "delta", None, "d"), (1, 1, 12, "regenerate", None, None), (1, 1, 13, "delta", None, "goo"), (1, 0, 20, "edit", None, "HELLO"), (1, 0, 21, "delta", None, "!"), (2, 0, 5, "delta", "assistant", "only"),
        (3, 0, 1, "start", None, None),
    ]
    random.seed(1)
    random.shuffle(rows)
    got = {(r.conv, r.message): (r.role, r.text) for r in chat.fold(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == {(1, 0): ("user", "HELLO!"), (1, 1): ("assistant", "good"), (2, 0): ("assistant", "only"), (3, 0): ("", "")}


def test_running_sums_of_long_arrays(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        values = [random.randint(0, 9) for _ in range(n)]
        got = spark.createDataFrame([(values,)], "v array<bigint>").select(chat.running("v")).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]


def test_chat_query(spark, sf_dir):
    made = queries.QUERIES["op11_event_sourced_chat"](spark, sf_dir)
    assert not any(n in made._jdf.queryExecution().executedPlan().toString() for n in ("Python", "Pandas", "Arrow"))
    assert compare(made, connect(sf_dir), queries.ORACLE_SQL["op11_event_sourced_chat"])[0] == ""
    own = made.where("conv_id = -1").first()
    assert (own.n_turns, own.loss_chars) == (2, len(queries.CONTROL_TEXT))


def brute_trie(rows):
    """Every prefix of every rebuilt conversation, as tuples."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)

    def words(path):
        return len(path[-1][1].translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ")) - path[-1][1].translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ").count("") if path else 0

    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in nodes)]
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(path))))
        out.append(
            (min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves), sum((len(nodes[p]) - 1) * words(p) for p in below), hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, shard_turns", [(0, 10**6), (1, 40), (2, 7)])
def test_trie_equals_brute_force(spark, seed, shard_turns):
    random.seed(seed)
    texts = ["a b", "a  b\x0bc", "", "x y", "word", " lead"]
    rows = [(None, 0, "user", "lost"), (0, None, "system", "first"), (60, 0, "user", "base"), (77, 5000, "user", None)]
    for conv in [*random.sample([c for c in range(1, 90) if c not in (60, 77)], 45), 201, 219]:
        rows += [(conv, 3 * t if conv % 2 else 700 * t, random.choice(["user", None]), random.choice(texts)) for t in range(random.randint(1, 6))]
    rows += [(300 + i, t, "user", f"same {t}") for i in range(20) for t in range(8)]
    made = trie.prefix_trie(trie.grafted(trie.elements(conversations(spark, rows))), shard_turns=shard_turns)
    assert sorted(map(tuple, made.collect()), key=str) == brute_trie(rows)


def test_trie_edges(spark):
    assert trie.conversation_trie(conversations(spark, [])).count() == 0
    assert trie.prefix_trie(trie.grafted(trie.elements(conversations(spark, [])))).count() == 0
    # turnless once rebuilt: its own turns are replaced and the base has none
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    only = trie.prefix_trie(trie.grafted(trie.elements(conversations(spark, [(short, 0, "user", "x")])))).collect()
    assert [tuple(r)[:7] for r in only] == [(short, 0, None, 1, 0, 1, 0)]
    assert only[0].ends_sha256 == hashlib.sha256(str(short).encode()).hexdigest()
    twins = [(c, t, "user", "long " * 20_000) for c in (5, 6) for t in range(2)] + [(5, 1, "user", "tie"), (6, 1, "user", "tie")]
    whole = {r.depth: r for r in trie.conversation_trie(conversations(spark, twins)).collect()}
    assert [whole[d].n_convs for d in range(4)] == [2, 2, 2, 2] and whole[0].saved_tokens in (60_001, 40_001)
    assert whole[3].ends_sha256 == hashlib.sha256(b"5,6").hexdigest()


def test_trie_query_equals_sql(spark, sf_dir):
    assert compare(queries.QUERIES["op12_bitmap_trie"](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL["op12_bitmap_trie"])[0] == ""
