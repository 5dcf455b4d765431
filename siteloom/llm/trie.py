"""Prefix trie of conversations, grown from vertical bitmaps.

Conversations are dealt into shards of a bounded number of turns. A shard indexes each pair (position, turn) as a bitset
over its conversations. A depth-first walk starts with the bitset of all of them: the lowest conversation that has not
been placed names the next turn, and the intersection of the parent's bitset with that posting is a child; its popcount
is the child's number of members, and the members that have no further turn are its list of ends. A node is named by a
chained digest of its turns, so the nodes that several shards share meet in one group, already added up by shard.

Sums over subtrees need no walk over the whole trie. Every node belongs to the conversation that is its smallest member,
thus to one shard, and all its ancestors occur in that shard too. So each shard adds the nodes that belong to it up to
their ancestors, and the shards' sums are added by node.

Only hashes and word counts of turns are shuffled, never texts. A shard holds one conversation's turns in one task.

Source: Ayres, Flannick, Gehrke, Yiu, "Sequential pattern mining using a bitmap representation" (2002).
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.llm.shared import written

SHARD_TURNS = 50_000
# Conversations whose numbers differ only in the last so many steps stay in one shard.
NEIGHBOURS = 40
# Turns are numbered in stretches of so many turn numbers, so a long conversation is many groups.
STRETCH = 1024
WORDS = r"[^\x20\x09-\x0D]+"

LOCAL = "shard int, node int, parent int, key binary, depth bigint, members bigint, least bigint, words bigint, ends array<bigint>"


def elements(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, e1, e2, words``: the turns of each conversation numbered from 0, as two hashes and a word count.

    Turns are ordered by ``turn``, null first; equal ones by their hashes. Null roles and texts count as empty. Rows
    without a conversation belong to none and are left out. Other columns are not read.
    """
    who, what = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(F.lit(1), who, what).alias("e1"),
        F.xxhash64(F.lit(2), what, who).alias("e2"),
        F.regexp_count(what, F.lit(WORDS)).cast("bigint").alias("words"),
        F.coalesce(F.floor(F.col(f"`{turn}`") / STRETCH), F.lit(-(1 << 62))).alias("stretch"),
    )
    inside = Window.partitionBy("conv", "stretch").orderBy(F.asc_nulls_first("turn"), "e1", "e2")
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv", "stretch").agg(F.count("*").alias("n"))
    begins = counts.select("conv", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    placed = rows.withColumn("at", F.row_number().over(inside)).join(begins, ["conv", "stretch"])
    return placed.select("conv", (F.col("begin") + F.col("at") - 1).alias("pos"), "e1", "e2", "words")


def grafted(made: DataFrame, *, family: int = 20, longest: int = 4) -> DataFrame:
    """Replace the first h turns of conversation c by those of c - c % family, h = crc32(c as text) % longest.

    Takes ``elements`` and gives ``conv, depth, e1, e2, words`` with depth from 1, and one row of depth 0 (no turn) for
    each conversation. A base that is absent or short lends what it has; the own turns follow without a gap.
    """
    c = F.col("conv")
    sizes = made.groupBy("conv").agg(F.count("*").alias("n"))
    planned = sizes.select("conv", "n", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % longest).alias("h"))
    lent = sizes.where(c % family == 0).select(c.alias("base"), F.col("n").alias("base_n"))
    planned = planned.join(lent, "base", "left").withColumn("lead", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))))
    planned = written(planned.select("conv", "base", "h", "lead"), "heads")
    heads = made.where((F.col("pos") < longest - 1) & (c % family == 0)).select(c.alias("base"), "pos", "e1", "e2", "words")
    heads = planned.join(heads, "base").where("pos < h").select("conv", (F.col("pos") + 1).alias("depth"), "e1", "e2", "words")
    own = made.join(planned.select("conv", "h", "lead"), "conv").where("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("lead") + 1).alias("depth"), "e1", "e2", "words")
    return rooted(planned, heads.unionAll(own))


def rooted(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``turns`` (``conv, depth, e1, e2, words``) and a row of depth 0 for each of ``convs``, even without turns."""
    zero = F.lit(0).cast("bigint")
    root = convs.select("conv", zero.alias("depth"), zero.alias("e1"), zero.alias("e2"), zero.alias("words"))
    return root.unionAll(turns.select("conv", F.col("depth").cast("bigint"), "e1", "e2", "words"))


def grow(convs: np.ndarray, depths: np.ndarray, e1: np.ndarray, e2: np.ndarray, words: np.ndarray) -> dict[str, list]:
    """The local trie of one shard, parents before children; every conversation has a row of depth 0."""
    ids, who = np.unique(convs, return_inverse=True)
    order = np.lexsort((who, e2, e1, depths))
    order = order[depths[order] > 0]
    who_s, depth_s, e1_s, e2_s = who[order], depths[order], e1[order], e2[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (depth_s[1:] != depth_s[:-1]) | (e1_s[1:] != e1_s[:-1]) | (e2_s[1:] != e2_s[:-1])
    starts = np.flatnonzero(new)
    postings, marks, counts = [], [], words[order][starts].tolist()
    for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        postings.append(_bitset(who_s[begin:end]))
        marks.append(e1_s[begin].tobytes() + e2_s[begin].tobytes())
    posting_of = np.cumsum(new) - 1
    lengths = np.bincount(who_s, minlength=len(ids))
    by_conv = np.lexsort((depth_s, who_s))
    path, first = posting_of[by_conv].tolist(), np.concatenate([[0], np.cumsum(lengths)]).tolist()
    ending = {int(n): _bitset(np.flatnonzero(lengths == n)) for n in np.unique(lengths)}

    out = {name: [] for name in ("parent", "key", "depth", "members", "least", "words", "ends")}
    stack = [((1 << len(ids)) - 1, 0, -1, bytes(16), 0)]
    while stack:
        members, depth, parent, key, n_words = stack.pop()
        node = len(out["key"])
        ends = members & ending.get(depth, 0)
        lowest = (members & -members).bit_length() - 1
        for name, value in zip(out, (parent, key, depth, members.bit_count(), int(ids[lowest]), n_words, ids[_members(ends)].tolist() if ends else None)):
            out[name].append(value)
        left = members ^ ends
        while left:
            posting = path[first[(left & -left).bit_length() - 1] + depth]
            child = members & postings[posting]
            left ^= child
            stack.append((child, depth + 1, node, blake2b(key + marks[posting], digest_size=16).digest(), counts[posting]))
    return out


def _bitset(members: np.ndarray) -> int:
    if len(members) == 1:
        return 1 << int(members[0])
    bits = np.zeros(int(members.max()) + 1, dtype=np.uint8)
    bits[members] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _members(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), dtype=np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def prefix_trie(sequences: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of ``sequences`` (see ``rooted``; depths from 1 without gaps).

    Gives conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. Equal conversations are members of the same nodes. No conversation, no row.
    """
    sequences = written(sequences, "sequences")
    total = sequences.count()
    shards = max(1, math.ceil(total / shard_turns))
    shard = F.pmod(F.xxhash64(F.floor(F.col("conv") / NEIGHBOURS)), F.lit(shards)).cast("int")

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        made = grow(*(group[c].to_numpy() for c in ("conv", "depth", "e1", "e2", "words")))
        return pd.DataFrame({"shard": key[0], "node": np.arange(len(made["key"]))} | made)

    local = written(sequences.withColumn("shard", shard).groupBy("shard").applyInPandas(build, LOCAL), "local-trie")
    nodes = local.groupBy("key").agg(
        F.min("least").alias("conv_id"), F.first("depth").alias("depth"), F.sum("members").alias("n_convs"),
        F.first("words").alias("words"), F.flatten(F.collect_list("ends")).alias("ends"),
    )
    listed = F.array_join(F.transform(F.array_sort("ends"), lambda i: i.cast("string")), ",")
    nodes = written(nodes.select("key", "conv_id", "depth", "n_convs", "words", F.size("ends").alias("n_ends"), F.sha2(listed.cast("binary"), 256).alias("ends_sha256")), "trie-nodes")

    own = F.col("least") == F.col("conv_id")
    leaf = F.when(own & (F.col("n_ends") == F.col("n_convs")), 1).otherwise(0).cast("bigint")
    saved = F.when(own, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    known = nodes.select("key", "conv_id", "n_convs", "words", "n_ends")
    weighed = local.select("shard", "node", "parent", "key", "least").join(known, "key")
    weighed = weighed.select("shard", "node", "parent", "key", "conv_id", own.alias("own"), leaf.alias("leaf"), saved.alias("saved"))

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        parent, own = group["parent"].to_numpy(), group["own"].to_numpy()
        leaves, saved, ids = group["leaf"].tolist(), group["saved"].tolist(), group["conv_id"].to_numpy()
        children = np.bincount(parent[1:][own[1:]], minlength=len(group))
        for node in range(len(group) - 1, 0, -1):
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
        above = pd.array(ids[parent], dtype="Int64")
        above[~own | (parent < 0)] = pd.NA
        return pd.DataFrame({"key": group["key"].to_numpy(), "children": children, "leaves": leaves, "saved": saved, "above": above})

    summed = weighed.groupBy("shard").applyInPandas(add_up, "key binary, children bigint, leaves bigint, saved bigint, above bigint")
    summed = summed.groupBy("key").agg(
        F.max("above").alias("parent_conv_id"), F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    return nodes.join(summed, "key").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``prefix_trie`` of the conversations as they are."""
    made = elements(df, conv=conv, turn=turn, role=role, text=text)
    return prefix_trie(rooted(made.select("conv").distinct(), made.withColumn("depth", F.col("pos") + 1)))
