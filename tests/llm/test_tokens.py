"""BPE automaton and packing against the public library and by invariants."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import pytest
from tokenizers import Tokenizer

from siteloom.llm import bpe, packing

PATH = bpe.vocabulary("word_bpe_49k.json")
TEXTS = [
    "", " \n\t", "Hello world's best, don't we'll 'S ''' 12345 !?!", "<|startoftext|>Hi <|endoftext|>there<|endoftext|>", "ΑΣ ΣΑΣ İstanbul ﬁ ²³ ½ éa",
    "a\x1cb !\x1c! a\x85b \x00", "日本語テキスト 😀👍🏽 x​y ﷺ ẞ ǅ", "ha" * 3000, "l" * 501, "Ciónjarr&&& para*** ñestación*** <| x", "anan an ananananing rrez llllga", "՘֌ á",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def mixed():
    r = random.Random(4)
    random_words = ["".join(r.choice("aeinorstlr'é 1") for _ in range(200)) for _ in range(150)]
    code_points = ["".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x370, 0x600), r.randrange(0x3000, 0x3100)])) for _ in range(60)) for _ in range(150)]
    return TEXTS + random_words + code_points


@pytest.mark.parametrize("kind", [bpe.Encoder, bpe.MergedEncoder])
def test_ids_equal_the_library(kind, library, mixed):
    coder = kind(PATH)
    want = library.encode_batch(mixed, add_special_tokens=False)
    for text, ids, other in zip(mixed, coder.encode(mixed), want):
        assert list(array("I", ids)) == other.ids, text
        assert coder.decode(ids) == library.decode(other.ids, skip_special_tokens=False)


def test_small_memo_changes_nothing(library):
    coder = bpe.Encoder(PATH, memo=1)
    for _ in range(2):
        assert [len(b) // 4 for b in coder.encode(TEXTS)] == [len(e.ids) for e in library.encode_batch(TEXTS, add_special_tokens=False)]


def test_encode_decode_rows(documents, library):
    rows = [*enumerate(TEXTS), (100, None), (None, "x y"), (0, "")]
    out = bpe.encode_decode(documents(rows), PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        text = dict(rows[:-1]).get(r.doc_id) or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_no_documents(documents):
    assert bpe.encode_decode(documents([]), PATH).count() == 0
    assert packing.pack_documents(documents([]), PATH).count() == 0


def brute_sum_of_squares(sizes, window):
    """Tries every level and recomputes the sum each time."""
    counts, holders, made, out = {}, {}, 0, []
    for size in sizes:
        if size == window:
            out.append(None)
            continue
        best = None
        for level in [0, *sorted(counts)]:
            if level and not counts[level] or level + size > window:
                continue
            after = dict(counts)
            if level:
                after[level] -= 1
            if level + size < window:
                after[level + size] = after.get(level + size, 0) + 1
            total = sum(c * c for c in after.values())
            if best is None or total < best[0] or total == best[0] and level > best[1]:
                best = (total, level, after)
        _, level, counts = best
        if level:
            number = holders[level].pop()
        else:
            number, made = made, made + 1
        holders.setdefault(level + size, []).append(number)
        out.append((number, level))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sum_of_squares_rule(seed):
    sizes = np.random.default_rng(seed).integers(1, 33, 300)
    numbers, offsets = packing.sum_of_squares(sizes, 32)
    full = int((sizes == 32).sum())
    want = brute_sum_of_squares(sizes.tolist(), 32)
    assert [w if w is None else (w[0] + full, w[1]) for w in want] == [
        None if s == 32 else (int(n), int(o)) for s, n, o in zip(sizes, numbers, offsets)
    ]


def test_packing_covers_every_id_once(documents, library, words):
    rows = [(i, words(i, 30 + 40 * i)) for i in range(60)] + [(1000, None), (1001, ""), (1002, words(9, 9000)), (5, words(5, 230)), (None, "a b")]
    out = packing.id_lists(packing.pack_documents(documents(rows), PATH, window=256)).collect()
    whole = {}
    for key, text in rows:
        whole.setdefault(key, library.encode(text or "", add_special_tokens=False).ids + [packing.END_ID])
    filled = {}
    for r in out:
        assert r.ids == whole[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(whole[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(array("I", r.ids).tobytes())
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in out) == sum(len(whole[k]) for k, _ in rows)
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert sum(r.length for r in out) / (256 * len(filled)) > 0.9


def test_packing_query_moves_token_ids(spark, sf_dir, monkeypatch):
    """The packed rows hold their ids, and the checksum comes from these."""
    from siteloom.llm import packing, queries

    packed, real = [], packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda *a, **k: packed.append(real(*a, **k)) or packed[-1])
    made = queries.QUERIES["op1_sum_of_squares_packing"](spark, sf_dir)
    assert made.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert "ids" in packed[0].columns
    held = packed[0].select(*made.columns).collect()
    assert held and sorted(made.collect()) == sorted(held)


def test_a_worker_keeps_one_object_and_memos_are_bounded_in_bytes():
    import gc
    import weakref

    from siteloom.llm import shared
    from siteloom.llm.textual import Chunks

    first = shared.held(("first",), lambda: Chunks(lambda c: (1,), 1))
    assert shared.held(("first",), list) is first
    gone = weakref.ref(first)
    del first
    shared.held(("second",), lambda: Chunks(lambda c: (2,), 1))
    gc.collect()
    assert gone() is None and len(shared._held) == 1
    calls = []
    memo = shared.Recent(lambda k: calls.append(k) or k.encode(), 20_000)
    for i in range(5000):
        assert memo[f"k{i}"] == b"k%d" % i
    assert len(memo) + len(memo._old) < 300 and memo["k4999"] == b"k4999" and len(calls) == 5000
    for _ in range(2):
        assert len(memo["x" * 100_000]) == 100_000
    assert len(calls) == 5002 and "x" * 100_000 not in memo


def test_a_word_is_encoded_once_whatever_signs_stand_beside_it(library):
    coder = bpe.MergedEncoder(bpe.vocabulary("word_bpe_49k.json"))
    calls, merged = [], coder.word
    coder.word = lambda word: calls.append(word) or merged(word)
    texts = ["Lantern. lantern,\n(LANTERN)\tlantern's Été×étéİ 7", "lantern; café — lantern! Σ"]
    assert [list(array("I", b)) for b in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert calls.count(b"lantern") == 1 and calls.count("été".encode()) == 1
