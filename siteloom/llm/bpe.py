"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

Every accepted word is a path of arcs; each arc carries one token as its label. The automaton starts with one arc
for each byte symbol. The merges are compiled in order of rank: the gadget of the merge ``(u, v) -> w`` sends every
state that is reached by an arc ``u`` to a fresh state, from which ``v`` is replaced by the arc ``w``. What makes
the composed gadgets deterministic and small is that whether two tokens may stand side by side in a canonical
tokenization depends on these two tokens alone. So the states of the finished automaton are the tokens (the label
of the arc just taken), and the gadgets leave behind one table: the pairs of tokens that a merge forbids, found
along the right spine of the left token and the left spine of the right one.

Encoding reads symbols left to right, and keeps for each position the one state that is reached there by a valid
path. A step tries the tokens that end at this position, longest first, and takes the one whose arc leaves the
state at its start. A valid path to a position is unique, so one state a position is the whole run of the
automaton. Decoding emits the arcs' labels.

Source: Berglund, Martens, van der Merwe, "Constructing a BPE tokenization DFA" (2024).
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from siteloom.llm.shared import Recent, held, map_texts


# The vocabulary file's rules for splitting and word ends.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Read after each word; no byte stands for it.
END = chr(256)
# Characters that str.split() takes for white space and the file's pattern doesn't.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
# Chunks on which every Unicode version agrees: Latin letters, composed, and ASCII signs.
SIMPLE = r"[!-~\u00c0-\u017e]+"
# Texts of such chunks between plain white space, and the file's rule for splitting them once they are lower-cased.
SIMPLE_TEXT = r"[!-~\u00c0-\u017e \t\n\v\f\r]*"
SIMPLE_LETTERS = r"a-z\u00df-\u00f6\u00f8-\u017e"
SIMPLE_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[{SIMPLE_LETTERS}]+|[0-9]|[^\s{SIMPLE_LETTERS}0-9]+"
# A word costs more to merge than a hashed chunk to describe, so this memo is larger: two generations of this size, of
# which words take three quarters and chunks outside simple texts the rest.
MEMO_BYTES = 80_000_000


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others take code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)).difference(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Automaton:
    """The compiled merges: ``step(state, token)`` tells whether the arc exists, ``labels`` what it emits."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.vocab = vocab
        self.labels = [""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            self.labels[number] = token
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(pairs):
            made = vocab[left + right]
            pair = (vocab[left], vocab[right])
            self.merge[pair] = made
            if made not in self.rank:  # the first gadget that makes the token is the one that acts
                self.halves[made], self.rank[made] = pair, rank
        self.pair_rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.arcs: dict[int, bool] = {}
        self.scan = ahocorasick.Automaton()
        unprintable = {ord(symbol): byte for byte, symbol in byte_symbols().items()}
        for token, number in vocab.items():
            if self._whole(number):
                read = token.removesuffix(WORD_END).translate(unprintable) + (END if token.endswith(WORD_END) else "")
                self.scan.add_word(read, (number, len(read)))
        self.scan.make_automaton()

    def step(self, state: int, token: int) -> bool:
        """Is there an arc for ``token`` from the state that the arc ``state`` reached?

        Walks back through the merge gadgets: an arc is cut where a gadget would have joined parts of the two
        neighbours before the later of them was made.
        """
        if len(self.arcs) > 1_000_000:  # the table holds arcs in use; it is filled again on demand
            self.arcs.clear()
        known = self.arcs[state << 20 | token] = self._composed(state, token)
        return known

    def _composed(self, left: int, right: int, last: int | None = None) -> bool:
        """Undo both tokens, the later merge first; ``last`` bounds the ranks that act before the undone merge."""
        last = len(self.pair_rank) if last is None else last
        while True:
            if self.pair_rank.get((left, right), last) < last:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                last, left = a, self.halves[left][1]
            else:  # a merge acts from left to right: one of the same rank across the border comes first
                last, right = b + 1, self.halves[right][0]

    def _whole(self, token: int) -> bool:
        """A token labels arcs only if the gadgets, applied to its own symbols, leave it whole."""
        if token not in self.halves:
            return True
        left, right = self.halves[token]
        return self._composed(left, right, self.rank[token]) and self._whole(left) and self._whole(right)

    def accepts(self, path: list[int]) -> bool:
        """Is ``path`` the run of the automaton over the symbols it spells? There is one run a word."""
        arcs = self.arcs
        for state, token in zip(path, path[1:]):
            known = arcs.get(state << 20 | token)
            if not (self.step(state, token) if known is None else known):
                return False
        return True

    def encode(self, word: str) -> list[int]:
        """The one path through the automaton that reads ``word``, one character a byte, and its end."""
        n = len(word) + 1
        states = [-1] * (n + 1)
        starts = [0] * (n + 1)
        arcs = self.arcs
        for end, (token, size) in self.scan.iter(word + END):
            end += 1
            if states[end] < 0:
                begin = end - size
                if begin:
                    state = states[begin]
                    if state < 0:
                        continue
                    known = arcs.get(state << 20 | token)
                    if not (self.step(state, token) if known is None else known):
                        continue
                states[end], starts[end] = token, begin
        if states[n] < 0:
            raise ValueError(f"no path reads {word!r}")
        path = []
        while n:
            path.append(states[n])
            n = starts[n]
        return path[::-1]


class Encoder:
    """Whole texts to token ids: words, and chunks between white space, are encoded once and remembered."""

    def __init__(self, path: str, memo: int = MEMO_BYTES):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.automaton = Automaton(model["vocab"], model["merges"])
        self.labels = self.automaton.labels + [""] * (max([*self.special.values(), -1]) + 1 - len(self.automaton.labels))
        for content, number in self.special.items():
            self.labels[number] = content
        self._library = Tokenizer.from_file(path)
        self._bytes = {symbol: byte for byte, symbol in byte_symbols().items()}
        self._split = regex.compile(SPLIT).findall
        self._simple = regex.compile(SIMPLE).fullmatch
        self._marks = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        self._spaces = regex.compile(r"\s+").split
        self._simple_text = re.compile(SIMPLE_TEXT).fullmatch
        self._simple_split = re.compile(SIMPLE_SPLIT).findall
        self._memo = Recent(self._coded, memo // 4)
        self._known = Recent(lambda word: self.word(word.encode("utf-8")), memo - memo // 4)

    def word(self, word: bytes) -> bytes:
        return array("I", self.automaton.encode(word.decode("latin-1"))).tobytes()

    def _words(self, chunk: str) -> list[bytes]:
        """The words of a chunk by the library's own tables of what is a letter and how it is lower-cased and composed."""
        mapped = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(chunk))
        return [bytes(map(self._bytes.__getitem__, w)) for w, _ in mapped]

    def _chunks(self, text: str) -> list[str]:
        if any(c in text for c in NOT_SPACE):
            return self._spaces(text)
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text. No word holds white space, so chunks are independent.

        Simple texts are split into words at once: these repeat more often than chunks, which carry signs beside them.
        """
        return [self._text(text) for text in texts]

    def _text(self, text: str) -> bytes:
        if "<|" in text:  # special tokens are found in the raw text, before anything else
            pieces = [[p] if p in self.special else self._chunks(p) for p in self._marks.split(text)]
            return b"".join([self._memo[chunk] for piece in pieces for chunk in piece])
        if self._simple_text(text):
            return b"".join(map(self._known.__getitem__, self._simple_split(text.lower())))
        return b"".join(map(self._memo.__getitem__, self._chunks(text)))

    def _coded(self, chunk: str) -> bytes:
        if chunk in self.special:
            return array("I", [self.special[chunk]]).tobytes()
        if self._simple(chunk):
            return b"".join(map(self._known.__getitem__, self._split(chunk.lower())))
        return b"".join(map(self.word, self._words(chunk)))

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs; this file names no decoder, so labels are joined by one space."""
        return " ".join(map(self.labels.__getitem__, array("I", ids)))


class MergedEncoder(Encoder):
    """The same ids with words merged by a public rank merger; the automaton accepts its path or finds the right one.

    The merger joins any two neighbours whose text is a token; a merge list joins only the pairs it names.
    """

    def __init__(self, path: str, memo: int = MEMO_BYTES):
        super().__init__(path, memo)
        raw = {symbol: byte for symbol, byte in self._bytes.items()}
        ranks = {}
        for number, token in enumerate(self.automaton.labels):
            bare = bytes(raw[c] for c in token.removesuffix(WORD_END))
            ranks[bare + (b"\xff" if token.endswith(WORD_END) else b"")] = number
        self._merge = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def word(self, word: bytes) -> bytes:
        path = self._merge(word + b"\xff")
        if not self.automaton.accepts(path):
            return super().word(word)
        return array("I", path).tobytes()


def encoder(path: str) -> Encoder:
    return held(("automaton", path), lambda: Encoder(path))


def encode_decode(df: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), full: bool = True) -> DataFrame:
    """Token ids of every whole text and their decoding.

    Adds ``ids array<int>`` and ``decoded string`` (left out with ``full=False``), ``n_tokens long``,
    ``ids_sha256`` over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over UTF-8. A null
    text is empty, and an empty one has no ids. Rows stay as they are, repeated ones too; only ``keep`` columns
    pass through, so other columns can't clash.
    """

    def rows(texts: list[str]) -> dict[str, pa.Array]:
        coder = encoder(path)
        made = coder.encode(texts)
        decoded = [coder.decode(b) for b in made]
        out = {
            "n_tokens": pa.array([len(b) // 4 for b in made], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in made]),
            "decoded_sha256": pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded]),
        }
        if full:
            offsets = np.cumsum([0, *[len(b) // 4 for b in made]]).astype("int32")
            flat = np.frombuffer(b"".join(made), dtype="<u4").astype("int32")
            out = {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), "decoded": pa.array(decoded)} | out
        return out

    extra = "ids array<int>, decoded string, " if full else ""
    return map_texts(df, list(keep), text, f"{extra}n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows)
