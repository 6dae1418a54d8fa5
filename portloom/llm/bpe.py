"""Byte-pair encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word exactly one token can be the last one of its encoding. A token that
matches the end of the prefix is that one if it may follow the last token of the prefix before it,
that is, if no merge of lower rank reaches over the border between the two. The matches come from
an automaton over the vocabulary read from the end (a walk back from the border meets every token
that is a suffix there), the border test undoes the two tokens' merges from the latest on. The ids
are then read along the back pointers. Words of one length class are worked on together in numpy.

Defined results: a null text is empty and gives no ids; ids that the vocabulary lacks decode to
nothing; bytes that are not UTF-8 decode to U+FFFD as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from portloom.llm.bytelevel import ASCII_WORD, WORD, byte_letters
from portloom.llm.chunks import BlockEncoder, TextParts, spaced_chunks
from portloom.llm.frames import map_arrow, with_column
from portloom.llm.vocabulary import read_vocabulary, special_ids

START = -2  # "last token" of the empty prefix
NONE = -1
LONG_WORD = 64  # longer words go one by one
WORDS_AT_ONCE = 1 << 15
#: Chunks kept per generation; encoding and decoding tasks share an executor's memory.
REMEMBERED = 200_000


class PairTable:
    """Pairs of small numbers to a number, looked up for whole arrays (open addressing)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        keys = self._key(left, right)
        self._bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self._keys = np.full(1 << self._bits, -1, dtype=np.int64)
        self._values = np.full(1 << self._bits, NONE, dtype=np.int32)
        self._probes, todo, at = 0, np.arange(len(keys)), self._slot(keys)
        while len(todo):
            self._probes += 1
            free = self._keys[at[todo]] < 0
            _, first = np.unique(at[todo], return_index=True)
            taken = np.zeros(len(todo), dtype=bool)
            taken[first] = True
            taken &= free
            put = todo[taken]
            self._keys[at[put]], self._values[at[put]] = keys[put], value[put]
            todo = todo[~taken]
            at[todo] = (at[todo] + 1) & (len(self._keys) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pairs' values, ``NONE`` for unknown pairs."""
        keys = self._key(left, right)
        at = self._slot(keys)
        found = self._keys[at]
        out = np.where(found == keys, self._values[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        for _ in range(self._probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self._keys) - 1)
            found = self._keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class PrefixEncoder:
    """Tables of one byte-level vocabulary and the dynamic program over them."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model["dropout"] or model["byte_fallback"] or model["end_of_word_suffix"]:
            raise ValueError("only byte-level vocabularies without word ends are supported")
        of_letter = {c: b for b, c in byte_letters().items()}
        vocab = model["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_of = [b""] * size
        for text, i in vocab.items():
            self.bytes_of[i] = bytes(of_letter[c] for c in text)
        for token in spec["added_tokens"]:
            self.bytes_of[token["id"]] = token["content"].encode()
        self.length = np.array([len(b) for b in self.bytes_of], dtype=np.int32)

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int32)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int32)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        if len(np.unique(made)) != len(made):
            raise ValueError("a token with two merges is not supported")
        self.rank = np.full(size, NONE, dtype=np.int32)
        self.left, self.right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        self.rank[made], self.left[made], self.right[made] = np.arange(len(made)), left, right
        self.merge_rank = PairTable(left, right, np.arange(len(made), dtype=np.int32))
        self._merges = {(a, b): r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True))}
        # tokens that the merges themselves lead to; no other token ever stands in an encoding
        reached = np.array([i for i in vocab.values() if self.length[i] == 1 or self.rank[i] >= 0], dtype=np.int32)
        built = reached[self.rank[reached] >= 0]
        kept = self.may_follow(self.left[built], self.right[built], self.rank[built])
        self._build_suffixes([*reached[self.rank[reached] < 0].tolist(), *built[kept].tolist()])

    def _build_suffixes(self, tokens: list[int]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        ends = {}
        for token in tokens:
            node = 0
            for byte in reversed(self.bytes_of[token]):
                node = nodes.setdefault((node, byte), len(nodes) + 1)
            ends[node] = token
        self.token_at = np.full(len(nodes) + 1, NONE, dtype=np.int32)
        self.token_at[list(ends)] = list(ends.values())
        edges = np.array(list(nodes), dtype=np.int64).reshape(-1, 2)
        self.step = PairTable(edges[:, 0], edges[:, 1], np.array(list(nodes.values()), dtype=np.int32))
        self._nodes = nodes

    def may_follow(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether token ``b`` may stand after token ``a``: walking back through their merges, the
        two pieces at the border must never have a merge that comes before they were merged away."""
        ok = np.ones(len(a), dtype=bool)
        rows, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int32).max, dtype=np.int32) if limit is None else limit.copy()
        while len(rows):
            crossing = self.merge_rank(a, b)
            bad = (crossing >= 0) & (crossing < limit)
            ok[rows[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            rows, a, b, ra, rb = rows[go], a[go], b[go], ra[go], rb[go]
            undo_a = ra > rb
            # equal merges run from the left: one of ``b`` at the same rank comes after the border's
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def _may_follow_one(self, a: int, b: int) -> bool:
        limit = len(self.rank) + 1
        while True:
            crossing = self._merges.get((a, b))
            if crossing is not None and crossing < limit:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, int(self.right[a])
            else:
                limit, b = rb + 1, int(self.left[b])

    def encode_word(self, word: bytes) -> list[int]:
        """The same for one word, byte by byte; its time grows with the word's length."""
        last = [START] + [NONE] * len(word)
        for end in range(1, len(word) + 1):
            node, at = 0, end
            while at and (node := self._nodes.get((node, word[at - 1]))) is not None:
                at -= 1
                token, before = int(self.token_at[node]), last[at]
                if token != NONE and before != NONE and (before == START or self._may_follow_one(before, token)):
                    last[end] = token
                    break
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= int(self.length[last[at]])
        return ids[::-1]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        long_words = int((lengths > LONG_WORD).sum())
        for i in order[:long_words]:
            out[i] = np.array(self.encode_word(words[i]), dtype="<u4").tobytes()
        for at in range(long_words, len(words), WORDS_AT_ONCE):
            rows = order[at : at + WORDS_AT_ONCE]
            for i, ids in zip(rows, self._encode_block([words[i] for i in rows], lengths[rows]), strict=True):
                out[i] = ids
        return out

    def _encode_block(self, words: list[bytes], lengths: np.ndarray) -> Iterator[bytes]:
        """``words`` are sorted by falling length, so the words that have a byte come first."""
        n, longest = len(words), int(lengths[0]) if len(words) else 0
        if not longest:
            yield from (b"" for _ in words)
            return
        letters = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(n, longest)
        letters = np.ascontiguousarray(letters.T)
        last = np.full((longest + 1, n), NONE, dtype=np.int32)
        last[0] = START
        for end in range(1, longest + 1):
            rows = np.arange(int(np.searchsorted(-lengths, -end, side="right")))
            node = np.zeros(len(rows), dtype=np.int32)
            for at in range(end - 1, -1, -1):
                node = self.step(node, letters[at][rows])
                alive = node >= 0
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                token, before = self.token_at[node], last[at][rows]
                found = (token >= 0) & (before == START)
                ask = np.flatnonzero((token >= 0) & (before >= 0))
                found[ask] = self.may_follow(before[ask], token[ask])
                last[end][rows[found]] = token[found]
                rows, node = rows[~found], node[~found]
        ids = np.zeros((n, longest), dtype="<u4")
        rows, at, column = np.arange(n), lengths.copy(), np.full(n, longest, dtype=np.int64)
        while len(rows):
            rows = rows[at[rows] > 0]
            token = last[at[rows], rows]
            column[rows] -= 1
            ids[rows, column[rows]] = token
            at[rows] -= self.length[token]
        flat, width = ids.tobytes(), longest * 4
        for i, first in enumerate(column.tolist()):
            yield flat[i * width + first * 4 : (i + 1) * width]


_ENCODERS: dict[str, tuple[PrefixEncoder, BlockEncoder]] = {}


def prefix_encoder(vocabulary: str) -> tuple[PrefixEncoder, BlockEncoder]:
    """Tables and chunk memory of a vocabulary, once per worker process."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _ENCODERS:
        spec = json.loads(vocabulary)
        tables = PrefixEncoder(spec)

        def encode_many(chunks: list[str]) -> list[bytes]:
            split = [(ASCII_WORD if c.isascii() else WORD).findall(c) for c in chunks]
            distinct = list({w for ws in split for w in ws})
            ids = dict(zip(distinct, tables.encode_words([w.encode() for w in distinct]), strict=True))
            return [b"".join(map(ids.__getitem__, ws)) for ws in split]

        parts = TextParts(spaced_chunks, special_ids(spec))
        _ENCODERS[key] = tables, BlockEncoder(encode_many, parts, REMEMBERED)
    return _ENCODERS[key]


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds the exact ids of every whole text as an array of integers."""
    vocabulary = read_vocabulary(vocabulary_path)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, encoder = prefix_encoder(vocabulary)
        coded = encoder.encode(batch.column(text).to_pylist())
        flat = np.frombuffer(b"".join(coded), dtype="<i4")
        ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
        return with_column(batch, into, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))

    return map_arrow(df, add, {into: T.ArrayType(T.IntegerType())}, sized_by=text)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """Replaces or adds ``into`` with the text of the ids; a null list is an empty text."""
    vocabulary = read_vocabulary(vocabulary_path)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        tables, _ = prefix_encoder(vocabulary)
        size = len(tables.bytes_of)

        def text_of(tokens: np.ndarray) -> str:
            known = tokens[(tokens >= 0) & (tokens < size)]
            return b"".join(map(tables.bytes_of.__getitem__, known.tolist())).decode("utf-8", "replace")

        column = batch.column(ids)
        flat = column.values.to_numpy(zero_copy_only=False)
        ends, given = column.offsets.to_numpy(), column.is_valid().to_pylist()
        texts = [text_of(flat[ends[i] : ends[i + 1]]) if given[i] else "" for i in range(len(column))]
        return with_column(batch, into, pa.array(texts, pa.string()))

    return map_arrow(df, add, {into: T.StringType()}, sized_by=ids)
