"""Encoding, token files and packing against the tokenizers library and naive versions."""

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from portloom.llm import bpe, packing, tokenfiles
from portloom.llm.bpe import prefix_encoder
from portloom.llm.chunks import BlockEncoder, ChunkEncoder, segments
from portloom.llm.vocabulary import library_encoder, read_vocabulary

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "a", "Be", "é", "ß", "1", "²", "Ⅷ", "!", "--", "'s", "'LL"]
PARTS += ["​", "　", "中", "😀", "é", "᠎", "<|endoftext|>", "\x00", "aaaa", "İ", "Σ", "%%%%"]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(
    "path, make", [(BYTE, lambda v: prefix_encoder(v)[1]), (BYTE, library_encoder), (WORD, library_encoder)]
)
def test_random_texts_as_the_library(path, make):
    draw, tokenizer, encoder = random.Random(5), Tokenizer.from_file(path), make(read_vocabulary(path))
    for n in range(1500):
        latin = [chr(draw.randint(0, 0x1FF)) for _ in range(8)] if n % 3 == 0 else PARTS
        text = "".join(draw.choice(latin) for _ in range(draw.randint(0, 14)))
        text += "" if n % 3 == 0 else "".join(chr(c) for c in (draw.randint(0, 0x2FFFF) for _ in range(3)) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(tokenizer, text), repr(text)


def block_encoder(most):
    _, whole = prefix_encoder(read_vocabulary(BYTE))
    return BlockEncoder(whole._encode_many, whole._parts, most)


def test_generations_and_segments_change_nothing():
    encoder = library_encoder(read_vocabulary(BYTE))
    texts = [f"word{i % 50} other{i}, and. Then{i % 7}" for i in range(300)]
    want = encoder.encode(texts)
    for small in (ChunkEncoder(encoder.memory._encode_one, encoder._parts, 10), block_encoder(10)):
        assert [small.encode([t])[0] for t in texts] == want
    text = "ab cd  \n ef" * 50
    assert "".join(segments(text, 7)) == text and max(map(len, segments(text, 7))) < 20


def test_long_word_and_block_agree():
    tables, _ = prefix_encoder(read_vocabulary(BYTE))
    words = [b"abcabcabd" * n for n in (1, 5, 7, 8, 30)] + [b"%" * 200, b"x"]
    blocked = [np.frombuffer(w, "<u4").tolist() for w in tables.encode_words(words)]
    assert blocked == [tables.encode_word(w) for w in words]
    assert all(b"".join(tables.bytes_of[i] for i in ids) == w for ids, w in zip(blocked, words, strict=True))


def test_encode_and_decode_edges(edge):
    tokenizer = Tokenizer.from_file(BYTE)
    got = bpe.decode(bpe.encode(edge, BYTE), BYTE, into="decoded").collect()
    assert len(got) == edge.count()
    for r in got:
        assert r.ids == ids_of(tokenizer, r.text) and r.key == "x"
        assert r.decoded == (r.text or "")
    assert bpe.encode(edge.where("false"), BYTE).collect() == []


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([([0, 99_999_999, -1],), (None,), ([],)], "ids array<int>")
    assert [r.text for r in bpe.decode(df, BYTE).collect()] == ["!", "", ""]


@pytest.mark.parametrize("sizes", [[], [0], [1], [4, 0, 3, 5, 1], [1000, 7, 0]])
def test_byte_coding_round_trip(sizes):
    draw, n = np.random.default_rng(len(sizes)), sum(sizes)
    values = draw.choice([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], n).astype(np.uint32)
    ends = np.append(0, np.cumsum(sizes)).astype(np.int64)
    control, control_ends, data, data_ends = tokenfiles.encode_rows(values, ends)
    assert np.diff(control_ends).tolist() == [-(-s // 4) for s in sizes] and len(data) == data_ends[-1]
    assert np.array_equal(tokenfiles.decode_rows(control, data, np.diff(ends)), values)
    for i in range(len(sizes)):  # every row stands for itself
        own = tokenfiles.decode_rows(control[control_ends[i] : control_ends[i + 1]], data[data_ends[i] : data_ends[i + 1]], np.array(sizes[i : i + 1]))
        assert np.array_equal(own, values[ends[i] : ends[i + 1]])


def test_token_files_edges(spark, edge, folder):
    tokenizer = Tokenizer.from_file(BYTE)
    tokenfiles.write_token_files(edge, BYTE, folder("files"), end_id=2)
    got = sorted(tokenfiles.read_token_files(spark, folder("files")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 5, 6, 7]
    start, texts = 0, {}
    for r in edge.collect():
        texts.setdefault(r.doc_id, []).append([*ids_of(tokenizer, r.text), 2])
    for r in got:
        assert r.start == start
        start += r.n_tokens
        texts[r.doc_id].remove(np.frombuffer(r.ids, "<u4").tolist())
    assert not any(texts.values())


def test_token_files_of_nothing(spark, edge, folder):
    tokenfiles.write_token_files(edge.where("false"), BYTE, folder("none"), end_id=2)
    assert tokenfiles.read_token_files(spark, folder("none")).collect() == []


def naive_best_fit(lengths, capacity):
    """Remaining capacities after best-fit decreasing, piece by piece."""
    left = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(left, n)
        bisect.insort(left, (left.pop(i) if i < len(left) else capacity) - n)
    return left


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_naive_best_fit(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 16, 64, 100])
    counts = {n: draw.randint(1, 40) for n in range(1, capacity + 1) if draw.random() < 0.5}
    fill, numbers = {}, {}
    runs = sorted(packing.best_fit_runs(counts, capacity))
    for i, (length, number, first, offset) in enumerate(runs):
        end = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == length else counts[length]
        for k in range(end - number):
            fill.setdefault(first + k, []).append((offset, length))
            numbers.setdefault(length, []).append(number + k)
    assert all(numbers[n] == list(range(c)) for n, c in counts.items())
    left = []
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        left.append(capacity - at)
    assert sorted(left) == naive_best_fit([n for n, c in counts.items() for _ in range(c)], capacity)


def test_segment_tree_finds_the_tightest():
    draw, tree, opened = random.Random(1), packing.Capacities(50), set()
    for _ in range(500):
        c = draw.randint(0, 50)
        tree.set(c, c not in opened)
        opened ^= {c}
        n = draw.randint(0, 50)
        assert tree.tightest(n) == min((x for x in opened if x >= n), default=None)


def test_packing_edges(edge):
    tokenizer = Tokenizer.from_file(WORD)
    got = packing.pack_documents(edge, WORD, capacity=512).collect()
    want = []
    for r in edge.collect():
        ids = np.array([*ids_of(tokenizer, r.text), 0], "<u4")
        for piece, a in enumerate(range(0, len(ids), 512)):
            want.append((r.doc_id, piece, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes())))
    order = lambda r: [(v is not None, v) for v in r]
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) == len(naive_best_fit([w[3] for w in want], 512))
    assert packing.pack_documents(edge.where("false"), WORD).collect() == []


def test_words_with_signs_share_the_words_ids():
    encoder, tokenizer = library_encoder(read_vocabulary(BYTE), 1000), Tokenizer.from_file(BYTE)
    text = "xa, a xa, xa. é! xa ªb; x9, don't, ,"
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(tokenizer, text)
    assert {"xa", " xa", " é"} <= encoder.memory.keys()
