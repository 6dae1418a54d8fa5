"""Spelling variants against plain versions: counts, gram bounds, pairs, forms and roots."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from portloom.llm import variants
from portloom.llm.queries import QUERIES
from tests.llm.conftest import DATA


def edits(word, letters):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b for a, b in cut for c in letters}
    return (out | {a + c + b[1:] for a, b in cut if b for c in letters}) - {word}


def naive_counts(docs, one_in=None, min_length=6, min_count=5):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= min_count}


def naive_groups(counts, ratio=5):
    letters = {c for w in counts for c in w}
    near = {w: [v for v in edits(w, letters) if v in counts] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(rows)


def test_query_equals_plain_version(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    found = QUERIES["op11_spelling_variants"](spark, DATA)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in found.collect()) == naive_groups(naive_counts(docs, 199))


def words_near(draw, n, alphabet="abcde", sizes=(4, 5, 6, 9, 14)):
    """Words in chains and clusters of single edits."""
    out = set()
    while len(out) < n:
        word = "".join(draw.choice(alphabet) for _ in range(draw.choice(sizes)))
        for _ in range(draw.randint(1, 6)):
            out.add(word)
            longer = [v for v in edits(word, alphabet) if len(v) >= 4]
            word = draw.choice(sorted(longer))
    return out


@pytest.mark.parametrize("grams", [4, 64, 1 << 14])
def test_pairs_and_groups_of_any_dictionary(spark, grams):
    draw = random.Random(grams)
    counts = {w: draw.choice([1, 2, 6, 30, 200, 1000]) for w in words_near(draw, 700)}
    counts |= {"x" * 500: 3, "x" * 501: 90, "ab" * 40: 7, "ab" * 40 + "a": 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    found = variants.variant_groups(words, grams=grams)
    assert sorted(tuple(r) for r in found.collect()) == naive_groups(counts)


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 10**9))
def test_an_edit_changes_no_more_grams_than_the_bound(seed):
    draw = random.Random(seed)
    words = [*words_near(draw, 12, "abc", (4, 6, 9)), "abc" * 4]
    total = Counter(w[i : i + q] for w in words for q in range(2, 6) for i in range(len(w) - q + 1))
    least = draw.choice([1, 2, 3])
    d = variants.Dictionary({g: n for g, n in total.items() if n >= least}, draw.choice([1, 2, 4]))
    word = draw.choice(words)
    spans = d.decompose(word)
    assert [s for s, _ in spans] == sorted({s for s, _ in spans}) and [e for _, e in spans] == sorted({e for _, e in spans})
    own = {(a, word[a:b]) for a, b in spans}, {(len(word) - a, word[a:b]) for a, b in spans}
    for other in edits(word, "abcz"):
        if len(other) < 4:
            continue
        theirs = d.decompose(other)
        left = {(a, other[a:b]) for a, b in theirs} & own[0]
        right = {(len(other) - a, other[a:b]) for a, b in theirs} & own[1]
        kept = {a for a, _ in left} | {len(word) - a for a, _ in right}
        assert len(kept) >= len(spans) - d.affected(word, spans), (word, other)


def test_frequent_grams_are_limited(spark):
    words = spark.createDataFrame([(w, 5) for w in words_near(random.Random(5), 900, "abcdefgh")], "word string, n long")
    d = variants.gram_dictionary(words, grams=600)
    assert d.grams and all(n <= 600 for n in Counter(map(len, d.frequent)).values())


def test_edge_texts(spark, edge):
    found = variants.group_variants(edge, min_count=1, rewrite=variants.letter_lost(3))
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    assert sorted(tuple(r) for r in found.collect()) == naive_groups(naive_counts(docs, 3, min_count=1))
    assert variants.group_variants(edge.limit(0)).count() == 0
    with pytest.raises(ValueError, match="letters"):
        variants.group_variants(edge, min_length=3)


@pytest.mark.parametrize("short", [0, 256])
def test_one_edit_of_short_and_long_words(spark, short, monkeypatch):
    monkeypatch.setattr(variants, "SHORT_WORD", short)
    counts = {w: 9 for w in words_near(random.Random(8), 500, "abé")}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in variants.variant_groups(words).collect()) == naive_groups(counts)


def test_very_long_words(spark):
    long = "lorem" * 100_000
    rows = [(1, f"{long} {long}"), (2, f"{long}x {long[1:]}"), (3, "short words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.word[-3:] + str(len(r.word)): r for r in variants.group_variants(docs, ratio=2, min_count=1).collect()}
    assert found["rem500000"].n_near == 2 and found["emx500001"].form == long and found["rem499999"].root == long
