"""Resampling weights, draws and ranks against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from portloom.llm import importance
from portloom.llm.queries import QUERIES
from tests.llm.conftest import DATA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def naive_buckets(text, longest=3, buckets=10_000):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    spans = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(s.encode()) % buckets for s in spans)


def naive_draw(docs, targets, percent=5, min_words=20):
    found = [(d, *naive_buckets(t)) for d, t in docs]
    raw, wanted = Counter(), Counter()
    for _, _, c in found:
        raw.update(c)
    for t in targets:
        wanted.update(naive_buckets(t)[1])
    s_all, t_all = sum(raw.values()), sum(wanted.values())
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000)))) for b in raw
    }
    rows = []
    for d, n, c in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * k for b, k in c.items())
        rows.append([d, n, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return [(r[0], *r[2:], rank.get(id(r))) for r in rows]


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def test_query_equals_plain_version(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    targets = [t for (t,) in duckdb.sql(f"SELECT text FROM '{DATA}/benchmark.parquet'").fetchall()]
    found = QUERIES["op13_importance"](spark, DATA)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert in_order(tuple(r) for r in found.collect()) == in_order(naive_draw(docs, targets))


def test_edge_texts_and_clashing_columns(spark, edge):
    docs = edge.withColumns({c: F.lit("x") for c in ("doc", "id", "row", "rank", "packed", "_at", "n_words", "_part")})
    target = spark.createDataFrame([("seven eight nine ten",), (None,), ("",)], "text string")
    found = importance.resample(docs, target, percent=50, min_words=5).collect()
    plain = naive_draw([(r.doc_id, r.text) for r in docs.collect()], ["seven eight nine ten"], 50, 5)
    got = [(r.doc.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found]
    ranks = sorted(r[4] for r in plain if r[4])
    assert sorted(r[4] for r in got if r[4]) == ranks
    assert in_order(r[:4] for r in got) == in_order(r[:4] for r in plain)
    kept = importance.drawn_documents(docs, target, percent=50, min_words=5)
    assert kept.columns == docs.columns and kept.count() == len(ranks)


def test_equal_scores_go_to_the_smaller_id(spark):
    rows = [(i % 7, "one two three four five") for i in range(70)] + [(None, "one two three four five")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    target = spark.createDataFrame([("one two",)], "text string")
    found = [r for r in importance.resample(docs, target, percent=100, min_words=5).collect()]
    by_rank = sorted((r["rank"], r.score, r.doc.doc_id) for r in found)
    assert [r[0] for r in by_rank] == list(range(1, 76))
    assert [(-s, d is None, d or 0) for _, s, d in by_rank] == sorted((-s, d is None, d or 0) for _, s, d in by_rank)


def test_empty_tables(spark, documents):
    nothing = documents.limit(0)
    target = spark.createDataFrame([], "text string")
    assert importance.resample(nothing, target).count() == 0
    found = importance.resample(documents, target)
    assert found.count() == documents.count() and found.where("rank is not null").count() > 0


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_other_lengths(longest):
    pattern = importance.span_pattern(longest)
    for text in ("", "a", "A  b", "x-y z", "é ü;ß 9 a b c", "one " * 50):
        n, counts = importance.bucket_counts(text, pattern, longest, 97)
        words, want = naive_buckets(text, longest, 97)
        assert n == words and {i: int(c) for i, c in enumerate(counts) if c} == dict(want)
