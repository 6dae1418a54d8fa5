"""MinHash groups against all pairs of full shingle sets."""

import random
import re

import duckdb
import pytest

from portloom.llm import minhash
from portloom.llm.queries import QUERIES
from tests.llm.conftest import DATA


def naive_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {" ".join(words)} - {""}
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def naive_rows(docs, size, percent=80):
    sets = [naive_set(t, size) for _, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            small, large = sorted((len(a), len(sets[j])))
            if small and 100 * small >= percent * large:
                both = len(a & sets[j])
                if 100 * both >= percent * (small + large - both):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(docs):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return in_order(out)


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def test_query_equals_all_pairs(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    found = QUERIES["op12_minhash"](spark, DATA)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert in_order(tuple(r) for r in found.collect()) == naive_rows(docs, 2)


def clusters(draw, groups, vocabulary=400):
    """Texts in groups whose members differ by a few words, so that links of 0.8 are found and missed."""
    rows = []
    for _ in range(groups):
        base = [f"w{draw.randint(0, vocabulary)}" for _ in range(draw.choice([0, 1, 2, 12, 40, 120]))]
        for _ in range(draw.randint(1, 9)):
            own = list(base)
            for _ in range(draw.randint(0, 1 + len(own) // 12)):
                if own:
                    own[draw.randrange(len(own))] = f"x{draw.randint(0, 9)}"
            rows.append((len(rows) + 1, " ".join(own)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("crowded", "size"), [(128, 2), (4, 2), (6, 5)])
def test_groups_at_every_depth(spark, crowded, size, monkeypatch):
    monkeypatch.setattr(minhash, "PAIRS_PER_SLICE", 3)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 10 if crowded else 2_000_000)
    rows = clusters(random.Random(size + crowded), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = in_order(tuple(r) for r in minhash.near_duplicates(docs, size, crowded=crowded).collect())
    want = naive_rows(rows, size)
    if crowded > 100:
        assert found == want
    else:  # crowded regions: links of little more than 0.8 may be missed, none invented
        smaller = {d: c for d, _, c, _ in want}
        assert [r[:2] for r in found] == [r[:2] for r in want]
        assert all(smaller[d] == smaller[c] for d, _, c, _ in found)
        assert sum(f == w for f, w in zip(found, want, strict=True)) >= 0.95 * len(want)


@pytest.mark.parametrize("per_block", [3, 4096])
def test_crowded_regions_lose_no_link(spark, per_block, monkeypatch):
    """Groups of near copies whose links lie around 0.8, in regions far larger than the bound."""
    monkeypatch.setattr(minhash, "PER_BLOCK", per_block, raising=False)
    draw = random.Random(11)
    rows = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(60 + group)]
        for _ in range(40):
            own = list(base)
            for at in draw.sample(range(len(own)), draw.choice([1, 2, 3, 4])):
                own[at] = f"x{draw.randint(0, 10**6)}"
            rows.append((len(rows) + 1, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(minhash, "ROUNDS", 0)  # no neighbours: all links come from the regions
    found = minhash.near_duplicates(docs, 2, crowded=2)
    assert in_order(tuple(r) for r in found.collect()) == naive_rows(rows, 2)


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i + 1, " ".join(words[10 * i : 10 * i + 100])) for i in range(30)]  # neighbours share 89 of 109 pairs
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
    assert {r.component_id for r in found.collect()} == {1}


def test_large_groups_of_copies(spark):
    base = [f"w{i}" for i in range(60)]
    near = [(i, " ".join([*base[:30], f"n{i}", *base[31:]])) for i in range(1000, 2500)]
    rows = [(i, " ".join(base)) for i in range(500, 1000)] + near + [(7, "of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    found = minhash.near_duplicates(docs, shingle=2).collect()
    assert {r.component_id for r in found if r.doc_id > 7} == {500}
    assert [r.doc_id for r in found if r.kept] in ([7, 500], [500, 7])


def test_edge_texts(spark, edge):
    found = minhash.near_duplicates(edge, shingle=2)
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    assert in_order(tuple(r) for r in found.collect()) == naive_rows(docs, 2)
    assert minhash.near_duplicates(edge.limit(0)).count() == 0
    with pytest.raises(ValueError, match="80"):
        minhash.near_duplicates(edge, percent=50)
