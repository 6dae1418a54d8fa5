"""Archives, exact search, the registered queries and the pipeline."""

import base64
import gzip
import hashlib
import os
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from portloom.llm import pii, staging, topk, warc
from portloom.llm.queries import QUERIES
from portloom.session import stored
from tests.llm.conftest import DATA
from tests.llm.test_dedup import naive_fingerprint, naive_groups, naive_lines
from tests.llm.test_rules import naive_verdicts, order


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def naive_pages(rows, least=0):
    first = {}
    for page, html in rows:
        payload = (html or "").encode()
        if page is not None and len(payload) >= least:
            first[payload] = min(page, first.get(payload, page))
    count = {}
    for _, html in rows:
        count[html or ""] = count.get(html or "", 0) + 1
    out = []
    for page, html in rows:
        payload = (html or "").encode()
        of = first.get(payload) if count[html or ""] > 1 else None
        kind = "revisit" if of is not None and page != of else "response"
        out.append((page, len(payload), digest(payload), kind, of if kind == "revisit" else None))
    return sorted(out, key=order)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_round_trip(spark, folder, least):
    rows = [(i, f"<p>page {i % 7}</p>") for i in range(40)] + [(50, None), (51, ""), (52, "ab"), (53, "ab")]
    rows += [(None, "<p>page 3</p>"), (None, "only without id"), (3, "<p>page 3</p>"), (54, "é中" * 30_000)]
    pages = spark.createDataFrame([(p, f"http://x/{p}\n", h, "x") for p, h in rows], "page_id long, url string, html string, digest string")
    warc.write_archives(pages, folder("out"), least)
    got = warc.read_archives(spark, folder("out")).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=order) == naive_pages(rows, least)
    texts = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert texts[54] == "é中" * 30_000
    files = list(Path(folder("out")).glob("part-*"))
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\nWARC-Type") for f in files) == len(rows)


def test_no_pages(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, folder("none"))
    assert warc.read_archives(spark, folder("none")).collect() == []


def test_large_record_ends_with_an_empty_member(monkeypatch):
    content = os.urandom(1 << 16) * 257  # over 16 MiB
    row = warc.row_of(content)
    assert gzip.decompress(row + b"\0") == content


@pytest.mark.parametrize("size", ["700", "5k", "1m"])
def test_ranges_cut_anywhere(spark, folder, size):
    """Magic bytes inside records, records over many ranges, foreign members between them."""
    draw, want, path = random.Random(4), {}, Path(folder("cut"))
    path.mkdir()
    with open(path / "a.warc", "wb") as out:
        for i in range(60):
            payload = bytes(draw.choice(b"\x1f\x8b\x08ab") for _ in range(draw.randint(0, 3000)))
            packer = zlib.compressobj(0 if i % 2 else 6, zlib.DEFLATED, 31)
            out.write(packer.compress(warc.record(i, None, payload, None, False)) + packer.flush())
            if i % 9 == 0:
                out.write(gzip.compress(b"not a record"))
            want[i] = payload
    small = {"maxPartitionBytes": size, "openCostInBytes": "0", "minPartitionNum": "200"}
    for k, v in small.items():
        spark.conf.set(f"spark.sql.files.{k}", v)
    try:
        got = warc.read_archives(spark, str(path)).collect()
    finally:
        for k in small:
            spark.conf.unset(f"spark.sql.files.{k}")
    assert len(got) == len(want) and {r.page_id: bytes(r.payload) for r in got} == want


@pytest.mark.parametrize("size", ["150", "700", "1m"])
def test_magic_in_the_header_of_a_member(spark, folder, size):
    """A member's first piece is too short to show its record, for some by over 256 bytes."""
    draw, want, path, magic = random.Random(6), {}, Path(folder("header")), b"\x1f\x8b\x08"
    path.mkdir()
    fields = [b"", b"a" + magic + b"b\0", magic * 3 + b"\0", b"n" * 400 + magic + b"m" * 300 + magic + b"\0"]
    with open(path / "a.warc", "wb") as out:
        for i in range(40):
            payload = bytes(draw.choice(b"\x1f\x8b\x08ab") for _ in range(draw.randint(0, 300)))
            content, name = warc.record(i, None, payload, None, False), fields[i % 4]
            packer = zlib.compressobj(0 if i % 3 else 6, zlib.DEFLATED, -15)
            out.write(magic + bytes([8 if name else 0, 0, 0, 0, 0, 0, 255]) + name + packer.compress(content) + packer.flush())
            out.write(zlib.crc32(content).to_bytes(4, "little") + len(content).to_bytes(4, "little"))
            if i % 5 == 0:
                out.write(gzip.compress(b"not a record"))
            want[i] = payload
    small = {"maxPartitionBytes": size, "openCostInBytes": "0", "minPartitionNum": "400"}
    for k, v in small.items():
        spark.conf.set(f"spark.sql.files.{k}", v)
    try:
        got = warc.read_archives(spark, str(path)).collect()
    finally:
        for k in small:
            spark.conf.unset(f"spark.sql.files.{k}")
    assert len(got) == len(want) and {r.page_id: bytes(r.payload) for r in got} == want


def test_pieces_that_only_look_like_a_start():
    """Undecided pieces of packed data before a record do not hide it."""
    member = warc._member(warc.record(1, None, b"x", None, False)).removeprefix(warc.MAGIC)
    undecided = bytes([4, 0, 0, 0, 0, 0, 255, 255, 255])  # a header with an extra field of 64 KiB
    reader = warc._Assembly(False)
    found = [c for piece in (undecided, member, member) for c in reader.add(piece)]
    assert found == [] and reader.rest() == [(None, [undecided, member, member])]
    assert [warc.parse(c)[0] for c in reader.finish()] == [1, 1]
    assert reader.rest() == [(True, [undecided])]


def naive_top(vectors, queries, k):
    out = []
    for q in queries:
        x = dict(vectors)[q]
        scores = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for i, v in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("n, k, kind", [(300, 5, "plain"), (300, 20, "groups"), (12, 20, "plain"), (200, 10, "ties")])
def test_search_as_brute_force(spark, n, k, kind, monkeypatch):
    for name, value in (("QUERY_BLOCK", 7), ("CANDIDATE_BLOCK", 50), ("FIRST_LOOK", 4), ("SEEDS", 40), ("PIVOTS", 8)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(n + k)
    x = draw.integers(-9, 9, (n, 6)).astype(float)
    if kind == "groups":
        x = np.repeat(draw.integers(-60, 60, (n // 30, 6)), 30, axis=0) + draw.integers(-1, 2, (n, 6)).astype(float)
    if kind == "ties":
        x = np.sign(x)
    vectors = [(i * 3, row.tolist()) for i, row in enumerate(x)]
    df = spark.createDataFrame(vectors, "vec_id long, x array<double>")
    asked = df.where("vec_id % 4 = 0").select("vec_id")
    got = topk.top_k(df, asked, k, id_col="vec_id").collect()
    assert sorted(tuple(r) for r in got) == naive_top(vectors, [i for i, _ in vectors if i % 4 == 0], k)


def test_a_group_of_ties_gives_k_rows_per_query():
    draw = np.random.default_rng(3)
    x, ids = np.repeat([[3.0, 4.0]], 500, axis=0), draw.permutation(500)
    plan = topk.Elimination(x[:100], ids[:100], 25.0, 7)
    q, c, score = plan.best(np.array([[1.0, 1.0], [2.0, 0.0]]), np.array([1000, 1001]), x, ids)
    assert [sorted(ids[c[q == i]]) for i in (0, 1)] == [list(range(7))] * 2
    assert score.tolist() == [7.0] * 7 + [6.0] * 7


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0])]
    rows += [(5, [3.0]), (None, [9.0, 9.0]), (6, [2.0, 2.0]), (7, [2.0, 2.0]), (6, [2.0, 2.0]), (8, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, x array<double>, score string")
    got = topk.top_k(df, spark.createDataFrame([(0,), (0,), (1,), (99,), (None,)], "id long"), 5).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 6, 6.0), (0, 2, 6, 6.0), (0, 3, 7, 6.0)]
    assert topk.top_k(df.where("false"), df.select("id"), 5).collect() == []


def test_search_query_leaves_out_what_is_not_finite(spark, folder):
    draw = np.random.default_rng(5)
    vectors = [(i, row.tolist()) for i, row in enumerate(draw.normal(size=(60, 4)))]
    for i, value in ((20, float("nan")), (40, float("inf")), (7, float("nan")), (8, float("inf")), (9, float("-inf"))):
        vectors[i][1][i % 4] = value
    vectors[10][1][0] = None
    vectors.append((61, None))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    df.write.parquet(folder("vectors") + "/embeddings.parquet")
    whole = [(i, [np.floor(64 * float(np.float32(v))) for v in x]) for i, x in vectors if x and None not in x and np.isfinite(x).all()]
    got = QUERIES["op10_topk"](spark, folder("vectors")).collect()
    assert sorted(tuple(r) for r in got) == naive_top(whole, [0], 20)


def test_queries_give_their_columns(spark):
    """Every query runs over its table and gives a row per document, page or piece at least."""
    n = {t: spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("documents", "pages")}
    found = {name: QUERIES[name](spark, DATA) for name in QUERIES if name != "op10_topk"}
    counts = {name: df.count() for name, df in found.items()}
    assert counts.pop("op5_packing") >= n["documents"] and counts.pop("op9_warc") == n["pages"]
    assert counts.pop("op11_spelling_variants") > 0  # a row per word
    assert set(counts.values()) == {n["documents"]}
    assert dict(found["op6_simhash"].dtypes) == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    assert dict(found["op8_quality_classifier"].dtypes) == {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"
    }
    search = QUERIES["op10_topk"](spark, DATA)
    assert dict(search.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_stages_as_brute_force(spark, documents):
    """Each stage on the input it gets, against plain Python."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "pseudonyms", "packing"]
    trusted = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").collect()}

    def table(df):
        return sorted((r.doc_id, r.text) for r in df.collect())

    docs, rows = documents, table(documents)
    good = stages["quality_rules"](spark, docs, DATA).cache()
    verdicts = naive_verdicts(rows, trusted)
    assert good.columns == docs.columns
    kept = sorted((d, t) for (d, t), v in zip(rows, verdicts, strict=True) if v[-2])
    assert table(good) == kept and 0 < len(kept) < len(rows)

    lines = stages["line_dedup"](spark, good, DATA).cache()
    assert lines.columns == docs.columns
    want = sorted((d, t) for d, _, _, t in naive_lines(kept))
    assert table(lines) == want and lines.where(F.col("n_chars") != F.char_length("text")).count() == 0

    one = stages["near_dedup"](spark, lines, DATA).cache()
    groups = naive_groups([naive_fingerprint(t, 4) for _, t in want], 4)
    first = {}
    for (d, t), g in zip(want, groups, strict=True):
        first.setdefault(g, (d, t))
    assert one.columns == docs.columns and table(one) == sorted(first.values())

    private = stages["pseudonyms"](spark, one, DATA).cache()
    before, after = dict(table(one)), dict(table(private))
    cuts = {d: one.sparkSession for d in before}
    assert set(cuts) == set(after)
    found = {r.doc_id: r.v for r in one.select("doc_id", pii.found_values(F.col("text")).alias("v")).collect()}
    for d, text in before.items():
        assert (after[d] == text) == (not found[d])
        assert not any(v in after[d] for v in found[d] if "@" in v)

    packed = stages["packing"](spark, private, DATA).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in after.items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(found.columns) and found.count() > 0


def test_staged_tables_leave_no_shuffle_behind(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(staging, "stored", lambda df, *rest: seen.append(rest) or stored(df, *rest))
    df = spark.range(9).selectExpr("id % 2 AS k").groupBy("k").count()
    assert sorted(map(tuple, staging.staged(df, "small").collect())) == [(0, 5), (1, 4)]
    assert seen == [("small", "snappy")]
