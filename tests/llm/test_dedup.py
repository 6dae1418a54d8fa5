"""SimHash groups and repeated lines against brute force."""

import itertools
import random
import re

import pytest
import xxhash

from portloom.llm import linededup, linewords, simhash
from portloom.llm.components import components
from portloom.llm.queries import QUERIES

BLANK = r"[^\x20\x09-\x0D]+"


def naive_fingerprint(text, k):
    words = re.findall(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_groups(prints, bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def check_groups(found, rows, bits, k=4):
    prints = [naive_fingerprint(t, k) for _, t in rows]
    groups = naive_groups(prints, bits)
    least = {}
    for (doc, _), g in zip(rows, groups, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    want = [(d, p, least.get(g)) for (d, _), p, g in zip(rows, prints, groups, strict=True)]
    order = lambda r: [(v is not None, v) for v in r]
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found.collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("bits", [0, 3, 4, 5])
def test_groups_of_near_texts(spark, bits, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_BUCKET", 3)  # so that the small groups here count as large
    draw, rows = random.Random(bits), []
    for n in range(25):
        base = [f"w{draw.randint(0, 60)}" for _ in range(draw.choice([0, 1, 3, 30, 80]))]
        for _ in range(draw.randint(1, 7)):
            own = list(base)
            for _ in range(draw.randint(0, 3)):
                if own:
                    own[draw.randrange(len(own))] = f"v{draw.randint(0, 9)}"
            rows.append((len(rows) * 3 % 101, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_groups(simhash.near_duplicates(df, 4, bits), rows, bits)


def test_close_fingerprints_in_every_bit(spark):
    """Chains over the ring's end and differences in any segment are found."""
    draw, prints = random.Random(9), []
    for _ in range(12):
        p = draw.getrandbits(64)
        for _ in range(8):
            q = p
            for b in draw.sample(range(64), draw.randint(0, 6)):
                q ^= 1 << b
            prints.append(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p, p) for p in set(signed)], "fp long, root long")
    got = {frozenset((r.a, r.b)) for r in simhash._cross_links(fps, 4).collect()}
    want = {
        frozenset((a, b)) for a in set(signed) for b in set(signed) if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    }
    assert got == want


def test_unfolded_rings_are_not_broadcast(spark, folder):
    """Spark sizes them by the table of fingerprints, which is small here as it is at some sizes of the job."""
    draw = random.Random(3)
    prints = [p - (1 << 63) for p in (draw.getrandbits(64) for _ in range(300))]
    prints += [p ^ 1 for p in prints[:50]]
    spark.createDataFrame([(p, p) for p in prints], "fp long, root long").write.parquet(folder("prints"))
    fps = spark.read.parquet(folder("prints"))
    for links in (simhash._pivot_links(fps, 4), simhash._cross_links(fps, 4)):
        links.collect()
        ran = links._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n")
        depth = lambda line: len(re.match(r"[\s:+*()\d-]*", line)[0])
        sent = [i for i, line in enumerate(ran) if re.match(r"[\s:+-]*BroadcastExchange", line)]
        for i in sent:
            inside = itertools.takewhile(lambda line, top=depth(ran[i]): depth(line) > top, ran[i + 1 :])
            assert not any("Generate" in line for line in inside)
        assert any("SortMergeJoin" in line for line in ran)


def test_simhash_edges(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    check_groups(simhash.near_duplicates(edge, 4, 4), rows, 4)
    kept = simhash.keep_one(edge, 4, 4)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 4, 5, 6, 7]
    assert kept.where("doc_id is null").count() == 2
    assert simhash.near_duplicates(edge.where("false"), 4, 4).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (500, 3), (101, 102), (102, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in [*range(41), 500]}, **{i: 100 for i in (100, 101, 102)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def naive_lines(rows, threshold=0.8, least=5):
    sets, out = [], []
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    found = {}
    for doc, text in order:
        if text is None:
            found[doc, text] = (0, 0, None)
            continue
        kept, gone = [], 0
        for line in text.split("\n"):
            words = frozenset(re.findall(BLANK, line))
            if len(words) >= least:
                if any(len(words & s) >= threshold * len(words | s) - 1e-9 for s in sets):
                    gone += 1
                    sets.append(words)
                    continue
                sets.append(words)
            kept.append(line)
        found[doc, text] = (len(text.split("\n")), gone, "\n".join(kept))
    for row in rows:
        out.append((row[0], *found[row]))
    return out


@pytest.mark.parametrize("common", [1, 4, 64])
def test_lines_as_brute_force(spark, common):
    draw, lines = random.Random(common), []
    for _ in range(40):
        base = [f"w{draw.randint(0, 40)}" for _ in range(draw.randint(3, 20))]
        for _ in range(draw.randint(1, 6)):
            own = list(base)
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = f"x{draw.randint(0, 50)}"
            lines.append(" ".join(own))
    draw.shuffle(lines)
    rows = [(i * 7 % 31, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(len(lines) // 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.dedup_lines(df, common=common).select("doc_id", "n_lines", "n_removed", "text")
    assert sorted(tuple(r) for r in got.collect()) == sorted(naive_lines(rows))


def test_line_edges(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = linededup.dedup_lines(edge)
    assert got.columns == [*edge.columns, "n_lines", "n_removed"]
    order = lambda r: [(v is not None, v) for v in r]
    found = [tuple(r) for r in got.select("doc_id", "n_lines", "n_removed", "text").collect()]
    by_id = lambda rows: sorted((r for r in rows if r[0] != 5), key=order)
    assert by_id(found) == by_id(naive_lines(rows))
    # rows of one id: equal rows get equal results and keep the first lines
    assert sorted(r[2] for r in found if r[0] == 5) == [0, 0, 0]
    assert linededup.dedup_lines(edge.where("false")).collect() == []


@pytest.mark.parametrize("common", [1, 64])
def test_short_lines_as_brute_force(spark, common):
    """Lines of one to six words, blank ones, and four words within five."""
    draw, lines = random.Random(common), ["menu", "share", "a b c d", "a b c d e", "", " ", "menu menu", "d c b a"]
    for _ in range(120):
        own = [f"w{draw.randint(0, 9)}" for _ in range(draw.randint(0, 6))]
        lines.append(" ".join(own))
    draw.shuffle(lines)
    rows = [(i * 7 % 37, "\n".join(lines[i * 4 : i * 4 + 4])) for i in range(len(lines) // 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.dedup_lines(df, min_words=1, common=common).select("doc_id", "n_lines", "n_removed", "text")
    assert sorted(tuple(r) for r in got.collect()) == sorted(naive_lines(rows, least=1))


def test_line_query_removes_short_lines(spark, folder):
    rows = [(1, "menu\nshare this\n\na b c d"), (2, "menu\n\nthis share\na b c d e"), (3, "menu")]
    path = folder("lines")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    got = QUERIES["op3_line_dedup"](spark, path).collect()
    assert sorted(tuple(r) for r in got) == [(1, 4, 0, rows[0][1]), (2, 4, 3, ""), (3, 1, 1, "")]


def test_equal_lines_at_one_place_of_texts_with_one_id(spark):
    """Only one of the texts without an id, or with the same one, holds the first line."""
    line = "one two three four five six"
    rows = [(d, f"{first}\n{end} {end}x") for d, first in ((None, line), (8, f"seven {line} eight nine")) for end in "abc"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.dedup_lines(df).collect()
    for doc in (None, 8):
        assert sorted(r.n_removed for r in got if r.doc_id == doc) == [0, 1, 1]
        assert sum(line in r.text for r in got if r.doc_id == doc) == 1


def test_narrow_groups_travel_packed(spark):
    """A row for each bucket of words and task, not for each word; whatever is packed comes back."""
    lines = [" ".join(f"w{(i * 7 + k) % 90}" for k in range(12)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc long, text string").selectExpr("doc", "xxhash64(text) AS tie", "text")
    sets = linededup._line_sets(docs.coalesce(1), linededup.word_levels(docs), 0.8, 5, 512)
    words = sum(len(r["words"]) for r in sets.collect())
    size = linededup._ROW.itemsize
    for part in range(linededup.PARTS):
        assert linededup._packed(sets, 3, part, None).count() <= 3
    blobs = [r["rows"] for p in range(linededup.PARTS) for r in linededup._packed(sets, 3, p, None).collect()]
    assert words > 200 and sum(map(len, blobs)) == words * size


def test_verified_lines_are_shuffled_whole(spark):
    docs = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "a b c x y z u v w j")]
    docs = spark.createDataFrame(docs, "doc long, text string")
    key = {r[0]: xxhash.xxh64_intdigest(r[1]) for r in docs.collect()}
    key = {d: k - (1 << 64) if k >> 63 else k for d, k in key.items()}
    pairs = spark.createDataFrame([(key[2], key[1]), (key[1], key[3])], "a long, b long")
    found = linededup._verified(pairs, docs, 0.8)
    assert "words_a" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r["key"] for r in found.collect()] == [key[2]]


def test_second_round_pairs_open_sets_only(spark):
    """Of a group of like lines, only the pairs whose later line is still open are made again."""
    lines = [" ".join([*(f"w{k}" for k in range(19)), f"x{i}"]) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc long, text string").selectExpr("doc", "xxhash64(text) AS tie", "text")
    sets = linededup._line_sets(docs, linededup.word_levels(docs), 0.8, 5, 512)
    open_ = sets.where("doc in (7, 20)").select("key")
    late_of = linededup._key_slots(open_)
    asked = linededup._narrow_words(sets, late_of)
    found = [linededup._narrow_pairs(sets, 0.8, p, 1, asked, late_of) for p in range(linededup.PARTS)]
    keys = {r[0] for r in open_.collect()}
    assert {r["a"] for f in found for r in f.collect()} == keys
    partners = {(r["a"], r["doc"]) for f in found for r in f.collect()}
    assert len(partners) == 7 + 20


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    """Words at any place, blocks beyond the kept powers included, have the hash that they have alone."""
    monkeypatch.setattr(linewords, "_powers", {})
    monkeypatch.setattr(linewords, "BLOCK_BYTES", 16)
    words = ["a", "ab", "ba", "long-word", "\u00e9", "x1!y", "ab"] * 9
    text = "\n \n".join(" ".join(words[i : i + 5]) for i in range(0, len(words), 5))
    line, h = linewords.line_words(text.encode())
    alone = [linewords.line_words(w.encode())[1][0] for w in words]
    assert h.tolist() == alone and len(set(alone)) == 6
    assert line.tolist() == [2 * (i // 5) for i in range(len(words))]
    assert all(len(kept) <= 17 for kept in linewords._powers.values())
    for blank in (b"", b"\n", b" \n "):
        assert [x.tolist() for x in linewords.line_words(blank)] == [[], []]
