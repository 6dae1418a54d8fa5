"""Quality rules, pseudonyms and the classifier against plain Python."""

import collections
import datetime
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from portloom.llm import classifier, pii, quality

BLANK = r"[^\x20\x09-\x0D]+"
KEY = "test-key"


def naive_base(text):
    text = text or ""
    words = re.findall(BLANK, text)
    lines = [line for line in text.split("\n") if re.search(BLANK, line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def spark_hash(value: bytes, seed=42):
    h = xxhash.xxh64_intdigest(value, seed)
    return h - (1 << 64) if h >> 63 else h


def naive_verdicts(rows, trusted, threshold=quality.THRESHOLD, buckets=quality.BUCKETS):
    def grams(text):
        words = [spark_hash(w.encode()) for w in re.findall(BLANK, text or "")]
        for a in words:
            yield a % buckets
        for a, b in itertools.pairwise(words):
            first = spark_hash(a.to_bytes(8, "little", signed=True)) & (1 << 64) - 1
            yield spark_hash(b.to_bytes(8, "little", signed=True), first) % buckets

    raw, good = collections.Counter(), collections.Counter()
    for doc, text in rows:
        raw.update(grams(text))
        if doc in trusted:
            good.update(grams(text))
    n_raw, n_good = sum(raw.values()) + buckets, sum(good.values()) + buckets
    out = []
    for doc, text in rows:
        own = list(grams(text))
        score = 0.0
        if good:
            score = sum(math.log((good[g] + 1) / n_good) - math.log((raw[g] + 1) / n_raw) for g in own)
        n, _, _, _, repeated = naive_base(text)
        score /= (len(own) or -1) + quality.ADDED_GRAMS
        failed = n < 10 or 100 * repeated > 20 * n
        out.append((doc, *naive_base(text), failed, not failed and score >= threshold, round(score, 9)))
    return out


def judged_rows(df, trusted):
    found = quality.judged(df, trusted).select("doc_id", *quality.BASE_COLUMNS, "base_failed", "kept", "score")
    return [(*r[:-1], round(r[-1], 9)) for r in found.collect()]


def order(r):
    return [(v is not None, v) for v in r]


def test_verdicts_as_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    trusted = {d for d, _ in rows if d % 3 == 0}
    ids = spark.createDataFrame([(d,) for d in [*trusted, None, 10**9]], "doc_id long")
    assert sorted(judged_rows(documents, ids)) == sorted(naive_verdicts(rows, trusted))


@pytest.mark.parametrize("trusted", [set(), {4, 7}])
def test_verdict_edges(spark, edge, trusted):
    ids = spark.createDataFrame([(d,) for d in trusted], "doc_id long")
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert sorted(judged_rows(edge, ids), key=order) == sorted(naive_verdicts(rows, trusted), key=order)
    kept = quality.keep_good(edge, ids)
    assert kept.columns == edge.columns and {r.score for r in kept.collect()} <= {"x"}
    assert quality.keep_good(edge.where("false"), ids).collect() == []


def test_filter_on_the_verdict_has_no_copies_of_it(spark, documents):
    ids = spark.createDataFrame([(3,)], "doc_id long")
    plan = quality.keep_good(documents, ids)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") <= 6 and "Python" not in plan and "Arrow" not in plan


def pseudonyms(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string").select(pii.pseudonym(F.col("v"), KEY).alias("p"), "v")
    return {r.v: r.p for r in df.collect()}


def luhn(number):
    d = [int(c) for c in number if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def shape(value):
    return re.sub(r"\d", "9", value)


def test_cards_keep_format_and_check_digit(spark):
    draw, cards = random.Random(3), set()
    while len(cards) < 200:
        body = "".join(draw.choice("0123456789") for _ in range(draw.choice([12, 14, 15, 18])))
        card = next(body + c for c in "0123456789" if luhn(body + c))
        if len(card) == 16 and draw.random() < 0.5:
            mark = draw.choice(" -")
            card = mark.join(card[i : i + 4] for i in range(0, 16, 4))
        cards.add(card)
    found = pseudonyms(spark, cards)
    assert all(luhn(p) and shape(p) == shape(c) and p[0] == c[0] for c, p in found.items())
    digits = {re.sub(r"\D", "", c): re.sub(r"\D", "", p) for c, p in found.items()}
    assert len(set(digits.values())) == len(digits) and sum(a == b for a, b in digits.items()) <= 2
    assert pseudonyms(spark, ["4111111111111112"]) == {"4111111111111112": "4111111111111112"}


def test_dates_are_permuted(spark):
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(n) for n in range(0, 73049, 97)]
    for form in ("%Y-%m-%d", "%d.%m.%Y"):
        found = pseudonyms(spark, [d.strftime(form) if form[1] != "Y" else d.isoformat() for d in days])
        assert len(set(found.values())) == len(days)
        assert all(1900 <= datetime.datetime.strptime(p, form).year <= 2099 for p in found.values())
    assert pseudonyms(spark, ["2023-02-30"]) == {"2023-02-30": "2023-02-30"}
    slashed = pseudonyms(spark, ["12/25/1990", "25/12/1990"])
    assert all(shape(p) == "99/99/9999" for p in slashed.values())


def test_numbers_are_permuted_in_their_domain(spark):
    phones = [f"+1 ({a}) 555-{b:04d}" for a in (201, 779) for b in range(0, 10_000, 211)]
    found = pseudonyms(spark, phones)
    assert len(set(found.values())) == len(phones) and all(shape(p) == "+9 (999) 999-9999" for p in found.values())
    assert all(p.startswith("+1 ") for p in found.values())
    hosts = [f"{a}.{b}.7.{c}" for a in (1, 200) for b in (0, 99) for c in range(0, 256, 15)]
    found = pseudonyms(spark, hosts)
    assert len(set(found.values())) == len(hosts) and all(re.fullmatch(pii.ADDRESS, p) for p in found.values())
    social = [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 665, 667, 899) for b in (1, 99) for c in (1, 5000, 9999)]
    found = pseudonyms(spark, social)
    assert len(set(found.values())) == len(social) and all(re.fullmatch(pii.SOCIAL, p) for p in found.values())


def test_texts_are_rebuilt_around_the_values(spark):
    texts = [
        "Write to ann.b@mail.example.com, or call +1 (779) 555-0207 4111111111111111 from 10.0.0.254.",
        "4111 1111 1111 1111 and 4111111111111111",
        "born 1984-02-29 or 29.02.1984; 078-05-1120",
        "version 1.2, 3.14159265358979, order 12345678901234567890, 300.1.1.1, 4111111111111112, $&%1\\1",
        "no values at all",
        None,
        "",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, KEY, count="n").collect()}
    for value in ("ann.b@mail.example.com", "555-0207", "4111111111111111", "10.0.0.254"):
        assert value not in got[0].text
    assert re.fullmatch(
        r"Write to [a-z]{3}\.[a-z]@pseudonym\.invalid, or call \+1 \(\d{3}\) \d{3}-\d{4} 4\d{15} from [\d.]+\.", got[0].text
    )
    assert got[0].n == 4
    first, second = got[1].text.split(" and ")
    assert first.replace(" ", "") == second == re.search(r"4\d{15}", got[0].text)[0]
    iso, dotted = re.fullmatch(r"born (\S+) or (\S+); \d{3}-\d\d-\d{4}", got[2].text).groups()
    assert ".".join(reversed(iso.split("-"))) == dotted
    assert [got[i].text for i in (3, 4, 5, 6)] == texts[3:]


def test_mail_that_begins_with_a_plus(spark):
    texts = ["to +news@firm.example now", "+491701234567@sms.example", "call +491701234567"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(df, KEY).collect()}
    assert re.fullmatch(rf"to \+[a-z]{{4}}@{re.escape(pii.HOST)} now", got[0]) and "news" not in got[0]
    assert re.fullmatch(rf"\+[0-9]{{12}}@{re.escape(pii.HOST)}", got[1]) and "491701234567" not in got[1]
    assert re.fullmatch(r"call \+[0-9]{12}", got[2]) and got[2] != texts[2]


def test_mail_hosts_of_many_labels(spark):
    many = 100_000
    texts = [f"to x@{'a.' * many}com now", f"to x@{'a.' * many}", f"x@{'mail.' * many}1", f"{'y.' * many}z@b.example", "x@a.1.b-c.co.2.de.3 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(df, KEY).collect()}
    assert re.fullmatch(rf"to [a-z]@{re.escape(pii.HOST)} now", got[0])
    assert got[1] == texts[1]
    assert re.fullmatch(rf"[a-z]@{re.escape(pii.HOST)}\.1", got[2])
    assert re.fullmatch(rf"([a-z]\.){{{many}}}[a-z]@{re.escape(pii.HOST)}", got[3])
    assert re.fullmatch(rf"[a-z]@{re.escape(pii.HOST)}\.3 x", got[4])


def test_columns_named_like_the_operator_s_own_stay(spark):
    names = ["_found", "_new", "found", "new", "row", "_row", "v", "n"]
    df = spark.createDataFrame([("call +1 779 555 0207", *names)], ["text", *names])
    got = pii.pseudonymise(df, KEY, count="n_found")
    assert got.columns == [*df.columns, "n_found"]
    row = got.first()
    assert [row[c] for c in names] == names and row.n_found == 1 and row.text != "call +1 779 555 0207"


def test_pseudonym_edges(edge):
    got = pii.pseudonymise(edge, KEY)
    assert got.columns == edge.columns
    same = {(r.doc_id, r.text) for r in edge.collect()} == {(r.doc_id, r.text) for r in got.collect()}
    assert same and pii.pseudonymise(edge.where("false"), KEY).collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_network_learns_and_is_calibrated():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, classifier.FEATURES)).astype(np.float32)
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1])))
    y = (draw.random(3000) < chance).astype(float)
    apart = np.arange(3000) % 5 == 0
    network = classifier.fit_network(x[:2500], y[:2500], apart[:2500])
    found = network.probabilities(x[2500:])
    assert ((found > 0.5) == (chance[2500:] > 0.5)).mean() > 0.8
    assert abs(found.mean() - y[2500:].mean()) < 0.05
    assert classifier._loss(network.logits(x[apart][:500]) / network.temperature, y[apart][:500]) < 0.6


def test_context_sums_as_a_plain_count(spark):
    rows = [(1, "a b, a\nc a"), (2, None), (3, "b b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sums = classifier.context_sums(df)
    places, signs = classifier._index_vectors()
    want = np.zeros_like(sums)
    for _, text in rows:
        for line in (text or "").split("\n"):
            slots = [int(classifier._slots(w.encode())[1][0]) for w in re.findall(r"\w+|[^\w\s]+", line)]
            for i, s in enumerate(slots):
                want[s, -1] += 1
                for j in range(len(slots)):
                    if 0 < abs(i - j) <= classifier.REACH:
                        np.add.at(want[s], places[slots[j]], signs[slots[j]])
    assert want[:, -1].sum() == 8
    # contexts reach over line ends within a document
    assert np.array_equal(want[:, -1], sums[:, -1])
    assert classifier.context_sums(df.repartition(7)).tolist() == sums.tolist()


def test_word_vectors_keep_their_sizes():
    """Smaller ones are no way to save CPU time."""
    assert (1 << classifier.SLOT_BITS, classifier.WIDTH, classifier.NONZERO) >= (1 << 15, 64, 4)
    assert classifier.WIDTH >= 64 and classifier.NONZERO >= 4


def test_labelled_rows_as_a_plain_choice(spark, monkeypatch):
    """The rows with the smallest hashes of their ids, also where an id has many rows."""
    draw, seen = np.random.default_rng(8), []
    monkeypatch.setattr(classifier, "fit_network", lambda x, y, apart: seen.append((x, y, apart)))
    x = draw.normal(size=(90, classifier.FEATURES)).astype("<f4")
    rows = [(i // 3 if i % 10 else None, x[i].tobytes()) for i in range(90)]
    known = [(i, i % 2) for i in range(2, 40)] + [(5, 1), (None, 1), (3, None)]
    features = spark.createDataFrame(rows, "doc_id long, features binary")
    classifier.fit(features, spark.createDataFrame(known, "doc_id long, quality int"), max_rows=25)
    label = {i: q for i, q in known if i is not None and q is not None}
    mix = {i: spark_hash(i.to_bytes(8, "little")) for i in label}
    want = sorted((mix[i], f, label[i]) for i, f in rows if i in label)[:25]
    assert seen[0][0].tobytes() == b"".join(f for _, f, _ in want)
    assert seen[0][1].tolist() == [q for *_, q in want]
    assert seen[0][2].tolist() == [m % 5 == 0 for m, *_ in want]


def test_classifier_held_out(spark, documents):
    texts = [f"the good text number {i} is a plain one" if i % 2 else f"BAD!! {i} TEXT!! *** ### NUMBER!!" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = classifier.in_fold(F.col("doc_id"), 4, 2)
    known = df.where(~held).select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    got = {r.doc_id: r.score for r in classifier.scored(df, known).collect()}
    apart = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert apart and all((got[i] >= 0.7) == bool(i % 2) for i in apart)


def test_classifier_edges(spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classifier.scored(edge, none).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1), (7, 0), (None, 1), (5, None)], "doc_id long, quality int")
    found = classifier.scored(edge, one).collect()
    assert len(found) == edge.count() and all(0 <= r.score <= 1 for r in found)
    assert classifier.scored(edge.where("false"), one).collect() == []
