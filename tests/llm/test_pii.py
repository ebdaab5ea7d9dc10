"""Personal data: patterns against plain regular expressions, the field against sums over
all segmentations, and what it adds on spellings it was not trained on."""

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest

from curbair.llm import pii, queries

DATA = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    """The fixed patterns as they are written down."""
    def luhn(digits):
        total = 0
        for i, d in enumerate(map(int, reversed(digits))):
            d = d * 2 if i % 2 else d
            total += d - 9 if d > 9 else d
        return total % 10 == 0

    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def card(rng):
    digits = "".join(rng.choice("0123456789") for _ in range(15))
    return next(digits + d for d in "0123456789" if pii.luhn(digits + d))


def texts(seed, size):
    rng = random.Random(seed)
    words = ["the", "été", "日本", "of", "und", "thing", "a-b", "x_y", "end.", "3"]
    entities = [
        lambda: f"joe{rng.randint(1, 99)}.{rng.choice('abc')}@mail{rng.randint(0, 9)}.example.com",
        lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), lambda: card(rng)]
    for _ in range(size):
        parts = [rng.choice(words) for _ in range(rng.randint(3, 25))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(entities)())
        yield " ".join(parts)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    tried = ["".join(rng.choice("0123456789..@@+- ()ab%_é\n1.2") for _ in range(rng.randint(0, 60))) for _ in range(6000)]
    tried += ["a@b.c@d.e", "a@b.com_x@y.org", "@@a@b..c", "1.2.3.4.5.6.7.8", "001.02.3.4", "9" * 6000 + ".1.2.3", "+" * 50 + "1234567890",
              "4111 1111-1111 1111", "+1 4111111111111111", "+12345678 1.2.3.4", "x" * 5000 + "@a.b", *texts(2, 300)]
    for text in tried:
        if len(text) < 6000:
            assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("9" * 6000 + ".1.2.3") == []


def every_segmentation(lattice):
    spans = range(len(lattice.spans))
    for n in range(len(lattice.spans) + 1):
        for rows in itertools.combinations(spans, n):
            if any(lattice.spans[a][0] < lattice.spans[b][1] and lattice.spans[b][0] < lattice.spans[a][1]
                   for a, b in itertools.combinations(rows, 2)):
                continue
            for kinds in itertools.product(range(4), repeat=n):
                yield list(zip(rows, kinds))


@pytest.mark.parametrize("window", ["(724) 555-7058", "a1234567 89", "joe.b @ ex.org", "1.2.3.4444444"])
def test_field_equals_the_sum_over_segmentations(window):
    rng = np.random.default_rng(7)
    lattice = pii.Lattice(window, 0, len(window), [])
    weights = rng.normal(0, 1, (4, len(pii._NAMES)))
    scores = lattice.scores(weights)
    ways = [(sum(scores[r, k] for r, k in way), way) for way in every_segmentation(lattice)]
    total = np.logaddexp.reduce([s for s, _ in ways])
    found, marginals = lattice.marginals(weights)
    assert np.isclose(found, total)
    expected = np.zeros_like(marginals)
    for score, way in ways:
        for row, kind in way:
            expected[row, kind] += np.exp(score - total)
    assert np.allclose(marginals, expected)
    assert sorted(lattice.best(weights)) == sorted(max(ways, key=lambda w: w[0])[1])


def stretches_of(rows):
    for text in rows:
        for low, high in pii.stretches(text):
            at = max(0, low - pii.CONTEXT)
            yield text[at : high + pii.CONTEXT], low - at, high - at


@pytest.fixture(scope="module")
def weights():
    return pii.train(list(stretches_of(texts(3, 250))))


def test_other_spellings_and_numbers_that_are_none(weights):
    rng = np.random.default_rng(99)
    hit = missed = false = 0
    for window, low, high in stretches_of(texts(4, 200)):
        for kind, start, end in pii.base_spans(window):
            if low <= start and end <= high:
                said = pii._respelled(kind, window[start:end], rng)
                text = f"{window[:low]}{said}{window[high:]}"
                found = [s for a, b in pii.stretches(text) for s, _ in pii.added_spans(text, a, b, pii.base_spans(text), weights)]
                base = pii.base_spans(text)
                hit, missed = hit + ((kind, low, low + len(said)) in found + base), missed + ((kind, low, low + len(said)) not in found + base)
        text = f"{window[:low]}{pii._no_entity(rng)}{window[high:]}"
        base = pii.base_spans(text)
        false += sum(len(pii.added_spans(text, a, b, base, weights)) for a, b in pii.stretches(text))
    assert hit >= 0.9 * (hit + missed) and false <= 3, (hit, missed, false)


def test_a_base_span_stays_and_nothing_crosses_it(weights):
    text = "call +1 (724) 555-7058 or (724) 555-7058, at 10.0.0.1"
    base = pii.base_spans(text)
    added = [s for a, b in pii.stretches(text) for s, _ in pii.added_spans(text, a, b, base, weights)]
    assert added == [("phone", 26, 40)]


def test_long_stretches_are_cut():
    text = " ".join(str(i % 90) for i in range(40_000)) + " " + "7" * 300_000
    parts = pii.stretches(text)
    assert parts[0][0] == 0 and parts[-1][1] == len(text) and all(a[1] == b[0] for a, b in itertools.pairwise(parts))
    assert max(b - a for a, b in parts[:-1]) <= pii.STRETCH_CHARS + 2


def test_digests(spark):
    rows = list(enumerate(texts(5, 150))) + [
        (None, "joe@example.com"), (3, "joe@example.com"), (3, "joe@example.com"), (900, None), (901, ""), (902, "🙂 é +1 (724) 555-7058 🙂"),
        (903, "phone (724) 555-7058"), (904, "1 2 3 4 " * 20_000), (905, "w " * 50_000 + "10.0.0.1")]
    docs = spark.createDataFrame([(t, 1, "x", d) for d, t in rows], "text string, base int, added string, doc_id long").repartition(4)
    out = [r.asDict() for r in pii.personal_data_digests(docs).collect()]
    key = lambda x: str(x)
    want = []
    for d, t in rows:
        base = plain(t)
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        want.append((d, *(sum(k == kind for k, *_ in base) for kind in PATTERNS), hashlib.sha256(said.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in out), key=key) == sorted(want, key=key)
    for r in out:
        spans = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        order = [(list(PATTERNS).index(k), int(s)) for k, s, _ in spans]
        assert order == sorted(order)
    assert {r["spans"] for r in out if r["doc_id"] == 903} == {"phone:6:20"}
    assert {r["spans"] for r in out if r["doc_id"] in (900, 901, 904)} == {""}


def test_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "no numbers"), (2, "(724) 555-7058")], "doc_id long, text string")
    assert sorted((r.doc_id, r.spans) for r in pii.personal_data_digests(docs).collect()) == [(1, ""), (2, "")]
    assert pii.personal_data_digests(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables absent")
def test_query_keeps_base_spans_and_leaves_clean_documents_alone(spark):
    texts_of = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in queries.QUERIES["op11_personal_data"](spark, DATA).collect():
        base = [f"{k}:{s}:{e}" for k, s, e in plain(texts_of[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) if base else r.spans == ""
