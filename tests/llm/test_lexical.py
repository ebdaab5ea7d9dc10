"""Ranked lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from curbair.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def every_score(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    count, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 100 - 25 + (25 * n * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, size=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 80)))) for i in range(size)]
    docs += [(1000 + i, docs[3][1]) for i in range(120)]  # a large group of copies: ties
    docs += [(None, docs[5][1]), (None, docs[5][1]), (7, docs[7][1]), (2000, None), (2001, ""), (2002, " .,;\x00\x7f"),
             (2003, "W1 w1-W2_w3 été ÉTÉ 日本 w119"), (2004, "w0 " * 40_000 + "w118"), (2005, "other things")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(20)]
    items += [(50, None), (51, "..."), (52, "absent terms"), (53, "w1 w1 w1 W1"), (53, "w2"), (None, "été 日本"), (54, "É")]
    return docs, items


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("seed, settings", [(1, {}), (2, {"trie_terms": 300, "leaf": 2}), (3, {"item_bytes": 700, "leaf": 1})])
def test_search_equals_every_score(spark, seed, settings):
    docs, items = corpus(seed)
    table = spark.createDataFrame([(t, 5, 1, d) for d, t in docs], "text string, n long, item int, doc_id long").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(table, asked, 5, **settings)) == every_score(docs, items, 5)


def test_empty_tables(spark):
    docs, items = corpus(4, 10)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(table.limit(0), asked)) == [] == found(lexical.search(table, asked.limit(0)))
    assert found(lexical.search(table.filter("text is null"), asked)) == []


def test_terms_follow_the_pattern():
    every = "".join(map(chr, range(0x250))) + "日本 🙂x"
    assert [t.decode() for t in lexical.terms_of(every)] == terms(every)


def test_walks_leave_documents_out():
    """Bounds hold and most documents of a clustered corpus are never scored."""
    rng = np.random.default_rng(5)
    topic = np.sort(rng.integers(0, 40, 4000))
    paths = [np.unique(np.concatenate([[0], 10 + t * 20 + rng.integers(0, 20, 8), 900 + rng.integers(0, 50, 2)])) for t in topic]
    paths.sort(key=lambda p: p.tolist())
    sizes, flat = np.array(list(map(len, paths))), np.concatenate(paths)
    tf, m = rng.integers(1, 5, len(flat)), rng.integers(75, 200, 4000)
    trie = lexical.DocumentTrie(sizes, flat, tf, m, 1000)
    scored = 0
    for t in range(40):
        asked, weight = np.array([0, 10 + t * 20, 11 + t * 20, 15 + t * 20]), np.array([10, 500, 700, 900])
        best: list = []
        scored += trie.walk(asked, weight, 1, 10, best, list(range(4000)))
        full = trie.scores(0, 4000, asked, weight)
        assert sorted(((s, o) for s, o, _ in best), reverse=True) == sorted(zip(full.tolist(), range(0, -4000, -1)), reverse=True)[:10]
        bounds = trie.bounds(0, len(trie.low), asked, weight)
        assert all(bounds[i] >= full[trie.low[i] : trie.high[i]].max() for i in range(len(trie.low)))
    assert scored < 0.1 * 40 * 4000
