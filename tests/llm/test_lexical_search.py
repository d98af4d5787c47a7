"""Ranked search against scores of all pairs, with strata split and pruned, and odd rows."""
import math
import re
from collections import Counter

import pytest

from phenolens.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]


def all_pairs(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in words if c[t])
            if score > 0:
                scored.append((-score, doc is not None, doc, score))
        out += [(item, r, s[2], s[3]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


DOCS = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 3 + i % 17))) for i in range(300)] + [
    (i, "copy of one text, w1 w2") for i in range(400, 460)] + [
    (500, None), (501, ""), (502, "!!"), (None, "w1 é"), (None, "w1 É w2"), (503, "W1 w1 É"), (504, "w3 " * 20_000),
    (505, "rare"), (505, "rare")]
ITEMS = [(1, "w1 w2 w3"), (2, "Copy text"), (3, None), (4, "nothing known"), (5, "é w22 w22"), (5, "w7"), (None, "RARE w3"), (6, "")]


@pytest.mark.parametrize("small", [False, True])
def test_scores(spark, docs_of, monkeypatch, small):
    if small:  # many blocks, waves and chunks; the index holds all terms
        for name, value in {"BLOCK_DOCS": 3, "BLOCK_POSTINGS": 20, "FIRST_WAVE": 2, "WIDER": 2, "QUERIES": 2,
                            "VOCABULARY_BYTES": 0}.items():
            monkeypatch.setattr(lexical_search, name, value)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical_search.search(docs_of(DOCS), items, k=4).collect()
    assert sorted(map(tuple, got), key=str) == all_pairs(DOCS, ITEMS, 4)


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(docs_of([]), items).collect() == []
    assert lexical_search.search(docs_of(DOCS), items.limit(0)).collect() == []
    named = spark.createDataFrame([("b", "x y"), ("a", "x z")], "doc_id string, text string")
    got = lexical_search.search(named, spark.createDataFrame([("q", "x")], "item_id string, text string")).collect()
    assert [(r["rank"], r["doc_id"]) for r in got] == [(1, "a"), (2, "b")]
