import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from phenolens.llm import common, near_dedup as N, queries

from conftest import SF


def brute(rows):
    """(id, n, component) by all pairs of full sets; rows of one id are one document."""
    sets = [(i, set(N.shingles(t).tolist())) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets)


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def edited(rng, words, changes):
    words = list(words)
    for p in rng.integers(0, len(words), changes):
        words[p] = f"new{rng.integers(0, 10**6)}"
    return " ".join(words)


def test_large_group_of_near_copies_in_blocks(spark, docs_of):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(300)]
    rows = [(int(i), edited(rng, base, int(rng.integers(0, 7)))) for i in rng.permutation(120)]
    chain = [" ".join(f"c{i}" for i in range(s, s + 200)) for s in range(0, 40, 8)]  # neighbours alone are similar
    rows += [(1000 - k, t) for k, t in enumerate(chain)]
    want = brute(rows)
    assert got(N.near_dedup(docs_of(rows))) == want
    representatives = N._sketches(docs_of(rows), "doc_id", "text", 5).select("id", "n_shingles", "bands")
    found = N.near_links(docs_of(rows), representatives, "doc_id", "text", 5, 85, block_bytes=40_000)
    component = {r["node"]: r["component"] for r in common.connected_components(found).collect()}
    assert sorted((i, n, component.get(i, i)) for i, n, _ in want) == want


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (9, "ONE\ttwo"), (5, "one two three"), (6, "x " * 50000),
            (7, "x " * 50), (7, "x " * 50), (12, "É a b c d e"), (11, "é a b c d e")]
    want = brute(rows)
    assert got(N.near_dedup(docs_of(rows))) == want
    assert dict((i, c) for i, _, c in want)[9] == 4
    nulls = N.near_dedup(docs_of([(None, "a b c d e f"), (3, "a b c d e f"), (None, "")])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in nulls) == [
        ("3", None, False), ("None", None, True), ("None", None, True)]
    assert N.near_dedup(docs_of([])).collect() == []
    kept = N.keep_one(docs_of(rows))
    assert sorted({r["doc_id"] for r in kept.collect()}) == [1, 2, 3, 4, 5, 6, 11, 12]
    assert kept.columns == docs_of(rows).columns


def test_one_id_with_several_texts_joins_their_groups(spark, docs_of):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "p q r s t u v"), (3, "p q r s t u v")]
    assert {c for _, _, c in got(N.near_dedup(docs_of(rows)))} == {1}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (500, 300, 200))
    x, y = np.union1d(a, b), np.union1d(a, c)
    assert (N.merge(N.registers(x), N.registers(y)) == N.registers(np.union1d(x, y))).all()
    assert abs(N.joint_similarity(N.registers(x), N.registers(y), len(x), len(y)) - 0.5) < 0.12
    assert not N.ruled_out(N.registers(x), N.registers(x)[None], len(x), np.array([len(x)]))[0]
    assert N.ruled_out(N.registers(x), N.registers(c)[None], len(x), np.array([len(x)]))[0]


def test_links_at_the_threshold_are_not_ruled_out():
    rng = np.random.default_rng(2)
    for _ in range(200):
        both, each = rng.integers(0, 1 << 63, 170, dtype=np.uint64), rng.integers(0, 1 << 63, 30, dtype=np.uint64)
        a, b = np.union1d(both, each[:15]), np.union1d(both, each[15:])
        assert N.linked(a, b) and not N.ruled_out(N.registers(a), N.registers(b)[None], len(a), np.array([len(b)]))[0]
        assert set(N.band_keys(N.registers(a))) & set(N.band_keys(N.registers(b)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_connected_components(spark, edges):
    parent = {i: i for e in edges for i in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {i: root(i) for e in edges if e[0] != e[1] for i in e}
    df = spark.createDataFrame(edges, "a long, b long")
    rows = common.connected_components(df).collect()
    assert len(rows) == len(want) and {r["node"]: r["component"] for r in rows} == want
