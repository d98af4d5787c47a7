import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from phenolens.llm import queries
from phenolens.llm import suffix_dedup as S

from conftest import SF


def brute(texts):
    """texts: (id, text) -> (id, bytes, removed, runs, hash of the rest), by a table of all strings."""
    data = [(i, (t or "").encode()) for i, t in texts]
    least = {}
    for i, b in data:
        for p in range(len(b) - S.LENGTH + 1):
            w = b[p:p + S.LENGTH]
            if w not in least or i < least[w]:
                least[w] = i
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - S.LENGTH + 1):
            if least[b[p:p + S.LENGTH]] < i:
                gone[p:p + S.LENGTH] = b"\1" * S.LENGTH
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                  for r in df.collect())


def test_query_against_all_strings(spark):
    rows = queries.QUERIES["op6_suffix_array_dedup"](spark, SF["0.001"]).collect()
    texts = [(r["doc_id"], r["text"]) for r in queries.documents(spark, SF["0.001"]).collect()]
    want = brute(texts)
    assert sorted(tuple(r) for r in rows) == want
    assert sum(w[2] for w in want) > 10000


def test_many_blocks_and_shifted_passages(spark, docs_of):
    rng = np.random.default_rng(5)
    passages = ["".join(rng.choice(list("abcdef \n"), 30 + 7 * k)) for k in range(12)]
    texts = [(int(i), "".join(passages[j] + "xyz"[:j % 4] for j in rng.integers(0, 12, 6))) for i in rng.permutation(80)]
    texts += [(100 + i, "the " * (20 + i)) for i in range(9)] + [(200, "é" * 60), (201, "z" + "é" * 60)]
    assert got(S.remove_repeats(docs_of(texts), block_bytes=2000)) == brute(texts)


def test_text_longer_than_a_chunk(spark, docs_of, monkeypatch):
    rng = np.random.default_rng(6)
    long = "".join(rng.choice(list("abcdefgh"), 5000))
    texts = [(1, long), (2, "q" + long[950:1200] + "q" + long[4000:]), (3, long[:49]), (4, long[:50])]
    monkeypatch.setattr(S, "CHUNK", 1000)
    assert got(S.remove_repeats(docs_of(texts))) == brute(texts)


def test_odd_rows(spark, docs_of):
    text = "0123456789" * 6
    df = docs_of([(1, None), (2, ""), (None, text), (3, text), (3, text), (4, "short")])
    rows = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["n_removed"], r["n_bytes"])
                  for r in S.remove_repeats(df).collect())
    assert rows == [(-1, 0, 60), (1, 0, 0), (2, 0, 0), (3, 60, 60), (3, 60, 60), (4, 0, 5)]
    again = S.remove_repeats(docs_of([(3, text), (3, text)])).collect()
    assert [r["n_removed"] for r in again] == [0, 0]  # one document
    assert S.remove_repeats(docs_of([])).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.text(alphabet="ab", min_size=50, max_size=80)), min_size=2, max_size=12))
def test_cover_ranks_order_like_strings(rows):
    """One bucket, anchors at the start: repeats at equal places are found, and no others."""
    strings = [t.encode() for _, t in rows]
    ids = np.array([i for i, _ in rows])
    hit = [bytearray(len(s)) for s in strings]
    for c, a, b in S.repeated(np.zeros(len(rows), np.int64), strings, np.zeros(len(rows), np.int64), ids):
        hit[c][a:b] = b"\1" * (b - a)
    for c, s in enumerate(strings):
        want = bytearray(len(s))
        for p in range(len(s) - 49):
            if any(o[p:p + 50] == s[p:p + 50] and ids[k] < ids[c] for k, o in enumerate(strings)):
                want[p:p + 50] = b"\1" * 50
        assert hit[c] == want


def test_a_phrase_between_different_neighbours_is_no_large_bucket(spark, docs_of):
    rng = np.random.default_rng(7)
    around = ["".join(rng.choice(list("abcdefghij"), 45)) for _ in range(300)]
    phrase = "THE SAME PHRASE OF SOME FORTY BYTES HERE"
    texts = [(i, around[i] + phrase + around[(7 * i) % 300] + phrase + around[-i]) for i in range(300)]
    texts += [(300 + i, "q" * (i % 3) + texts[i][1][10:120]) for i in range(60)]
    df = docs_of(texts)
    assert got(S.remove_repeats(df, block_bytes=4000, hot_contexts=50)) == brute(texts)
    assert got(S.remove_repeats(df, block_bytes=4000)) == brute(texts)
    blocks = df.selectExpr("doc_id as id", "text", "doc_id % 12 as block")

    def largest(hot_contexts):
        sent = S._sent(blocks, hot_contexts).filter("string is not null")
        return sent.groupBy("bucket").count().agg({"count": "max"}).first()[0]

    assert largest(10 ** 9) > 250 and largest(50) <= 50
