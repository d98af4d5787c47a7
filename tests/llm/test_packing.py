import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from phenolens.llm import packing, queries

from conftest import SF


def encoder():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda x: t.encode(x, add_special_tokens=False).ids


def check(rows, texts, capacity=2048):
    """Every id in one piece, with the right checksum; sequences without gaps. Returns the padding."""
    encode, by_doc, by_sequence = encoder(), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = np.array(encode(texts[doc] or "") + [1], dtype="<u4"), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        padding += capacity - at
    return padding


def test_query_against_a_plain_encoder(spark):
    rows = queries.QUERIES["op1_packing"](spark, SF["0.01"]).collect()
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF["0.01"]).collect()}
    tokens = sum(r["length"] for r in rows)
    assert check(rows, texts) < 2048
    assert tokens > 100 * 2048


def test_blocks_fill_their_sequences(spark, docs_of):
    texts = {i: "words and more words " * (i % 37) for i in range(300)}
    df = docs_of(list(texts.items())).coalesce(1)
    rows = packing.pack_documents(df, block_tokens=5000).collect()
    assert check(rows, texts) < 2048


def test_odd_rows(spark, docs_of):
    texts = {1: None, 2: "", 3: "x " * 30000, 4: "naïve Ωμέγα 漢字 ­  <|endoftext|> \x1c", 5: "a\r\n\tb"}
    assert check(packing.pack_documents(docs_of(list(texts.items()))).collect(), texts) < 8 * 2048
    special = {1: "a <|endoftext|> b", 2: "<|endoftext|><|endoftext|>", 3: "<|endoftext|"}
    rows = packing.pack_documents(docs_of(list(special.items()))).collect()
    check(rows, special)
    assert {r["doc_id"]: r["doc_tokens"] for r in rows if r["start"] == 0}[1] == 5   # [64, 220, 50256, 275] and the end
    again = packing.pack_documents(docs_of([(None, "a"), (7, "b"), (7, "b")])).collect()
    assert sorted(str(r["doc_id"]) for r in again) == ["7", "7", "None"]
    assert packing.pack_documents(docs_of([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60))
def test_assignment_places_every_token_once(lengths):
    sequences = packing.assign(lengths, capacity=64)
    assert len(sequences) == -(-sum(lengths) // 64)
    assert all(sum(p[2] for p in s) <= 64 for s in sequences)
    pieces = defaultdict(list)
    for s in sequences:
        for doc, start, n in s:
            pieces[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(pieces[doc]):
            assert start == at
            at += size
        assert at == n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=40))
def test_a_rest_goes_to_the_cheapest_sequence_with_room(lengths):
    """Against a search of all sequences for every rest."""
    count = -(-sum(lengths) // 64)
    room, cost, want = [64] * count, [0.0] * count, [[] for _ in range(count)]
    for doc, n in sorted(enumerate(lengths), key=lambda r: (-r[1], r[0])):
        start = 0
        while n:
            fits = [i for i in range(count) if room[i] >= n] if not start else []
            i = min(fits or [i for i in range(count) if room[i]], key=lambda i: (cost[i], i))
            part = min(n, room[i])
            want[i].append((doc, start, part))
            room[i] -= part
            cost[i] += packing.LINEAR * part + packing.QUADRATIC * part * part
            start, n = start + part, n - part
    assert packing.assign(lengths, capacity=64) == [w for w in want if w]


def test_descending_documents_balance_the_cost():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 900, 4000).tolist()

    def costs(sequences):
        return np.array([sum(packing.LINEAR * n + packing.QUADRATIC * n * n for _, _, n in s) for s in sequences if
                         sum(p[2] for p in s) == 2048])

    in_order, at = [[]], 0
    for doc, n in enumerate(lengths):
        if sum(p[2] for p in in_order[-1]) + n > 2048:
            cut = 2048 - sum(p[2] for p in in_order[-1])
            in_order[-1].append((doc, 0, cut))
            in_order.append([(doc, cut, n - cut)])
        else:
            in_order[-1].append((doc, 0, n))
    assert costs(packing.assign(lengths)).std() < 0.7 * costs(in_order).std()
