"""Deduplication of long byte strings by blockwise suffix sorting with a difference cover.

A string of LENGTH bytes belongs to the bucket of its anchor: the GRAM bytes in
it with the smallest hash. Equal strings have equal anchors, so they meet in one
bucket, whatever document they start in. Consecutive strings with one anchor
form a context. Buckets that one document alone fills can't hold a repeat and are
left out before any text moves; of the others, contexts are moved, and the
suffixes at their starts are sorted bucket by bucket. A difference cover of the
positions relative to the anchor is ranked first; comparing two suffixes then
takes one word at either end and the ranks of two cover positions, however long
the tie between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenolens.llm.common import NULL_ID, broadcast_if_small, shared_table

LENGTH, GRAM = 50, 20
WIDTH = LENGTH - GRAM + 1
#: {0, 1, 3} is a difference cover modulo 7; ranked cover strings have RANKED bytes.
PERIOD, COVER, RANKED = 7, (0, 1, 3), 32
#: Bytes of text a block of documents holds, and of text hashed at once.
BLOCK_BYTES, CHUNK = 8 << 20, 1 << 19
#: The sizes of blocks are broadcast up to this size.
BROADCAST_BYTES = 32 << 20
#: Strings sorted at once, in whole buckets.
SORTED = 400_000
#: Contexts of a bucket, over all blocks, beyond which it is split by its strings.
HOT_CONTEXTS = 20_000
#: A block counts the contexts of a bucket exactly (equal ones once) from so many on.
COUNTED = 16

_TABLE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.random.default_rng(20240302).integers(1, 1 << 63, 13, dtype=np.uint64) | np.uint64(1)
_AHEAD = np.array([min(d for d in range(PERIOD) if (phase + d) % PERIOD in COVER) for phase in range(PERIOD)])
_BACK = np.array([min(d for d in range(PERIOD) if (phase - d) % PERIOD in COVER) for phase in range(PERIOD)])


def gram_hashes(data: np.ndarray, length: int = GRAM) -> np.ndarray:
    """Hash of the ``length`` bytes at each position of ``data`` (uint8), put together from powers of two."""
    power, size, level = _TABLE[data], 1, 0
    whole, done = None, 0
    n = len(data) - length + 1
    while done < length:
        if length & size:
            part = power[done:done + n]
            whole = part.copy() if whole is None else whole * _ODD[-1 - level] + part
            done += size
        if done < length:
            power = power[:-size] * _ODD[level] + power[size:]
            size, level = 2 * size, level + 1
    whole ^= whole >> np.uint64(32)
    whole *= _ODD[6]
    whole ^= whole >> np.uint64(29)
    return whole


def contexts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor position, anchor hash) of runs of strings with one anchor.

    ``ends``: where the documents in ``data`` end; no string crosses one."""
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, np.zeros(0, np.uint64)
    hashes = gram_hashes(data)
    position_bits = np.uint64((1 << 24) - 1)
    m = (hashes & ~position_bits) | np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the leftmost
    for step in (1, 2, 4, 8):
        m = np.minimum(m[:-step], m[step:])
    m = np.minimum(m[:-(WIDTH - 16)], m[WIDTH - 16:])
    anchor = (m & position_bits).astype(np.int64)
    starts = np.arange(len(anchor))
    document = np.searchsorted(ends, starts, side="right")
    inside = starts + LENGTH <= ends[np.minimum(document, len(ends) - 1)]
    starts, anchor, document = starts[inside], anchor[inside], document[inside]
    if not len(starts):
        return empty, empty, empty, np.zeros(0, np.uint64)
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(document) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(starts)]]) - 1
    return starts[first], starts[last], anchor[first], hashes[anchor[first]]


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of ``texts`` to be hashed at once: bytes, ends, and each piece's text and offset in it.

    A text over CHUNK bytes is cut with an overlap of LENGTH - 1 bytes, so that every
    string lies in exactly one piece."""
    pieces, size = [], 0

    def made():
        ends = np.cumsum([len(p[2]) for p in pieces])
        return (np.frombuffer(b"".join(p[2] for p in pieces), np.uint8), ends,
                np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces]))

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            piece = text[at:at + CHUNK + LENGTH - 1]
            pieces.append((i, at, piece))
            size += len(piece)
            if size >= CHUNK:
                yield made()
                pieces, size = [], 0
    if pieces:
        yield made()


def _all_contexts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, start in it, end of the last string, anchor relative to start, bucket) of all contexts."""
    for data, ends, text, offset in _chunks(texts):
        first, last, anchor, bucket = contexts(data, ends)
        piece = np.searchsorted(ends, first, side="right")
        begins = np.concatenate([[0], ends[:-1]])
        start = first - begins[piece] + offset[piece]
        yield text[piece], start, start + (last - first) + LENGTH, anchor - first, bucket.view(np.int64)


def repeated(buckets: np.ndarray, strings: list[bytes], anchors: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(context, from, to): bytes of contexts that strings of their bucket with a smaller id cover too."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    words = np.zeros(len(data) - 7, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | data[k:len(data) - 7 + k]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    relative = np.arange(len(owner)) - (offsets + anchors)[owner]
    # ranks of the cover: strings of RANKED bytes at positions of the cover, relative to the anchors
    cover = np.flatnonzero(np.isin(relative % PERIOD, COVER) & (np.arange(len(owner)) + RANKED <= (offsets + sizes)[owner]))
    ranks = np.full(len(owner), -1, np.int64)
    keys = [words[cover + k] for k in range(0, RANKED, 8)]
    order = np.lexsort(keys[::-1])
    changes = np.zeros(len(cover), bool)
    for key in keys:
        changes[1:] |= key[order][1:] != key[order][:-1]
    ranks[cover[order]] = np.cumsum(changes)
    # the suffixes at the starts of strings, by bucket and place relative to the anchor
    at = np.flatnonzero(np.arange(len(owner)) + LENGTH <= (offsets + sizes)[owner])
    phase = relative[at] % PERIOD
    tail = at + LENGTH - RANKED
    keys = [np.unique(buckets, return_inverse=True)[1][owner[at]] * 2 * LENGTH + relative[at], words[at],
            ranks[at + _AHEAD[phase]], ranks[tail - _BACK[(phase + LENGTH - RANKED) % PERIOD]], words[at + LENGTH - 8]]
    order = np.lexsort(keys[::-1])
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = False
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
    sorted_ids = ids[owner[at]][order]
    smallest = np.minimum.reduceat(sorted_ids, np.flatnonzero(new)) if len(at) else sorted_ids
    hit = np.zeros(len(owner), bool)
    hit[at[order]] = smallest[np.cumsum(new) - 1] < sorted_ids if len(at) else False
    starts = np.flatnonzero(hit)
    if not len(starts):
        return
    cuts = np.flatnonzero((np.diff(starts) != 1) | (np.diff(owner[starts]) != 0)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(starts)]]) - 1):
        c = owner[starts[a]]
        yield int(c), int(starts[a] - offsets[c]), int(starts[b] - offsets[c]) + LENGTH


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _sorted_texts(f: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    return f["id"].to_numpy(), [(t or "").encode() for t in f["text"]]


def _buckets(f: pd.DataFrame) -> pd.DataFrame:
    """The buckets of a block of documents, once each, with the number of their different contexts."""
    _, texts = _sorted_texts(f)
    parts = [(text, start, end, bucket) for text, start, end, _, bucket in _all_contexts(texts)]
    text, start, end, bucket = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
    buckets, sizes = np.unique(bucket, return_counts=True)
    many = np.flatnonzero(sizes >= COUNTED)
    if len(many):
        held = np.searchsorted(buckets[many], bucket)
        at = np.flatnonzero(buckets[many][np.minimum(held, len(many) - 1)] == bucket)
        different: list[set] = [set() for _ in many]
        for k, t, a, b in zip(*(x[at].tolist() for x in (held, text, start, end))):
            different[k].add(texts[t][a:b])
        sizes[many] = [len(d) for d in different]
    return pd.DataFrame({"bucket": buckets, "block": f["block"].iloc[0] if len(f) else 0, "size": sizes.astype(np.int32)})


def _block_contexts(f: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    """Contexts of a block that other blocks may repeat, once each, for the smallest id of the
    block. What repeats within the block is found here, and told by rows without a string.

    Of a hot bucket the strings are sent instead of the contexts, each to the bucket of its
    hash, where equal strings of all blocks still meet, one a block."""
    ids, texts = _sorted_texts(f)
    elsewhere = np.sort(shared["bucket"].to_numpy())
    hot = set(shared.loc[shared["hot"].astype(bool), "bucket"].tolist())
    parts = list(_all_contexts(texts))
    if not parts:
        return _rows([])
    text, start, end, anchor, bucket = (np.concatenate(x) for x in zip(*parts))
    held = np.searchsorted(elsewhere, bucket)
    outside = (held < len(elsewhere)) & (elsewhere[np.minimum(held, len(elsewhere) - 1)] == bucket) if len(
        elsewhere) else np.zeros(len(bucket), bool)
    wanted = outside.copy()
    if len(bucket):  # or two documents of this block hold the bucket
        order = np.lexsort((ids[text], bucket))
        first = np.concatenate([[True], np.diff(bucket[order]) != 0])
        low = np.minimum.reduceat(ids[text][order], np.flatnonzero(first))[np.cumsum(first) - 1]
        high = np.maximum.reduceat(ids[text][order], np.flatnonzero(first))[np.cumsum(first) - 1]
        wanted[order] |= low < high
    wanted = np.flatnonzero(wanted)
    wanted = wanted[np.argsort(ids[text[wanted]], kind="stable")]  # the first mention of a context has the smallest id
    known: dict[bytes, int] = {}
    rows: list[list] = [[] for _ in range(7)]
    block = f["block"].iloc[0] if len(f) else 0
    digests: dict[int, int] = {}
    spans: dict[int, list] = {}

    def digest(t: int) -> int:
        if t not in digests:
            digests[t] = _digest(texts[t])
        return digests[t]

    own = ids.tolist()
    inside: dict[int, list[tuple]] = {}
    for t, a, b, where, key, sent in zip(*(x[wanted].tolist() for x in (text, start, end, anchor, bucket, outside))):
        if key in hot:
            for p in range(a, b - LENGTH + 1):
                string = texts[t][p:p + LENGTH]
                if known.setdefault(string, own[t]) != own[t]:
                    spans.setdefault(t, []).append((p, p + LENGTH))
                else:
                    for column, value in zip(rows, (_digest(string), string, where - (p - a), own[t], digest(t), p, block)):
                        column.append(value)
            continue
        string = texts[t][a:b]
        if known.setdefault(string, own[t]) != own[t]:
            spans.setdefault(t, []).append((a, b))
        elif sent:
            for column, value in zip(rows, (key, string, where, own[t], digest(t), a, block)):
                column.append(value)
        else:
            inside.setdefault(key, []).append((key, string, where, own[t], a, t))
    for part in _sortable(c for members in inside.values() if len(members) > 1 for c in members):
        for c, a, b in repeated(*_columns(part)):
            spans.setdefault(part[c][5], []).append((part[c][4] + a, part[c][4] + b))
    for t, found in spans.items():
        for a, b in _union(found):
            for column, value in zip(rows, (own[t], None, b - a, own[t], digest(t), a, block)):
                column.append(value)
    return _rows(rows)


CONTEXT = "bucket long, string binary, anchor long, id long, text_hash long, start long, block long"
SPAN = "id long, text_hash long, start long, stop long, block long"


def _rows(columns: list[list]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip((c.split()[0] for c in CONTEXT.split(", ")), columns or [[]] * 7)))


def _digest(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _sortable(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (bucket, string, ...) that come bucket by bucket, cut between buckets into lists of about SORTED bytes."""
    waiting: list[tuple] = []
    size = 0
    for row in rows:
        if size >= SORTED and row[0] != waiting[-1][0]:
            yield waiting
            waiting, size = [], 0
        waiting.append(row)
        size += len(row[1])
    if waiting:
        yield waiting


def _columns(rows: list[tuple]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    buckets, strings, anchors, ids = zip(*(r[:4] for r in rows))
    return np.array(buckets), list(strings), np.array(anchors), np.array(ids)


def _sort_buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans from contexts that come in order of their buckets."""
    names = [c.split()[0] for c in SPAN.split(", ")]
    told: list[pd.DataFrame] = []

    def contexts_of() -> Iterator[tuple]:
        for f in frames:
            without = f[f["string"].isna()]
            if len(without):
                told.append(pd.DataFrame({
                    "id": without["id"], "text_hash": without["text_hash"], "start": without["start"],
                    "stop": without["start"] + without["anchor"], "block": without["block"]}))
            yield from f[f["string"].notna()].itertuples(index=False, name=None)

    for part in _sortable(contexts_of()):
        found = []
        for c, a, b in repeated(*_columns(part)):
            _, _, _, doc, digest, start, block = part[c]
            found.append((doc, digest, start + a, start + b, block))
        yield pd.DataFrame(found, columns=names)
        yield from told
        told.clear()
    yield from told


def _remove(f: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    found: dict[tuple[int, int], list] = {}
    for doc, digest, start, stop in spans[["id", "text_hash", "start", "stop"]].itertuples(index=False, name=None):
        found.setdefault((doc, digest), []).append((start, stop))
    ids, texts = _sorted_texts(f)
    rows = []
    for doc, text in zip(ids, texts):
        runs = _union(found.get((doc, _digest(text)), [])) if found else []
        kept, at = [], 0
        for start, stop in runs:
            kept.append(text[at:start])
            at = stop
        kept.append(text[at:])
        rows.append((doc, len(text), sum(b - a for a, b in runs), len(runs), b"".join(kept),
                     [int(x) for r in runs for x in r]))
    return pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def _sent(blocks: DataFrame, hot_contexts: int) -> DataFrame:
    """What blocks of documents send to the buckets they share."""
    buckets = blocks.groupBy("block").applyInPandas(lambda f: _buckets(f), "bucket long, block long, size int")
    by_bucket = Window.partitionBy("bucket")
    shared = (buckets.withColumns({"n": F.count("*").over(by_bucket), "total": F.sum("size").over(by_bucket)})
              .filter("n > 1").select("block", "bucket", (F.col("total") > hot_contexts).alias("hot")))
    return blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        lambda f, s: _block_contexts(f, s), CONTEXT)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, spans), one row per row of ``docs``.

    Every byte is removed that lies in a string of LENGTH bytes which also starts in
    a document with a smaller id; ``spans`` are the removed runs (start, end, start,
    ...), ``kept`` the other bytes. Null counts as empty text, the null id as the
    smallest. Rows that share an id are one document, whose rows never shorten each
    other. Other columns are not looked at, and an empty table gives an empty one.

    Documents are dealt into blocks that copies tend to share. A block tells its buckets once
    each, however often its documents repeat a passage, and gets back those that
    other blocks hold too; then it sends its contexts of these, again once each. So
    neither a passage nor a document makes a task large, and a task holds one block,
    or the strings of some buckets. A bucket of over ``hot_contexts`` contexts, as of a short
    phrase between many different neighbours, is split by the strings in it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    # copies are dealt alike: by the smallest hash of a line; what gets too large is dealt on by id
    deal = F.pmod(F.array_min(F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line))),
                  F.lit(max(1, -(-total // block_bytes))))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), text.alias("text"),
                       deal.alias("deal"))
    parts = shared_table(rows.groupBy("deal").agg(F.ceil(
        (F.sum(F.octet_length("text").cast("long")) + 1) / F.lit(block_bytes)).alias("parts")), "blocks")
    blocks = (rows.join(broadcast_if_small(parts, BROADCAST_BYTES, 16), "deal")
              .select("id", "text", F.xxhash64("deal", F.pmod(F.xxhash64("id"), F.col("parts"))).alias("block"))
              .repartition("block"))
    sent = _sent(blocks, hot_contexts)
    spans = (sent.repartition("bucket").sortWithinPartitions("bucket")
             .mapInPandas(lambda frames: _sort_buckets(frames), SPAN))
    out = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(
        lambda f, s: _remove(f, s), "id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<long>")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      "kept", "spans")
