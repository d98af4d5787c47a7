"""Cost-balanced packing of token sequences.

A sequence costs LINEAR per token plus QUADRATIC per pair of tokens of a
document that attend to each other. Within a block of documents, pieces in
descending order of length go to the cheapest sequence that has tokens left.
Blocks are cut from the rows as they are read, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
#: Estimated costs: per token, and per token and token of the same document.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Tokens that are packed together, which bounds a task's memory to a few times 4 bytes each.
BLOCK_TOKENS = 4_000_000
#: Id of the token after each document.
END = 1
SEQUENCES_PER_PARTITION = 1 << 36

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
# Text of these characters is split alike by both tokenizer libraries.
_COMMON = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")


def assign(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC,
           n_sequences: int | None = None) -> list[list[tuple[int, int, int]]]:
    """Pieces (document, start, length) of each sequence, for documents of ``lengths`` tokens.

    There are as many sequences as the tokens need, so that less than ``capacity``
    places stay empty in all. Whole multiples of the capacity are cut off long
    documents first. Each rest, the longest first, goes to the cheapest
    sequence with room for it, or, if none has, in parts to the cheapest ones.

    As the rests get shorter, a sequence with room for one has room for all that follow
    until it takes one, so it waits at most once between two of them."""
    total = sum(lengths)
    full: list[list[tuple[int, int, int]]] = []
    rests = []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity:
            full.append([(doc, start, capacity)])
            start += capacity
        if n > start:
            rests.append((doc, start, n - start))
    count = max(0, (n_sequences or -(-total // capacity)) - len(full))
    open_: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    room, cost, version = [capacity] * count, [0.0] * count, [0] * count
    fitting = [(0.0, i, 0) for i in range(count)]            # by cost: room for the rest at hand
    by_room: list[tuple[int, int, int]] = []                 # the others, by room and by cost
    by_cost: list[tuple[float, int, int]] = []

    def pop(heap: list) -> int | None:
        while heap:
            _, i, v = heapq.heappop(heap)
            if v == version[i]:
                return i
        return None

    def place(i: int, doc: int, start: int, n: int, size: int) -> None:
        open_[i].append((doc, start, n))
        room[i] -= n
        cost[i] += linear * n + quadratic * n * n
        version[i] += 1
        if room[i] >= size:
            heapq.heappush(fitting, (cost[i], i, version[i]))
        elif room[i]:
            heapq.heappush(by_room, (-room[i], i, version[i]))
            heapq.heappush(by_cost, (cost[i], i, version[i]))

    for doc, start, n in sorted(rests, key=lambda r: (-r[2], r[0])):
        while by_room and -by_room[0][0] >= n:   # room for this shorter rest
            _, i, v = heapq.heappop(by_room)
            if v == version[i]:
                version[i] += 1
                heapq.heappush(fitting, (cost[i], i, version[i]))
        if (i := pop(fitting)) is not None:
            place(i, doc, start, n, n)
            continue
        size = n
        while n:
            i = pop(by_cost)
            part = min(n, room[i])
            place(i, doc, start, part, size)
            start, n = start + part, n - part
    return full + [s for s in open_ if s]


def tokenizer(path: str, ranks_path: str | None, pattern: str | None):
    """A function from texts to arrays of ids.

    The ids are those that the ``tokenizers`` file at ``path`` gives without special tokens
    added; the name of a special token in a text is that token. If ``ranks_path`` names
    the same vocabulary as ranks, texts of common Latin characters without such a name, on which both
    libraries agree, are encoded with these, which is several times as fast."""
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(path)
    names = [t.content for t in exact.get_added_tokens_decoder().values()]
    fast = None
    if ranks_path:
        import base64

        import tiktoken
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if fast is not None and _COMMON.fullmatch(text) and not any(name in text for name in names):
            return fast.encode_to_numpy(text, disallowed_special=())
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer_path: str | None = None, ranks_path: str | None = None,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    A document's ids are those of its text (null: empty) and ``END``; so an empty
    one has one id. Each id lies in exactly one piece, the pieces of a sequence lie
    one after another from offset 0, and every block but a partition's last fills
    its sequences: what doesn't fill one is packed with the next block. Rows that
    repeat an id are documents of their own, null ids stay null, an empty table
    gives an empty one, and other columns are not looked at. The numbers of
    sequences depend on the input's partitions, their rows and order alone, so a
    task that runs again gives the same rows.

    Without paths, the files of the public tokenizers package are used.
    """
    pattern = None
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    if ranks_path:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(tokenizer_path, ranks_path, pattern)
        sequence = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        # documents of the block: id, all ids, tokens already packed
        block: list[tuple] = []
        waiting = 0

        def flush(last: bool) -> pd.DataFrame:
            nonlocal block, waiting, sequence
            whole = waiting // capacity
            if last or not whole:
                used, held = block, []
                whole = None
            else:  # keep what fills no sequence (of the latest documents) for the next block
                held, spare, used = [], waiting - whole * capacity, list(block)
                while spare:
                    doc, ids, start, end = used.pop()
                    part = min(spare, end - start)
                    held.append((doc, ids, end - part, end))
                    if end - part > start:
                        used.append((doc, ids, start, end - part))
                    spare -= part
            rows = []
            for pieces in assign([end - start for _, _, start, end in used], capacity):
                offset = 0
                for d, start, n in pieces:
                    doc, ids, first, _ = used[d]
                    start += first
                    rows.append((doc, start, n, zlib.crc32(ids[start:start + n].astype("<u4").tobytes()), len(ids),
                                 sequence, offset))
                    offset += n
                sequence += 1
            block, waiting = held[::-1], sum(x[3] - x[2] for x in held)
            return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})

        for frame in frames:
            for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.append(encode(text), np.uint32(END)).astype(np.uint32)
                block.append((None if pd.isna(doc) else int(doc), ids, 0, len(ids)))
                waiting += len(ids)
                if waiting >= block_tokens:
                    yield flush(False)
        if block:
            yield flush(True)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(pack, SCHEMA)
