"""License scans by a positional index of rare words.

A template is a run of words with a label. Its rarest words (by their document
frequency in the scanned corpus) are posted with their positions. A file looks up
its own words that have postings; every hit places a template in the file, and
hits that agree on the place, that is on their relative position, are intersected.
Where they carry enough of the template's rare words, the template is compared
word by word at that place, and its mandatory key phrases are verified.
"""

from __future__ import annotations

import math
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolens.llm.common import word_bytes


@dataclass(frozen=True)
class Template:
    """``keys`` are phrases of the text that must stand whole, each at its own place up to DRIFT words.
    A base template is a phrase that must stand whole itself."""
    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# The phrases and labels of the contract.
BASE = (Template("cc-by", "cc by", base=True), Template("gpl", "general public license", base=True),
        Template("reserved", "all rights reserved", base=True))

# Usual notices of public licenses, and what each can't be without.
NOTICES = (
    Template("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3", ("affero general public license", "version 3")),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Template("apache-2.0", "SPDX-License-Identifier: Apache-2.0", ("spdx license identifier apache 2 0",)),
    Template("bsd-2-clause", "SPDX-License-Identifier: BSD-2-Clause", ("bsd 2 clause",)),
    Template("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause", ("bsd 3 clause",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met", ("redistribution and use in source and binary forms", "are permitted")),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0", ("cc by nc sa 4 0",)),
    Template("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0", ("cc by nd 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc0-1.0", "Released under CC0 1.0 Universal", ("cc0 1 0",)),
    Template("gpl-2.0", "Licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("gpl-3.0", "Licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted", ("permission to use copy modify", "with or without fee")),
    Template("lgpl", "Licensed under the GNU Lesser General Public License", ("lesser general public license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", "SPDX-License-Identifier: MIT", ("spdx license identifier mit",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license", "2 0")),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
)

#: Words of a template that are posted: its rarest.
POSTED = 6
#: Share of the rarity of the posted words that hits at one place must carry, and share of all words that must agree there.
CARRIED, AGREE = 0.5, 0.6
#: Words by which a key phrase may stand off its place.
DRIFT = 3
MATCH = "array<struct<label string, start long, length long, agreement double, base boolean>>"


def document_frequencies(docs: DataFrame, text_col: str, words: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Rows with words, and how many rows hold each of ``words``: as many numbers as words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                own = set(word_bytes(text.as_py() or b""))
                seen.update(own & words)
                seen[b""] += bool(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    got = {r["word"].encode(): r["n"] for r in docs.select(F.col(text_col).alias("text")).mapInArrow(
        count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return got.pop(b"", 0), got


class RareWordIndex:
    """Postings (template, position) of the rarest words of each template, and what a match is checked by."""

    def __init__(self, templates: tuple[Template, ...], rows: int, frequency: dict[bytes, int]):
        self.templates = templates
        self.words = [word_bytes(t.text.encode()) for t in templates]
        self.postings: dict[bytes, list[tuple[int, int, float]]] = defaultdict(list)
        self.needed, self.rarity, self.keys = [], [], []

        def rarity(word: bytes) -> float:
            return math.log((rows + 1) / (frequency.get(word, 0) + 1)) + 1e-3  # a word of every row still counts

        for t, words in enumerate(self.words):
            self.rarity.append([rarity(w) for w in words])
            rarest = sorted(range(len(words)), key=lambda i: (-self.rarity[t][i], i))[:1 if templates[t].base else POSTED]
            for i in rarest:
                self.postings[words[i]].append((t, i, self.rarity[t][i]))
            self.needed.append(CARRIED * sum(self.rarity[t][i] for i in rarest))
            places = []
            for phrase in templates[t].keys:
                key = word_bytes(phrase.encode())
                at = next((i for i in range(len(words)) if words[i:i + len(key)] == key), None)
                if at is None:
                    raise ValueError(f"the key phrase {phrase!r} is not in the template {templates[t].label!r}")
                places.append((at, key))
            self.keys.append(places)

    def _places(self, words: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """(template, start, carried rarity) of every place that a hit names; hits of one place are summed.

        Hits come by position, so places that no later hit can name are handed on and forgotten."""
        longest = max(map(len, self.words), default=0)
        carried: dict[tuple[int, int], float] = defaultdict(float)
        full = 1 << 16
        for place in (i for i, w in enumerate(words) if w in self.postings):
            for t, i, weight in self.postings[words[place]]:
                carried[t, place - i] += weight
            if len(carried) >= full:
                for key in [key for key in carried if key[1] < place - longest]:
                    yield *key, carried.pop(key)
                full = max(full, 2 * len(carried))
        for key, weight in carried.items():
            yield *key, weight

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int, float, bool]]:
        """(label, start, length, agreement, base) of all templates in ``words``, by start.

        Of places where a notice overlaps itself the best agreement stays, the first of equals."""
        found, notices = [], defaultdict(list)
        for t, start, weight in self._places(words):
            own, template = self.words[t], self.templates[t]
            if template.base:
                if start >= 0 and words[start:start + len(own)] == own:
                    found.append((template.label, start, len(own), 1.0, True))
            elif weight >= self.needed[t] and (agreement := self._agreement(words, t, start)) >= AGREE:
                notices[t].append((-agreement, start))
        for t, places in notices.items():
            length, starts = len(self.words[t]), []
            for agreement, start in sorted(places):
                at = bisect(starts, start)
                if all(abs(start - s) >= length for s in starts[max(at - 1, 0):at + 1]):
                    starts.insert(at, start)
                    first, end = max(start, 0), min(start + length, len(words))
                    found.append((self.templates[t].label, first, end - first, -agreement, False))
        return sorted(found, key=lambda m: (m[1], m[0], m[2]))

    def _agreement(self, words: list[bytes], t: int, start: int) -> float:
        """Share, by rarity, of the template's words that stand at their places; 0 without its key phrases."""
        own, rarity = self.words[t], self.rarity[t]
        for at, key in self.keys[t]:
            centre = start + at
            if not any(words[p:p + len(key)] == key for p in range(max(centre - DRIFT, 0), centre + DRIFT + 1)):
                return 0.0
        there = sum(r for i, (w, r) in enumerate(zip(own, rarity, strict=True))
                    if 0 <= start + i < len(words) and words[start + i] == w)
        return there / sum(rarity)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = BASE + NOTICES) -> DataFrame:
    """(id, n_words, matches), one row per row of ``docs``; the matches of a row by their start.

    Words are runs of ASCII letters and digits and of characters beyond ASCII,
    with A-Z lower-cased. Null and empty texts have no words and no matches. Base templates match
    wherever their words stand consecutively, notices where the rare words agree on
    a place and the key phrases are there. Repeated rows and null ids are rows like
    others; other columns aren't read; an empty table gives no rows. The index has the
    size of the templates; the frequencies of their words count all rows.
    """
    words = frozenset(w for t in templates for w in word_bytes(t.text.encode()))
    rows, frequency = document_frequencies(docs, text_col, words)
    index = RareWordIndex(templates, rows, frequency)
    fields = [("label", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("agreement", pa.float64()),
              ("base", pa.bool_())]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column(1).cast(pa.binary()):
                words = word_bytes(text.as_py() or b"")
                counts.append(len(words))
                found.append([dict(zip([f[0] for f in fields], m, strict=True)) for m in index.matches(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.struct(fields)))],
                names=[id_col, "n_words", "matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        match, f"`{id_col}` {kind}, n_words long, matches {MATCH}")


def summarise(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of the rows of ``scan``.

    ``score`` is the best agreement of a row's matches (1 with a base phrase), 0 without any."""
    base = F.filter("matches", lambda m: m["base"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")

    starts = F.transform(base, lambda m: m["start"])
    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["agreement"])), F.lit(0.0)).alias("score"))
