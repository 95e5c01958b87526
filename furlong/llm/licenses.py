"""License notices found with a positional index of their rarest words.

The index is over templates: notices as licences give them. A template is entered under its RARE words of highest inverse
document frequency, counted in all documents, with the place of each in the template. A document's words are looked up;
a rare word at place i of the document that stands at place j of a template proposes that the template begins at i - j.
Proposals of one template are intersected by that relative place: of the template's rare words, enough have to stand
where the template wants them, up to SLACK words later, so that a few inserted or missing words do no harm. What is left
is compared with the whole template; the share of its words found, weighted by their rarity, is the score. Last, the
template's mandatory phrases, which tell licences of one family apart, have to stand in the place word for word.

The base phrases are short templates of the same index, without slack, of which every word is wanted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Block, blocks

RARE, VOTES, SLACK, MIN_SHARE = 4, 2, 3, 0.8
_ROWS = 1 << 20  # cells of a comparison at once

# The base phrases and their labels, then notices as the licences word them, with what each must hold.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
NOTICES = (
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("apache org", "license 2 0")),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    ("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", ("gnu general public license", "version 3")),
    ("gpl-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", ("gnu general public license", "version 2")),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", ("neither the name of", "endorse or promote products")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license", "2 0")),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike 4 0",)),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial 4 0",)),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0", ("cc by nd 4 0",)),
    ("cc0-1.0", "CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0",)),
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = ~((_LOWER >= 128) | np.isin(np.arange(256), list(b"0123456789abcdefghijklmnopqrstuvwxyz")))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass(frozen=True)
class Template:
    label: str
    words: list[str]
    phrases: list[list[str]] = field(default_factory=list)
    base: bool = False


def templates(notices: tuple = NOTICES, base: tuple = BASE) -> list[Template]:
    return [Template(label, words_of(phrase), [], True) for phrase, label in base] + [Template(label, words_of(t), [words_of(p) for p in must]) for label, t, must in notices]


class Vocabulary:
    """The different words of all templates by their hashes, in order; `words[i]` is the word of hash i."""

    def __init__(self, wanted: list[Template]):
        words = sorted({w for t in wanted for w in [*t.words, *(w for p in t.phrases for w in p)]})
        block = next(blocks(pa.array([" ".join(words)]), _SPACE))[2]
        order = np.argsort(block.hash)
        self.hashes, self.words = block.hash[order], [words[i] for i in order]
        self.id = {w: i for i, w in enumerate(self.words)}
        self.door = np.zeros(1 << 16, bool)
        self.door[self.hashes >> np.uint64(48)] = True

    def find(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Places of the vocabulary's words in a block, and which they are."""
        h = block.hash
        at = np.flatnonzero(self.door[h >> np.uint64(48)])
        which = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[which] == h[at]
        return at[same], which[same]


@dataclass
class Index:
    """Templates with the places of their rare words (the postings), and the weight of each word."""

    vocabulary: Vocabulary
    wanted: list[Template]
    idf: np.ndarray

    def __post_init__(self) -> None:
        self.ids = [np.array([self.vocabulary.id[w] for w in t.words]) for t in self.wanted]
        self.phrases = [[np.array([self.vocabulary.id[w] for w in p]) for p in t.phrases] for t in self.wanted]
        # The rarest first; among equally rare ones the word, then the earlier place.
        self.rare = [
            sorted(range(len(t.words)), key=lambda j, t=t, ids=ids: (-self.idf[ids[j]], t.words[j], j))[: 1 if t.base else RARE]
            for t, ids in zip(self.wanted, self.ids, strict=True)]


def index(docs: DataFrame, text: str = "text", wanted: list[Template] | None = None) -> Index:
    """The index with rarities counted in all documents: a row per template word comes back, whatever the data."""
    wanted = templates() if wanted is None else wanted
    vocabulary = Vocabulary(wanted)
    n = len(vocabulary.words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + 1, np.int64)
        for batch in batches:
            total[n] += batch.num_rows
            for _, _, block in blocks(batch.column(0), _SPACE, _LOWER):
                at, which = vocabulary.find(block)
                pairs = np.unique(np.searchsorted(block.first, at, "right") * n + which)
                total[:n] += np.bincount(pairs % n, minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 1)), pa.array(total)], names=["word", "docs"])

    count = dict(docs.select(text).mapInArrow(work, "word long, docs long").groupBy("word").agg(F.sum("docs")).collect())
    every = count.get(n, 0)
    return Index(vocabulary, wanted, np.array([1 + math.log((1 + every) / (1 + count.get(i, 0))) for i in range(n)]))


def _phrase(block: Block, doc: np.ndarray, at: np.ndarray, which: np.ndarray, ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """First words of all places where the words of the phrase stand one after another in a document."""
    head = at[which == phrase[0]]
    head = head[head + len(phrase) <= len(doc)]
    head = head[doc[head] == doc[head + len(phrase) - 1]]
    for i in range(1, len(phrase)):
        head = head[ids[head + i] == phrase[i]]
    return head


def _matches(found: Index, t: int, block: Block, doc: np.ndarray, at: np.ndarray, which: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, first words (in the document) and scores of the places that hold template t."""
    want, rare, wanted = found.ids[t], found.rare[t], found.wanted[t]
    size, slack = len(want), 0 if wanted.base else SLACK
    hits = [(at[which == want[j]], j) for j in rare]
    d = np.concatenate([doc[x] for x, _ in hits])
    begin = np.concatenate([x - block.first[doc[x]] - j for x, j in hits])
    if not len(d):
        return d, begin, np.zeros(0)
    d, begin = np.unique(np.stack([d, begin]), axis=1)
    weight, out = found.idf[want], []
    places = [(len(p), _phrase(block, doc, at, which, ids, p)) for p in found.phrases[t]]
    for a in range(0, len(d), max(1, _ROWS // size)):
        dd, bb = d[a : a + max(1, _ROWS // size)], begin[a : a + max(1, _ROWS // size)]
        first, n = block.first[dd][:, None], block.n_words[dd][:, None]
        same = np.zeros((len(dd), size), bool)
        for k in range(slack + 1):
            x = bb[:, None] + k + np.arange(size)
            inside = (x >= 0) & (x < n)
            same |= inside & (ids[np.where(inside, first + x, 0)] == want)
        share = np.where(same.all(1), 1.0, np.minimum(1.0, same @ weight / weight.sum()))
        ok = (share >= (1.0 if wanted.base else MIN_SHARE)) & (same[:, rare].sum(1) >= min(VOTES, len(rare)))
        for length, heads in places:
            lo = first[:, 0] + np.maximum(bb, 0)
            hi = first[:, 0] + np.minimum(bb + size + slack, n[:, 0]) - length
            ok &= np.searchsorted(heads, lo) < np.searchsorted(heads, hi, "right")
        out.append((dd[ok], bb[ok], share[ok]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _work(found: Index, block: Block) -> list[pa.Array]:
    rows, doc = block.n_docs, block.doc
    at, which = found.vocabulary.find(block)
    ids = np.full(max(1, len(doc)), -1, np.int32)
    ids[at] = which
    n_base, first, last, score = np.zeros(rows, np.int64), np.full(rows, 1 << 62), np.full(rows, -1), np.zeros(rows)
    labels: list[set[str]] = [set() for _ in range(rows)]
    base: list[set[str]] = [set() for _ in range(rows)]
    for t, wanted in enumerate(found.wanted):
        d, begin, share = _matches(found, t, block, doc, at, which, ids)
        np.maximum.at(score, d, share)
        if wanted.base:
            np.add.at(n_base, d, 1)
            np.minimum.at(first, d, begin)
            np.maximum.at(last, d, begin)
        for i in np.unique(d).tolist():
            labels[i].add(wanted.label)
            if wanted.base:
                base[i].add(wanted.label)
    none = n_base == 0
    return [pa.array(block.n_words, pa.int64()), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
            pa.array([",".join(sorted(x)) for x in base]), pa.array([",".join(sorted(x)) for x in labels]), pa.array(score)]


def scan(docs: DataFrame, found: Index | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels` and `score`.

    `n_base` counts the places of base phrases, `first_word` and `last_word` are the first and last of their starts (null
    if there is none); `labels` are those of all templates found, `score` the best share of one. Null and empty texts
    have no words, no labels and the score 0. Each row is judged by itself: rows that repeat count as documents of their
    own, null ids and columns of any name make no difference, and an empty table gives no rows.
    """
    found = index(docs, text) if found is None else found
    at, names = len(keep), ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    schema += ", n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, block in blocks(batch.column(at), _SPACE, _LOWER):
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:at]), *_work(found, block)], names=[*(f"_{i}" for i in range(at)), *names])

    chosen = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"))
    return chosen.mapInArrow(work, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *names)
