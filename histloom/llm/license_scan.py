"""License scans by exact set-similarity join.

Blocks of a text are windows of ``2 * width`` words, one every ``width`` words,
where ``width`` is the longest template's number of words: whatever part of a
text is as long as a template lies whole in some block, across line ends too.  A
block matches a template when it holds at least ``threshold`` hundredths of the
template's distinct words.

The templates' words are ordered by how many documents hold them, rarest first,
counted over all documents.  With a least overlap of k, a block and a template
that match share a word of the template's first ``size - k + 1`` words, which also
is among the block's first ones in that order.  So only blocks around a prefix
word are looked at; the length and positional filters drop those that cannot
reach k any more, and the rest are compared in full.  Nothing is missed.

Phrases are templates that must be held whole; of their blocks, the places where
the words stand one after another are taken."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .terms import sum_by_key, terms

#: The phrases every scan looks for, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Texts of license notices and their labels (a parameter of the scan).
TEMPLATES = {
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "Released under the MIT License": "mit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3.0",
    "GNU Lesser General Public License": "lgpl",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
    "subject to the terms of the Mozilla Public License": "mpl",
    "released into the public domain": "public-domain",
}
#: Hundredths of a template's words that a matching block holds.
THRESHOLD = 90
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                             ("containment", pa.float64())]))


@dataclass
class Template:
    label: str
    words: tuple[bytes, ...]
    phrase: bool                       # the words must stand one after another
    least: int = 0                     # least overlap
    ranks: frozenset[int] = frozenset()


@dataclass
class Index:
    """The templates' words in global order, and which of them are prefix words."""
    templates: list[Template]
    width: int
    rank: dict[bytes, int]

    def __post_init__(self):
        self.by_rank: dict[int, list[tuple[int, int]]] = {}      # rank -> (template, position in its order)
        for t, one in enumerate(self.templates):
            one.ranks = frozenset(self.rank[w] for w in one.words)
            for i, r in enumerate(sorted(one.ranks)[:len(one.ranks) - one.least + 1]):
                self.by_rank.setdefault(r, []).append((t, i))
        self.prefix = frozenset(w for w, r in self.rank.items() if r in self.by_rank)

    def blocks(self, words: list[bytes]) -> list[int]:
        """Blocks, by number, that hold a prefix word; block b has the words from
        ``b * width`` on.  The last one is the first that reaches the end."""
        if self.prefix.isdisjoint(words):
            return []
        last = max(0, -(-len(words) // self.width) - 2)
        near = {p // self.width for p, w in enumerate(words) if w in self.prefix}
        return sorted({min(b, last) for b in near} | {b - 1 for b in near if b})

    def candidates(self, block: list[bytes]) -> tuple[list[int], frozenset[int]]:
        """Templates that pass the prefix, length and positional filters, and the
        ranks of the block's words."""
        held = frozenset(self.rank[w] for w in self.rank.keys() & set(block))
        found = set()
        order = sorted(held)
        for j, r in enumerate(order):
            for t, i in self.by_rank.get(r, ()):
                one = self.templates[t]
                if len(order) >= one.least and min(len(one.ranks) - i, len(order) - j) >= one.least:
                    found.add(t)
        return sorted(found), held

    def scan(self, words: list[bytes]) -> tuple[list[tuple], list[tuple]]:
        """(matches, places) as (label, start, stop, containment) in words."""
        matches, places = set(), set()
        for b in self.blocks(words):
            start, stop = b * self.width, min((b + 2) * self.width, len(words))
            block = words[start:stop]
            possible, held = self.candidates(block)
            for t in possible:
                one = self.templates[t]
                shared = len(one.ranks & held)
                if shared < one.least:
                    continue
                if one.phrase:
                    n = len(one.words)
                    places.update((one.label, start + p, start + p + n, 1.0) for p in range(len(block) - n + 1)
                                  if tuple(block[p:p + n]) == one.words)
                else:
                    matches.add((one.label, start, stop, shared / len(one.ranks)))
        return sorted(matches, key=_order), sorted(places, key=_order)


def _order(span: tuple) -> tuple:
    return span[1], span[2], span[0], span[3]


def parse_templates(templates: Mapping[str, str], phrases: Mapping[str, str], threshold: int) -> list[Template]:
    """Templates and phrases with their least overlaps; ones without words are refused."""
    if not 0 < threshold <= 100:
        raise ValueError(f"threshold {threshold}; must be above 0 and at most 100")
    out = [Template(label, tuple(terms(text.encode())), phrase)
           for group, phrase in ((templates, False), (phrases, True)) for text, label in group.items()]
    for t in out:
        if not t.words:
            raise ValueError(f"template of {t.label} has no words")
        size = len(set(t.words))
        t.least = size if t.phrase else -(-threshold * size // 100)
    return out


def build_index(docs: DataFrame, templates: list[Template]) -> Index:
    """The index of ``templates`` in the global order of their words: by the number
    of documents that hold a word, over all of ``docs``, then by the word."""
    vocabulary = sorted({w for t in templates for w in t.words})
    number = {w: i for i, w in enumerate(vocabulary)}

    def held(texts: list[bytes]) -> list[int]:
        return [number[w] for text in texts for w in number.keys() & set(terms(text))]
    counts = sum_by_key(_texts(docs), "text", len(vocabulary), held) if vocabulary else []
    order = sorted(vocabulary, key=lambda w: (counts[number[w]], w))
    return Index(templates, max((len(t.words) for t in templates), default=1), {w: i for i, w in enumerate(order)})


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))


def find_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None,
                  phrases: Mapping[str, str] | None = None, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, matches (blocks that hold at least
    ``threshold`` hundredths of a template's distinct words) and places (of the
    phrases), each an array of (label, start, stop, containment), words counted
    from 0, in the order of start, stop, label.

    ``templates`` and ``phrases`` map a text to its label.  A null, empty or
    wordless text has no words and no matches; texts are read whole, however
    long.  Repeated rows are scanned each.  Overlapping blocks that match are all
    returned, ties in the order of words are broken by the word, so the result
    does not depend on partitions.  An empty table gives no rows.  Only doc_id
    and text are read."""
    index = build_index(docs, parse_templates(TEMPLATES if templates is None else templates,
                                              PHRASES if phrases is None else phrases, threshold))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, found = [], ([], [])
            for text in batch.column(1).to_pylist():
                words = terms(text)
                sizes.append(len(words))
                for out, spans in zip(found, index.scan(words)):
                    out.append([dict(zip(("label", "start", "stop", "containment"), s)) for s in spans])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *[pa.array(f, _SPANS) for f in found]],
                names=["doc_id", "n_words", "matches", "places"])
        return step
    span = "array<struct<label: string, start: bigint, stop: bigint, containment: double>>"
    return map_texts(_texts(docs), ["doc_id", "text"],
                     f"doc_id long, n_words long, matches {span}, places {span}", make)


def digest(found: DataFrame) -> DataFrame:
    """One row per document of ``find_licenses``: how many places of phrases, the
    first and last word where one starts, the labels of phrases, those of phrases
    and templates together, and the highest containment (0 without any)."""
    def joined(*arrays):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*[F.col(f"{a}.label") for a in arrays]))))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined("places").alias("base_labels"), joined("places", "matches").alias("labels"),
        F.coalesce(F.array_max(F.concat("places.containment", "matches.containment")), F.lit(0.0)).alias("score"))
