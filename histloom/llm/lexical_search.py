"""Ranked lexical search with bag deduplication.

1. The items' distinct terms are the vocabulary.  One pass over the whole texts
   keeps of each document its number of terms and its bag: the vocabulary terms
   with their counts.  N, L and the document frequencies are taken over all rows.
2. Documents with the same bag and the same m score alike for every item.  They
   are brought together by a hash and grouped by the bag itself, so a collision
   joins nothing; a class keeps the ``top`` smallest of its doc_ids, cut to that
   many in every task before the exchange.
3. Each class is scored once against all items.  A task returns at most ``top``
   classes per item, and these are expanded to their members by ascending doc_id.

At most ``top`` classes can reach an item's list: by score, then by their
smallest doc_id.  Items are taken in blocks whose distinct (item, term) pairs
stay near ``BLOCK_TERMS``, so what is sent to the tasks is bounded."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import cut_lineage
from .common import map_texts, scalar
from .terms import sum_by_key, terms

#: Results per item; (item, term) pairs of a block of items.
TOP, BLOCK_TERMS = 10, 200_000
#: Scores, and term uses with an item, held at a time in a task.
CELLS, USES = 1 << 21, 1 << 20
RESULT = "item_id long, rank int, doc_id long, score long"

_SCORED = pa.schema([("item", pa.int32()), ("score", pa.int64()),
                     ("members", pa.list_(pa.struct([("late", pa.bool_()), ("doc_id", pa.int64())])))])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item; rows with the same
    item_id are one item."""
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     for t in set(terms(text))]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                               pa.array([p[1] for p in pairs], pa.binary())], names=["item_id", "term"])
        return step
    rows = items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.col("text").cast("string").cast("binary").alias("text"))
    return map_texts(rows, ["item_id", "text"], "item_id long, term binary", make).distinct()


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document row: doc_id, n (terms with repeats), bag (32-bit pairs of
    term number and count by term number; empty without vocabulary terms)."""
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, out = [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                uses = Counter(words)
                sizes.append(len(words))
                out.append(np.array(sorted((vocabulary[t], uses[t]) for t in vocabulary.keys() & uses.keys()),
                                    np.int32).tobytes())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                                              names=["doc_id", "n", "bag"])
        return step
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    return map_texts(rows, ["doc_id", "text"], "doc_id long, n long, bag binary", make)


def _pairs(some: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(some), np.int32).reshape(-1, 2)


def document_frequencies(bagged: DataFrame, size: int) -> np.ndarray:
    return sum_by_key(bagged, "bag", size, lambda some: _pairs(some)[:, 0])


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) per term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def bag_classes(bagged: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(m, bag, members): the classes of equal bag and m, with the ``top``
    smallest doc_ids of each (null ones last)."""
    m = F.expr(f"10 + (90L * n * {n_docs}L) div {max(n_terms, 1)}L")
    same = Window.partitionBy("hash", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    return (bagged.where("length(bag) > 0").select("doc_id", m.alias("m"), "bag")
            .withColumn("hash", F.xxhash64("m", "bag"))
            .withColumn("place", F.row_number().over(same)).where(F.col("place") <= top)
            .groupBy("hash", "m", "bag")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id"))).alias("members"))
            .select("m", "bag", "members"))


class ItemIndex:
    """Which items hold a term: item numbers per term number, one after another."""

    def __init__(self, pairs: list[tuple[int, int]], n_items: int, weight: np.ndarray):
        by_term = sorted((t, i) for i, t in pairs)
        self.items = np.array([i for _, i in by_term], np.int64)
        self.starts = np.searchsorted([t for t, _ in by_term], np.arange(len(weight) + 1))
        self.n_items, self.weight = n_items, weight

    def scores(self, m: np.ndarray, some: list[bytes]) -> np.ndarray:
        """(classes, items) scores."""
        pairs = _pairs(some).astype(np.int64)
        row = np.repeat(np.arange(len(some)), [len(b) // 8 for b in some])
        gain = self.weight[pairs[:, 0]] * (1_000_000_000 * pairs[:, 1] // (1000 * pairs[:, 1] + 8 * m[row]))
        uses = self.starts[pairs[:, 0] + 1] - self.starts[pairs[:, 0]]
        out = np.zeros(len(some) * self.n_items, np.int64)
        ends = np.cumsum(uses)
        for a, b in _parts(uses, USES):
            n, base = uses[a:b], ends[a] - uses[a]
            offset = np.arange(ends[b - 1] - base) - np.repeat(ends[a:b] - uses[a:b] - base, n)
            item = self.items[np.repeat(self.starts[pairs[a:b, 0]], n) + offset]
            np.add.at(out, np.repeat(row[a:b], n) * self.n_items + item, np.repeat(gain[a:b], n))
        return out.reshape(len(some), self.n_items)


def _parts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Slices whose sizes sum to at most ``limit`` (or one element)."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes):
        yield start, len(sizes)


def best_classes(classes: DataFrame, index: ItemIndex, top: int) -> DataFrame:
    """(item, score, members): of each task's classes the ``top`` of each item by
    score above 0, then by smallest member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in range(index.n_items)]
        least = np.ones(index.n_items, np.int64)          # a score below it cannot enter the item's list
        rows = max(1, CELLS // index.n_items)
        for batch in batches:
            m = batch.column(0).to_numpy()
            some, members = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a in range(0, len(some), rows):
                scores = index.scores(m[a:a + rows], some[a:a + rows])
                if len(scores) > top:
                    least = np.maximum(least, np.partition(scores, -top, axis=0)[-top])
                touched = set()
                for r, i in zip(*np.nonzero(scores >= least)):
                    first = members[a + r][0]
                    best[i].append((-int(scores[r, i]), first["late"], first["doc_id"] or 0, members[a + r]))
                    touched.add(int(i))
                for i in touched:
                    best[i] = sorted(best[i], key=lambda x: x[:3])[:top]
                    if len(best[i]) == top:
                        least[i] = max(least[i], -best[i][-1][0])
        out = [(i, -x[0], x[3]) for i, found in enumerate(best) for x in found]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCORED)], schema=_SCORED)
    return classes.select("m", "bag", "members").mapInArrow(
        run, "item int, score long, members array<struct<late: boolean, doc_id: bigint>>")


def search(items: DataFrame, docs: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Of each item the ``top`` documents with the highest scores above 0:
    item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id.

    Rows of ``items`` with the same item_id (or none) are one item with the terms
    of all; one without terms or without a match gives no rows.  Every row of
    ``docs`` is a document of its own, repeated ones too, and texts are read
    whole; a null or empty text has no terms and is never found.  A null doc_id
    comes after all others of the same score.  Empty tables give no rows.  Only
    item_id, doc_id and the texts are read."""
    spark = docs.sparkSession
    wanted = cut_lineage(item_terms(items))
    blocks = math.ceil(scalar(wanted, F.count(F.lit(1))) / block_terms)
    found = []
    for block in range(blocks):
        pairs = [(r.item_id, bytes(r.term)) for r in
                 wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()]
        if pairs:
            got = _search_block(pairs, docs, top)
            found.append(got if blocks == 1 else cut_lineage(got))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)


def _search_block(pairs: list[tuple[int | None, bytes]], docs: DataFrame, top: int) -> DataFrame:
    names = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i))
    numbers = {name: i for i, name in enumerate(names)}
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, t in pairs}))}
    bagged = cut_lineage(bags(docs, vocabulary))
    row = bagged.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"),
                     F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weight = weights(row.docs, document_frequencies(bagged, len(vocabulary)))
    index = ItemIndex([(numbers[i], vocabulary[t]) for i, t in pairs], len(names), weight)
    best = best_classes(bag_classes(bagged, row.docs, row.terms, top), index, top)
    members = best.select("item", "score", F.explode("members").alias("one")).select("item", "score", "one.doc_id")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ids = docs.sparkSession.createDataFrame([(i, name) for name, i in numbers.items()], "item int, item_id long")
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")
