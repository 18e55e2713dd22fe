"""Lexical search against a plain scorer."""

import math
import random
import re
from collections import Counter

from histloom.llm import lexical_search as ls

from . import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def found(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(items, docs, top=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    words = [found(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, words)), sum(map(len, words))
    df = Counter(w for ws in words for w in set(ws))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(found(t))
    out = []
    for i, terms in wanted.items():
        scored = []
        for (d, _), ws in zip(docs, words):
            uses = Counter(ws)
            m = 10 + 90 * len(ws) * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * (1_000_000_000 * uses[w] // (1000 * uses[w] + 8 * m)) for w in terms if uses[w])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def items(spark):
    rows = [(i, t, 1, 2.0) for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, rank int, score double")


ITEMS = [(1, cases.rows()[0][1][:300]), (2, "ONE two, three!"), (2, "single"), (3, None), (4, ""), (5, "..."), (6, "zzznone"),
         (7, "personal text 4111 Bob mail"), (None, "ré an the on"), (8, " ".join(cases.words(random.Random(3), 3000)))]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_results_equal_a_plain_scorer(spark):
    docs = [(r[0], r[1]) for r in cases.rows()]
    got = ls.search(items(spark), cases.docs(spark))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(got) == brute(ITEMS, docs)
    assert result(ls.search(items(spark), cases.docs(spark), top=3)) == brute(ITEMS, docs, 3)


def test_blocks_of_items_and_small_parts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ls, "CELLS", 30)
    monkeypatch.setattr(ls, "USES", 50)
    docs = [(r[0], r[1]) for r in cases.rows()]
    assert result(ls.search(items(spark), cases.docs(spark), block_terms=40)) == brute(ITEMS, docs)


def test_a_class_of_many_copies_is_expanded_by_doc_id(spark):
    docs = [(i, "alpha beta") for i in range(400, 0, -1)] + [(i, "alpha Gamma") for i in range(400, 700)] + [(None, "alpha beta")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    one = spark.createDataFrame([(1, "beta"), (2, "alpha gamma"), (3, "delta")], "item_id long, text string")
    got = result(ls.search(one, df))
    assert got == brute([(1, "beta"), (2, "alpha gamma"), (3, "delta")], docs)
    assert [r[2] for r in sorted(got) if r[0] == 1] == list(range(1, 11))


def test_colliding_hashes_stay_apart(spark, monkeypatch):
    """With one hash for all, classes still differ by their bags."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(ls.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    docs = [(r[0], r[1]) for r in cases.rows()]
    assert result(ls.search(items(spark), cases.docs(spark))) == brute(ITEMS, docs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert ls.search(none, cases.docs(spark)).collect() == []
    assert ls.search(items(spark), cases.no_docs(spark)).collect() == []
