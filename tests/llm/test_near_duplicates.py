"""Components against brute force over full shingle sets."""

import numpy as np
import pytest

from histloom.llm import near_duplicates as nd
from histloom.llm import sketch
from histloom.llm.components import connected_components

from . import cases


def shingles(text):
    w = bytes((text or "").encode()).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((r[0], len(sets[i]), least, r[0] == least))
    return out


def test_components_match_brute_force(spark):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept)
           for r in nd.near_duplicates(cases.docs(spark)).collect()]
    assert sorted(got, key=str) == sorted(brute(cases.rows()), key=str)


def test_small_tiles_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(nd, "TILE_SHINGLES", 300)
    got = [(r.doc_id, r.component_id) for r in nd.near_duplicates(cases.docs(spark, 6)).collect()]
    assert sorted(got, key=str) == sorted([(r[0], r[2]) for r in brute(cases.rows(6))], key=str)


def test_kept_rows_have_their_own_columns(spark):
    docs = cases.docs(spark)
    kept = nd.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    from .test_thresholds import survivors
    want = survivors(cases.rows(), nd.THRESHOLD)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_table(spark):
    assert nd.near_duplicates(cases.no_docs(spark)).count() == 0


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(3)
    whole = [np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64)) for n in (1, 7, 80, 900)]
    table = sketch.fast_similarity_sketch(whole, 120)
    assert (table != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    errors = []
    for s in whole[2:] * 20:
        part = s[rng.random(len(s)) < 0.85]
        a, b = sketch.fast_similarity_sketch([s, part], 120)
        errors.append((a == b).mean() - len(part) / len(s))
    assert abs(np.mean(errors)) < 0.03
    assert (sketch.fast_similarity_sketch([np.zeros(0, np.uint64)], 8) == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_intersections_are_exact():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 500, rng.integers(0, 300)).astype(np.uint64)) for _ in range(12)]
    got = sketch.intersections(sets, width=64)
    for i in range(12):
        for j in range(12):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (3, 4), (9, 8), (8, 8), (4, 1), (7, 9)],
                                   [(i, i + 1) for i in range(30)]])
def test_connected_components(spark, edges):
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    root = roots(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in edges])
    want = {n: min(m for j, m in enumerate(nodes) if root[j] == root[i]) for i, n in enumerate(nodes)}
    assert got == want


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, copies without ids, equal ids of near copies, wordless rows."""
    text = " ".join(f"w{i}" for i in range(60))
    near = text.replace("w59", "other")
    rows = ([(1, text, "a", {"k": 1})] * 5 + [(1, text, "b", None), (1, near, "c", None), (7, near, "d", None)]
            + [(None, "four rows without an id " * 3, "e", None)] * 4 + [(None, "four rows without an id " * 3 + "four", "f", None)]
            + [(3, "", "g", None)] * 2 + [(None, None, "h", None)] * 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra map<string, int>").repartition(4)
    got = nd.drop_near_duplicates(docs, 80)
    assert got.schema == docs.schema
    left = sorted((str(r.doc_id), r.text or "", r.lang) for r in got.collect())
    assert len([x for x in left if x[0] == "1"]) == 1 and not [x for x in left if x[0] == "7"]
    assert len([x for x in left if x[2] in "ef"]) == 1
    assert [x[2] for x in left if x[2] in "gh"] == ["g", "g", "h", "h"] and len(left) == 6
    again = sorted((str(r.doc_id), r.text or "", r.lang) for r in nd.drop_near_duplicates(docs.repartition(1), 80).collect())
    assert again == left


def test_row_keys_tell_nulls_from_text(spark):
    rows = [(None, None), (None, ""), (0, None), (0, ""), (None, "n"), (1, ":t:"), (1, "t:"), (11, ""), (1, "1")]
    keys = [r.row_key for r in nd._rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(set(keys)) == len(rows) and {len(k) for k in keys} == {16}


def _neighbours(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    return out


def test_hot_nodes_are_split(spark):
    """One node has half of all links: AQE splits its partition in both steps."""
    from pyspark.sql import functions as F
    from histloom.llm import components
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in low}
    even, top = F.col("id") % 2 == 0, 60_001
    ids = spark.range(1, top, 1, 16)
    above = ids.select(F.when(even, top).otherwise(F.col("id") + 1).cast("long").alias("a"), F.col("id").alias("b"))
    below = ids.select(F.col("id").alias("a"), F.when(even, 0).otherwise(F.col("id") - 1).cast("long").alias("b"))
    small, large = set(), set()
    for a, near in _neighbours((top if i % 2 == 0 else i + 1, i) for i in range(1, top)).items():
        small |= {(b, min(near)) for b in near if b != min(near)} | {(a, min(near))}
    pairs = [(i, 0 if i % 2 == 0 else i - 1) for i in range(1, top)]
    for a, near in _neighbours(pairs + [(b, a) for a, b in pairs]).items():
        large |= {(b, min(near | {a})) for b in near if b > a}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        for step, edges, want in ((components._small_star, above, small), (components._large_star, below, large)):
            out = step(edges)
            assert {(r.a, r.b) for r in out.collect()} == want
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString(), step
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
