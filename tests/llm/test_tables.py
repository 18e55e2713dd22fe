"""Sharding, URL rules, mixing, embeddings and the classifier."""

import collections
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from histloom.llm import catalog, embedding_dedup, mixing, pu_quality, sharding, url_filter

from . import cases

SF = "/root/testdata/sf0.001"


def jump(key, n):
    """The published loop on Python's integers."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_published_loop(spark):
    rnd = random.Random(1)
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63] + [rnd.getrandbits(63) for _ in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100, 1000):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_shards(spark):
    got = sharding.shard_documents(cases.docs(spark)).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()),
                   jump(r[0] or 0, 8), jump(r[0] or 0, 9)) for r in cases.rows())
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(cases.no_docs(spark)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme/en/", "http://net", "http://NET/", "https://a.Example.NET/en/x?q=/de/#f",
            "http://notexample.net/en/", "http://example.com/de/1", "http://xexample.com/de/1", "http://a.org/fr/",
            "http://a.org/fr", "http://my-casino.example.org/en/", "http://casinos.org/", "x://y://net/z",
            "http://example.com/de", "http://example.net?x=/en/", "http://a\nb.net/x", "http://my-casino\n.de/\n/"]
    pages = spark.createDataFrame([(i % 5, u, "h") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {(r.host, r.path): (r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert url_filter.judge_urls(pages).count() == len(urls)
    assert got == {
        ("a\nb.net", "/x"): ("net/", "block"), ("my-casino\n.de", "/\n/"): (None, "allow"),
        ("", ""): (None, "allow"), ("net", ""): (None, "allow"), ("net", "/"): ("net/", "block"),
        ("a.example.net", "/en/x"): ("example.net/en/", "allow"), ("notexample.net", "/en/"): ("net/", "block"),
        ("example.com", "/de/1"): ("example.com/de/", "block"), ("xexample.com", "/de/1"): (None, "allow"),
        ("a.org", "/fr/"): ("org/fr/", "allow"), ("a.org", "/fr"): (None, "allow"),
        ("my-casino.example.org", "/en/"): (None, "block"), ("casinos.org", "/"): (None, "allow"),
        ("y:", "//net/z"): (None, "allow"), ("example.com", "/de"): (None, "allow"), ("example.net", ""): (None, "allow")}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def vectors(spark):
    rng = np.random.default_rng(7)
    rows = []
    centre = rng.standard_normal(16)
    for i in range(60):                                    # a hot label with near copies
        rows.append((i, (centre + 0.1 * rng.standard_normal(16)).astype(np.float32).tolist(), 1))
    for i in range(60, 90):
        rows.append((i, rng.standard_normal(16).astype(np.float32).tolist(), i % 3))
    rows += [(90, rows[0][1], 1), (91, rows[0][1], 1), (91, rows[0][1], 1), (92, rows[0][1], 2), (93, rows[0][1], None),
             (94, None, 1), (95, [0.0] * 16, 1), (96, [float("nan")] * 16, 1), (97, [None] + [1.0] * 15, 1),
             (98, [float("inf")] + [1.0] * 15, 1), (99, [], 1), (None, rows[0][1], 1), (100, [1.0, 2.0], 1),
             (101, [2.0, 4.0], 1), (102, [-1.0, -2.0], 1), (103, [1e-30] * 16, 4), (104, [3e30] * 16, 4)]
    return rows


def test_embeddings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    monkeypatch.setattr(embedding_dedup, "TILE", 8)
    rows = vectors(spark)
    df = spark.createDataFrame([(*r, "n", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, cid string, slot int").repartition(4)
    got = [tuple(r) for r in embedding_dedup.near_vectors(df, window=8).collect()]

    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    ok = [bool(usable(r)) for r in rows]
    xs = [np.array(r[1], float) / np.abs(np.array(r[1], float)).max() if o else None for r, o in zip(rows, ok)]
    n = len(rows)
    link = [[i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(xs[i]) == len(xs[j])
             and xs[i] @ xs[j] / np.sqrt((xs[i] @ xs[i]) * (xs[j] @ xs[j])) >= 0.98 for j in range(n)] for i in range(n)]
    want = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for j in range(n):
                if link[x][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        want.append((rows[i][0], sum(link[i]), least, rows[i][0] == least))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_rates_match_targets(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(500):
        p = rnd.choice([[0.9, 0.05, 0.05], [0.1, 0.85, 0.05], [0.0, 0.1, 0.9], [0.3, 0.3, 0.4]])
        rows.append((p, rnd.randint(0, 300)))
    df = spark.createDataFrame(rows, "p array<double>, n long")
    p, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    goal = [0.7 * n.sum(), 0.2 * n.sum(), 0.1 * n.sum()]
    fitted = mixing.fit_rates(df, goal, max_steps=60)
    rate, weight = np.ones(len(rows)), 1 / (n @ p)
    for _ in fitted.steps:                                 # the same iteration, row by row
        rate = np.maximum(0, rate - p @ (weight * ((n * rate) @ p - goal)))
    assert np.allclose((n * rate) @ p, fitted.totals)
    assert np.abs(np.array(fitted.totals) - goal).sum() < 1e-3 * n.sum()
    got = df.select("n", mixing.rate_of(F.col("p"), fitted.steps).alias("r")).agg(F.sum(F.col("n") * F.col("r"))).first()[0]
    assert abs(got - (n * rate).sum()) < 1e-6 * n.sum() and (rate >= 0).all()


def test_mixing_table(spark):
    docs, labelled = cases.docs(spark), mixing.quality_domains(cases.labels(spark))
    got = mixing.mix_documents(docs, labelled).collect()
    assert len(got) == docs.count() and all(abs(sum(r.posteriors) - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert all(r.rate == 1 and r.copies == 1 for r in got if r.n_tokens == 0)
    assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in got)
    again = mixing.resample_documents(docs, labelled, shares=mixing.SHARES)
    assert again.schema == docs.schema and again.count() == sum(r.copies for r in got)
    plain = mixing.mix_documents(docs, labelled.limit(0)).collect()
    assert all(r.domain is None and r.rate == 1 for r in plain)
    assert mixing.mix_documents(cases.no_docs(spark), labelled).count() == 0


def test_classifier_held_out_accuracy(spark):
    df = catalog.QUERIES["op1_pu_quality_classifier"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality"), "doc_id").where("held_out")
    rows = df.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_classifier_edges(spark):
    docs = cases.docs(spark)
    got = pu_quality.score_documents(docs, cases.labels(spark))
    assert got.count() == docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r.score for r in pu_quality.score_documents(docs, cases.labels(spark).limit(0)).collect()} == {0.5}
    assert pu_quality.score_documents(cases.no_docs(spark), cases.labels(spark)).count() == 0


def test_prior_estimate_and_risk():
    rng = np.random.default_rng(5)
    good, low = rng.normal(2, 1, (4000, 16)), rng.normal(-2, 1, (4000, 16))
    u = np.concatenate([rng.normal(2, 1, (1800, 16)), rng.normal(-2, 1, (1200, 16))])
    scorer = pu_quality.fit(pu_quality.Sample.of(good), pu_quality.Sample.of(u))
    assert abs(scorer.prior - 0.6) < 0.05
    assert (scorer.score(good) > 0.5).mean() > 0.97 and (scorer.score(low) > 0.5).mean() < 0.1


def test_risk_gradient_is_the_derivative_of_the_risk():
    """Against finite differences, on both sides of a negative risk of 0."""
    rng = np.random.default_rng(6)
    for shift in (-3, 3):
        zp, zu = rng.normal(1, 1, 6), rng.normal(shift, 1, 9)
        wp, wu = (w / w.sum() for w in (rng.random(6), rng.random(9)))

        def negative(a, b):
            return pu_quality._negative_risk(a, b, wp, wu, 0.5)
        assert (negative(zp, zu) < 0) == (shift < 0)

        def risk(a, b):
            return -negative(a, b) if shift < 0 else 0.5 * (wp @ np.logaddexp(0, -a)) + negative(a, b)
        gp, gu = pu_quality.nn_pu_gradient(0.5)(zp, zu, wp, wu)
        for g, z, at in ((gp, zp, lambda d: risk(zp + d, zu)), (gu, zu, lambda d: risk(zp, zu + d))):
            for i in range(len(z)):
                step = np.eye(len(z))[i] * 1e-5
                assert abs((at(step) - at(-step)) / 2e-5 - g[i]) < 1e-7


def test_prior_counts_cover_all_rows_and_repeats_take_one_place(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (300, 16))
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(0, [float(v) for v in x[0]])] * 150
    known = spark.createDataFrame(rows, "doc_id long, x array<double>").repartition(7)
    first = pu_quality.Scorer(pu_quality._cuts(x), rng.normal(0, 1, 256), 0.1)
    cuts = np.array([-1.0, 0.0, 0.5])
    z = first.logit(np.array([r[1] for r in rows]))
    want = [(z < -1).sum(), ((z >= -1) & (z < 0)).sum(), ((z >= 0) & (z < 0.5)).sum(), (z >= 0.5).sum()]
    assert pu_quality._counts(known)(first, cuts).tolist() == want
    got = pu_quality._sample(known, F.lit(True))
    assert len(got.x) == 300 and sorted(got.n)[-2:] == [1, 151] and 100 < got.first.sum() < 200
    again = pu_quality._sample(known.repartition(2), F.lit(True))
    assert (again.x == got.x).all() and (again.n == got.n).all() and (again.first == got.first).all()
    few = pu_quality._sample(known, pu_quality._drawn(300, 60, 2))
    assert 30 < len(few.x) < 100
