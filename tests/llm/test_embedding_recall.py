"""Recall of the sorted projection passes where vectors share a direction."""

import numpy as np
import pytest

from histloom.llm import embedding_dedup as ed


def planted(n, shared, seed, pairs, dim=64):
    """Unit vectors with mean cosine ``shared``; the last ``pairs`` lie at cosine 0.982 to the first."""
    rng = np.random.default_rng(seed)
    base = np.eye(dim)[0]
    r = rng.standard_normal((n, dim))
    r -= np.outer(r @ base, base)
    x = np.sqrt(shared) * base + np.sqrt(1 - shared) * r / np.linalg.norm(r, axis=1)[:, None]
    d = rng.standard_normal((pairs, dim))
    d -= (d * x[:pairs]).sum(axis=1)[:, None] * x[:pairs]
    x[n - pairs:] = 0.982 * x[:pairs] + np.sqrt(1 - 0.982 ** 2) * d / np.linalg.norm(d, axis=1)[:, None]
    return x.astype(np.float32)


def test_recall_with_and_without_a_common_direction(spark):
    n, pairs, rows, want = 5000, 400, [], 0
    for label, shared in enumerate((0.0, 0.5, 0.9)):
        x = planted(n, shared, label, pairs)
        u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
        want += int((u @ u.T >= 0.98).sum()) - n
        rows += [(label * n + i, v.tolist(), label) for i, v in enumerate(x)]
    assert want == 6 * pairs
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(8)
    got = ed.near_vectors(df).where("n_links > 0").collect()
    assert sum(r.n_links for r in got) >= 0.99 * want
    assert all(r.component_id % n < pairs and r.vec_id - r.component_id in (0, n - pairs) for r in got)


def test_no_passes_leave_all_to_the_exact_way(spark):
    x = planted(900, 0.2, 7, 60)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = ed.near_vectors(df, max_passes=0, window=4)
    assert sorted((r.vec_id, r.component_id) for r in got.where("n_links = 1").collect()) == sorted(
        [(i, i) for i in range(60)] + [(840 + i, i) for i in range(60)])


@pytest.mark.parametrize("radius", [0.25, 0.5, 1.0])
def test_agreement_is_a_lower_bound(radius):
    """Of linked directions, seen from a mean that one lies ``radius`` from."""
    rng = np.random.default_rng(3)
    x = np.zeros((4000, 64))
    x[:, 0] = radius
    d = rng.standard_normal((4000, 64))
    y = x + 0.2 * d / np.linalg.norm(d, axis=1)[:, None]
    p = rng.standard_normal((64, 4000))
    same = ((x * p.T).sum(axis=1) >= 0) == ((y * p.T).sum(axis=1) >= 0)
    assert same.mean() > float(ed.agreement(np.array(radius), 0.98)) - 0.02
    assert ed.agreement(np.array(0.1), 0.98) == 0


def test_passes_grow_with_size_and_common_direction():
    need = [ed.passes_needed(n, 1.0, 0.98, 32, 48) for n in (33, 100, 10_000, 10 ** 6, 10 ** 9)]
    assert need == sorted(need) and need[0] == 1 and need[-1] > need[2]
    assert ed.passes_needed(10_000, 0.5, 0.98, 32, 48) > need[2]
    assert ed.passes_needed(10 ** 6, 0.1, 0.98, 32, 48) == 0 and ed.passes_needed(100, 0.0, 0.98, 32, 48) == 0
