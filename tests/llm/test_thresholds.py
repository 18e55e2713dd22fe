"""Near-duplicates at other thresholds than op6's."""

import pytest

import corpus_pipeline as cp
from histloom.llm import near_duplicates as nd

from . import cases
from .test_near_duplicates import roots, shingles


def components(rows, threshold):
    """(doc_id, smallest id of its component, kept) by brute force."""
    sets = [shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((r[0], min(ids, default=None), r[0] == min(ids, default=None)))
    return out


def survivors(rows, threshold):
    """Ids of one row of each component, and of all rows without words."""
    single = {(r[0], c[1]) for r, c in zip(rows, components(rows, threshold)) if c[2] and shingles(r[1])}
    return sorted([str(x[0]) for x in single] + [str(r[0]) for r in rows if not shingles(r[1])])


@pytest.mark.parametrize("threshold", [70, 80, 95])
def test_components_at_a_threshold(spark, threshold, monkeypatch):
    monkeypatch.setattr(nd, "TILE_SHINGLES", 3000)
    want = components(cases.rows(), threshold)
    assert want != components(cases.rows(), 85)
    got = [(r.doc_id, r.component_id, r.kept) for r in nd.near_duplicates(cases.docs(spark), threshold).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_stage_links_from_80(spark):
    got = cp.drop_copies(spark, cases.docs(spark), "")
    assert sorted(str(r.doc_id) for r in got.collect()) == survivors(cases.rows(), 80)


def test_bands_bound_the_miss_probability():
    assert nd.bands(85) == 24 and nd.bands(80) == 35 and nd.bands(100) == 1
    for t in range(1, 100):
        assert (1 - (t / 100) ** nd.ROWS) ** nd.bands(t) < nd.MISS
    with pytest.raises(ValueError):
        nd.bands(0)
