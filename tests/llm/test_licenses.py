"""License scans against a plain comparison of every block with every template."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histloom.llm import license_scan as lic

from . import cases
from .test_search import found


def brute(text, templates, phrases, threshold):
    words = found(text)
    width = max(len(found(t)) for t in [*templates, *phrases])
    last = max(0, -(-len(words) // width) - 2)
    matches, places = set(), set()
    for b in range(last + 1):
        start, stop = b * width, min((b + 2) * width, len(words))
        for t, label in templates.items():
            own = set(found(t))
            shared = len(own & set(words[start:stop]))
            if shared * 100 >= threshold * len(own):
                matches.add((label, start, stop, shared / len(own)))
    for t, label in phrases.items():
        own = found(t)
        places |= {(label, p, p + len(own), 1.0) for p in range(len(words)) if words[p:p + len(own)] == own}
    return sorted(matches), sorted(places)


def result(df):
    return sorted((str(r.doc_id), r.n_words, sorted(tuple(x) for x in r.matches), sorted(tuple(x) for x in r.places))
                  for r in df.collect())


def notices():
    rnd = random.Random(2)
    texts = [None, "", "\n", "All rights\nRESERVED.", "cc by cc by-nc; CC-BY", "all rights all rights reserved reserved",
             "Released  under the M.I.T license", "released under the mit license", "license the under released mit",
             "Licensed under the Apache License, version 3.0", "général public license général", "general public license é"]
    for t in lic.TEMPLATES:
        words = cases.words(rnd, 150)
        at = rnd.randrange(150)
        texts.append(" ".join(words[:at] + [t] + words[at:]))
        texts.append(" ".join(words[:at] + t.split()[1:] + words[at:]))       # one word lost
        texts.append("\n".join(t.split() + words))
    texts += [texts[-1], " ".join(cases.words(rnd, 20_000) + ["All", "rights", "reserved"] + cases.words(rnd, 20_000))]
    return texts


@pytest.mark.parametrize("threshold", [60, 90, 100])
def test_matches_equal_a_plain_comparison(spark, threshold):
    texts = notices()
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(3, texts[3], 2, "y"), (None, texts[7], 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels int, matches string").repartition(5)
    got = lic.find_licenses(df, threshold=threshold)
    assert result(got) == sorted((str(r[0]), len(found(r[1])), *brute(r[1], lic.TEMPLATES, lic.PHRASES, threshold))
                                 for r in rows)


def test_digest(spark):
    df = spark.createDataFrame([(1, "x All rights reserved. Released under the MIT License, cc by"), (2, None), (3, "no")],
                               "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in lic.digest(lic.find_licenses(df)).collect()}
    assert got == {1: (11, 2, 1, 9, "cc-by,reserved", "cc-by,mit,reserved", 1.0),
                   2: (0, 0, None, None, "", "", 0.0), 3: (1, 0, None, None, "", "", 0.0)}
    assert lic.find_licenses(cases.no_docs(spark)).collect() == []
    assert len(lic.digest(lic.find_licenses(cases.docs(spark))).collect()) == len(cases.rows())


WORDS = st.lists(st.sampled_from("a b c d e f g".split()), max_size=60).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c d e f g h".split()), min_size=1, max_size=7).map(" ".join),
                min_size=1, max_size=4, unique=True), WORDS, st.integers(1, 100), st.randoms())
def test_filters_lose_nothing_in_any_order(templates, text, threshold, rnd):
    """Whatever the global order of the words is, the filters miss no match."""
    named = {t: f"t{i}" for i, t in enumerate(templates)}
    phrases = {"a b": "ab", "c": "c"}
    parsed = lic.parse_templates(named, phrases, threshold)
    order = sorted({w for t in parsed for w in t.words})
    rnd.shuffle(order)
    index = lic.Index(parsed, max(len(t.words) for t in parsed), {w: i for i, w in enumerate(order)})
    matches, places = index.scan(text.encode().split())
    assert (sorted(matches), sorted(places)) == brute(text, named, phrases, threshold)


def test_order_is_by_document_frequency_over_all_rows(spark):
    df = spark.createDataFrame([(1, "b b b b"), (2, "a"), (3, "a c")], "doc_id long, text string")
    index = lic.build_index(df, lic.parse_templates({"c a b d": "x"}, {}, 50))
    assert sorted(index.rank, key=index.rank.get) == [b"d", b"b", b"c", b"a"]


def test_refused_parameters(spark):
    for templates, threshold in (({"...": "x"}, 90), ({"a": "x"}, 0), ({"a": "x"}, 101)):
        with pytest.raises(ValueError):
            lic.parse_templates(templates, {}, threshold)
