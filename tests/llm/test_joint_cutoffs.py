"""Cutoffs certified together: path, steps and verdicts against a plain version."""

import random

import numpy as np
from pyspark.sql import functions as F

from histloom.llm import quality_rules as q

from . import cases


def _plain(rows, alpha, delta, cost):
    """(stratum -> cuts) from (drawn, stratum, low, levels)."""
    out = {}
    strata = {r[1] for r in rows if not r[0]} & {r[1] for r in rows if r[0]}
    for s in strata:
        mine = [r for r in rows if r[0] and r[1] == s]
        cuts = [len(q.GRIDS[r]) for r in q.RULES]
        path = [tuple(cuts)]
        def net(c):
            gone = [r for r in mine if any(x > y for x, y in zip(r[3], c))]
            low = sum(r[2] for r in gone)
            return low, len(gone) - low
        while True:
            now, best = net(path[-1]), None
            for rule in range(len(cuts)):
                for cut in range(path[-1][rule] - 1, -1, -1):
                    c = list(path[-1]); c[rule] = cut
                    got = net(c)
                    low, good = got[0] - now[0], got[1] - now[1]
                    if low - cost * good > 0 and (best is None or (low - cost * good) / (1 + good) > best[0]):
                        best = (low - cost * good) / (1 + good), rule, cut
            if best is None:
                break
            for cut in range(path[-1][best[1]] - 1, best[2] - 1, -1):
                c = list(path[-1]); c[best[1]] = cut
                path.append(tuple(c))
        held = [r for r in rows if not r[0] and r[1] == s]
        n, chosen, top = sum(not r[2] for r in held), path[0], 0
        for c in path[1:]:
            gone = [r for r in held if any(x > y for x, y in zip(r[3], c))]
            good = sum(not r[2] for r in gone)
            if not q.certified(good, n, alpha, delta / len(strata)):
                break
            if len(gone) - good - cost * good > top:
                top, chosen = len(gone) - good - cost * good, c
        out[s] = list(chosen)
    return out


def test_cutoffs_and_verdicts_equal_a_plain_version(spark):
    rnd, rows, marks = random.Random(8), [], []
    for i in range(2400):
        lang = rnd.choice(["en", "en", "de", None])
        low = rnd.random() < 0.3
        words = cases.words(rnd, 60 + i % 25)
        if low or rnd.random() < 0.01:
            tail = rnd.choice(["&", "&&", "!", "!!", "XYZ"])
            words = [w + tail if rnd.random() < 0.7 else w for w in words]
        rows.append((i, " ".join(words), lang))
        marks.append((i, 0 if low else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    measured = q.with_measures(docs, ["doc_id", "lang"])
    got = {r.stratum: list(r._q_cuts) for r in q.fit_cutoffs(measured, labels).collect()}

    share = {s: min(q.PATH_SHARE, q.PATH_ROWS / sum(r[2] == s for r in rows)) for s in {r[2] for r in rows}}
    place = {r.doc_id: r.u for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000))
                                                           / 1_000_000).alias("u")).collect()}
    plain = [(place[i] < share[lang], lang, marks[i][1] == 0, q.levels_of(q.measure(t)[1])) for i, t, lang in rows]
    want = _plain(plain, 0.02, 0.05, 5.0)
    assert got == want
    whole = [len(q.GRIDS[r]) for r in q.RULES]
    assert all(c != whole for c in want.values())                # every stratum, the null one too, has cutoffs

    kept = {r.doc_id: r.kept for r in q.judge_documents(docs, labels).collect()}
    for (i, text, lang), (_, _, _, levels) in zip(rows, plain):
        n, metrics = q.measure(text)
        assert kept[i] == (not q.base_fails(n[0], n[4]) and all(x <= c for x, c in zip(levels, want[lang])))
    good = [i for i, x in marks if x]
    assert sum(not kept[i] for i in good) <= 0.03 * len(good)


def test_rejected_share_stays_within_alpha():
    """Over many draws, a rejected share above alpha is certified about as rarely as asked for."""
    rnd, bad = np.random.default_rng(3), 0
    share = np.array([0.0, 0.005, 0.01, 0.03, 0.06])             # of good documents rejected by step i alone
    for _ in range(2000):
        got = rnd.multinomial(400, [*share, 1 - share.sum()])
        taken = q.certified_steps(list(got[:5]), [100] * 5, 400, 0.02, 0.05, 0.0)
        bad += share[:taken].sum() > 0.02
    assert bad <= 0.05 * 2000 + 30


def test_no_path_without_low_documents():
    assert q.path_of(np.ones((5, len(q.RULES)), int), np.zeros(5, bool), np.ones(5), 5.0) == []
    assert q.path_of(np.zeros((0, len(q.RULES)), int), np.zeros(0, bool), np.ones(0), 5.0) == []
    assert q.certified_steps([], [], 0, 0.02, 0.05, 5.0) == 0
