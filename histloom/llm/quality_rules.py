"""Quality rules whose cutoffs come from labelled holdouts under risk control.

Each rule is a metric of the text ("higher is worse") on a fixed grid of
cutoffs.  Per stratum a part of the labelled documents orders the cutoffs of all
rules into one path on which ever more is rejected; the others, which the path has
not seen, test it from the most lenient step on: a step is certified while the exact
(Clopper-Pearson) upper bound on the share of good documents that its rules reject
*together* is at most ``alpha``.  Testing in a fixed order and stopping at the first
failure needs no correction along a path; across strata the error level is split
evenly (Bonferroni).  So, with probability ``1 - delta``, every stratum loses at most
``alpha`` of its good documents to the rules."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import cut_lineage
from .common import packed, scalar

#: Symbols counted by the contract.
SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))

#: Rule metrics and their grids, most lenient cutoff first.
GRIDS: dict[str, tuple[float, ...]] = {
    "symbols_per_char": (1.0, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01),
    "dup_line_share": (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "repeat_word_share": (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "upper_share": (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "exclaim_per_word": (3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "word_length": (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 13.0, 12.0, 11.0, 10.0),
}
RULES = list(GRIDS)
#: Share of a stratum's labelled documents that orders its path; all others certify it.
#: That share has no bound in rows.
PATH_SHARE, PATH_ROWS = 0.2, math.inf


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), rule metrics)
    of a whole text; null counts as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()                       # bytes split on exactly space, tab to CR
    n_words = len(words)
    word_chars = len(text) - len(raw) + sum(map(len, words))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeat_words(words) if n_words > 3 else 0
    letters = max(1, word_chars)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    metrics = [n_symbols / letters, n_dup / max(1, len(lines)), n_repeat / max(1, n_words),
               upper / letters, raw.count(b"!") / max(1, n_words), word_chars / max(1, n_words)]
    return (n_words, word_chars, n_symbols, n_dup, n_repeat), metrics


def base_fails(n_words: int, n_repeat: int) -> bool:
    """The base rule of the contract."""
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def levels_of(metrics: list[float]) -> list[int]:
    """Per rule, how many cutoffs of its grid the metric exceeds (the grids
    fall, so these are the last ones of the grid)."""
    return [sum(m > c for c in GRIDS[r]) for r, m in zip(RULES, metrics)]


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_measures(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, then the five counts, base_failed and levels
    (all prefixed with ``_q_`` so that no input column clashes)."""
    chosen = docs.select(*columns, F.col("text").alias("_q_text"))
    names = [f"_q_{c}" for c in _COUNTS] + ["_q_base_failed", "_q_levels"]
    schema = chosen.drop("_q_text").schema
    given = chosen.columns[:-1]
    for n in names[:5]:
        schema = schema.add(n, "long")
    schema = schema.add(names[5], "boolean").add(names[6], T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            cols = [pa.array([c[i] for c, _ in rows], pa.int64()) for i in range(5)]
            cols.append(pa.array([base_fails(c[0], c[4]) for c, _ in rows], pa.bool_()))
            cols.append(pa.array([levels_of(m) for _, m in rows], pa.list_(pa.int32())))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(kept + cols, names=given + names)
    return chosen.mapInArrow(run, schema)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in log space from the largest term."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    lp, lq = math.log(p), math.log1p(-p)
    def log_term(i):
        return math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * lp + (n - i) * lq
    if k > n * p:                              # sum the thinner tail
        total, i = 0.0, k + 1
        while i <= n:
            t = math.exp(log_term(i))
            total += t
            if t < 1e-18 * max(total, 1e-300):
                break
            i += 1
        return max(0.0, 1.0 - total)
    total, i = 0.0, k
    while i >= 0:
        t = math.exp(log_term(i))
        total += t
        if t < 1e-18 * max(total, 1e-300):
            break
        i -= 1
    return min(1.0, total)


def certified(k: int, n: int, limit: float, level: float) -> bool:
    """Whether the exact upper confidence bound (error ``level``) on a share
    seen ``k`` times in ``n`` is at most ``limit``: the bound is the p with
    P(X <= k) = level, and that probability falls in p."""
    return n > 0 and binomial_cdf(k, n, limit) <= level


def path_of(levels: np.ndarray, low: np.ndarray, weight: np.ndarray, cost: float) -> list[tuple[int, int]]:
    """Steps (rule, cut), one cutoff of one rule at a time, from rejecting nothing on.

    Greedily the rule and cut that reject most low documents, less ``cost`` times the
    good ones, per good one (of equals the most lenient cut, then the first rule);
    all cutoffs on the way to it are steps of their own.  Ends where nothing gains.
    ``levels`` has a row per kind of document, ``weight`` how many there are."""
    cuts = [len(GRIDS[r]) for r in RULES]
    there, steps = np.ones(len(levels), bool), []
    while True:
        best = None
        for rule, now in enumerate(cuts):
            mine = levels[there, rule]
            lost = [np.bincount(mine, weight[there] * kind, now + 1)[::-1].cumsum()[::-1]
                    for kind in (low[there], ~low[there])]       # documents at a level or above
            for cut in range(now - 1, -1, -1):
                gain = lost[0][cut + 1] - cost * lost[1][cut + 1]
                rate = gain / (1 + lost[1][cut + 1])
                if gain > 0 and (best is None or rate > best[0]):
                    best = rate, rule, cut
        if best is None:
            return steps
        _, rule, cut = best
        steps += [(rule, c) for c in range(cuts[rule] - 1, cut - 1, -1)]
        cuts[rule] = cut
        there &= levels[:, rule] <= cut


def certified_steps(good: list[int], low: list[int], n_good: int, alpha: float, error: float, cost: float) -> int:
    """How many steps of a path to take.  ``good[i]`` and ``low[i]`` documents are
    rejected by step i and by no earlier one.  Of the certified beginnings of the path
    the one that rejects most low documents, less ``cost`` times the good ones; the
    shortest of equals."""
    best, taken, all_good, all_low = 0.0, 0, 0, 0
    for i, (g, lo) in enumerate(zip(good, low)):
        all_good, all_low = all_good + g, all_low + lo
        if not certified(all_good, n_good, alpha, error):
            break
        if all_low - cost * all_good > best:
            best, taken = all_low - cost * all_good, i + 1
    return taken


def fit_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang",
                alpha: float = 0.02, delta: float = 0.05, cost: float = 5.0) -> DataFrame:
    """Cutoffs per stratum: (stratum, _q_cuts), an array with, per rule, the
    highest level that is kept (the grid's length where no cutoff is certified).

    ``measured`` has doc_id, ``stratum`` and _q_levels; ``labels`` doc_id and
    quality (1 good, 0 low; others are ignored; of a doc_id labelled more than
    once, all labels count).  By a hash of doc_id a fifth of a stratum's labelled
    documents order its path and all others certify it, so every labelled one has a part in
    the cutoffs.  A path is made from counts of equal levels, at most one per cell of the grids."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", (F.col("quality") == 0).alias("low"))
    known = cut_lineage(measured.select("doc_id", F.col(stratum).alias("stratum"), "_q_levels")
                        .join(known, "doc_id"))                   # labelled documents, no texts
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) / 1_000_000 < PATH_SHARE
    dealt = known.withColumn("drawn", drawn)
    stratum_type = known.schema["stratum"].dataType.simpleString()

    def order(part: pd.DataFrame) -> pd.DataFrame:
        steps = path_of(np.stack(part["_q_levels"].to_numpy()).astype(int), part["low"].to_numpy(bool),
                        part["n"].to_numpy(float), cost)
        return pd.DataFrame({"s": part["stratum"].iloc[:1], "rules": [[r for r, _ in steps]],
                             "cuts": [[c for _, c in steps]]})
    paths = cut_lineage(
        dealt.where("drawn").groupBy("stratum", "low", "_q_levels").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("stratum").applyInPandas(order, f"s {stratum_type}, rules array<int>, cuts array<int>"))

    first = F.array_min(F.transform("rules", lambda r, i: F.when(
        F.get("_q_levels", r) > F.get("cuts", i), i)))            # null: no step rejects it
    cells = (dealt.where("NOT drawn").join(paths, F.col("stratum").eqNullSafe(paths["s"]))
             .select("stratum", "low", "rules", "cuts", first.alias("step"))
             .groupBy("stratum", "rules", "cuts", "step")
             .agg(F.sum((~F.col("low")).cast("long")).alias("good"), F.sum(F.col("low").cast("long")).alias("low")))
    cells = cut_lineage(cells)                 # strata x steps rows
    n_strata = scalar(cells, F.count_distinct(F.coalesce(F.col("stratum").cast("string"), F.lit("")),
                                              F.col("stratum").isNull()))
    error = delta / max(1, n_strata)

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        rules, cuts = part["rules"].iloc[0], part["cuts"].iloc[0]
        good, low = [0] * len(rules), [0] * len(rules)
        for step, g, lo in zip(part["step"], part["good"], part["low"]):
            if not pd.isna(step):
                good[int(step)], low[int(step)] = int(g), int(lo)
        taken = certified_steps(good, low, int(part["good"].sum()), alpha, error, cost)
        out = [len(GRIDS[r]) for r in RULES]
        for r, c in zip(rules[:taken], cuts[:taken]):
            out[r] = int(c)
        return pd.DataFrame({"stratum": part["stratum"].iloc[:1], "_q_cuts": [out]})
    return cells.groupBy("stratum").applyInPandas(choose, f"stratum {stratum_type}, _q_cuts array<int>")


def with_verdict(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds ``_q_kept``: not base_failed and no rule's level above its cut.
    A stratum without labelled documents has no cuts, so only the base rule holds."""
    cutoffs = cutoffs.withColumnRenamed("stratum", "_q_stratum")
    passed = F.forall(F.zip_with("_q_levels", "_q_cuts", lambda x, c: x <= c), lambda ok: ok)
    return (measured.join(cutoffs, measured[stratum].eqNullSafe(cutoffs["_q_stratum"]), "left")
            .withColumn("_q_kept", ~F.col("_q_base_failed") & (F.col("_q_cuts").isNull() | passed))
            .drop("_q_stratum", "_q_cuts"))


def judge_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk) -> DataFrame:
    """Counts and verdict of every whole text: doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    One row per document row, repeated rows alike; a null or empty text has no
    words and fails the base rule; an empty table gives no rows; with no labels, or too
    few to certify anything, only the base rule rejects.  A null stratum is a stratum
    of its own; other columns are not read.  Texts are read once; the counts are stored before the cutoffs
    are fitted."""
    measured = cut_lineage(with_measures(docs, ["doc_id", stratum]))
    judged = with_verdict(measured, fit_cutoffs(measured, labels, stratum, **risk), stratum)
    return judged.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in _COUNTS],
                         F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"))


def keep_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk) -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, with their own columns.
    Texts are read twice (fit, then filter) but never shuffled or stored."""
    fitted = fit_cutoffs(cut_lineage(with_measures(docs, ["doc_id", stratum])), labels, stratum, **risk)
    rows = docs.select(packed(docs), F.col(stratum).alias("_q_group"), "text")
    judged = with_verdict(with_measures(rows, ["_row", "_q_group"]), fitted, "_q_group")
    return judged.where("_q_kept").select("_row.*")
